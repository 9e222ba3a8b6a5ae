"""Packs documents into sequences by power-of-two decomposition.

A document of n ids is cut into pieces of ``limit`` ids and then into the powers of two that add up
to the rest, largest first. Every piece is a sequence of its own, without padding, and belongs to
one document only. Pieces of equal length form a bucket, so batches are drawn from one bucket at a
time. The work is done where a text is read: nothing is shuffled.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.tokens import encoder

LIMIT = 4096
END_ID = 2


def lengths(count: int, limit: int = LIMIT) -> list[int]:
    """Piece lengths of a document of ``count`` ids; ``limit`` is a power of two."""
    rest = count % limit
    powers = [1 << bit for bit in reversed(range(limit.bit_length())) if rest >> bit & 1]
    return [limit] * (count // limit) + powers


def pack(
    docs: DataFrame, tokenizer: str, limit: int = LIMIT, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    ``length`` is also the piece's bucket. ``ids`` holds little-endian unsigned 32-bit numbers. A
    null or empty text has the end id alone, rows with one doc_id are packed apart, a null doc_id
    is kept, and an empty table gives no rows. ``sequence_id`` follows the order of the input's
    partitions and rows.
    """
    if limit & (limit - 1) or limit < 1:
        raise ValueError("limit must be a power of two")

    def run(batches):
        encode = encoder(tokenizer).encode
        for batch in batches:
            rows, starts, sizes, checks, totals, held = [], [], [], [], [], []
            for row, ids in enumerate(encode(batch.column(1))):
                ids = np.concatenate((ids, [end_id])).astype("<u4")
                raw, start = memoryview(ids.tobytes()), 0
                for size in lengths(len(ids), limit):
                    part = raw[4 * start : 4 * (start + size)]
                    rows.append(row)
                    starts.append(start)
                    sizes.append(size)
                    checks.append(zlib.crc32(part))
                    totals.append(len(ids))
                    if with_ids:
                        held.append(bytes(part))
                    start += size
            columns = {
                "doc_id": batch.column(0).take(pa.array(rows, pa.int64())),
                "start": pa.array(starts, pa.int64()),
                "length": pa.array(sizes, pa.int64()),
                "ids_crc32": pa.array(checks, pa.int64()),
                "doc_tokens": pa.array(totals, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(held, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = docs.select("doc_id", "text").mapInArrow(run, schema + ", ids binary" * with_ids)
    return pieces.withColumns(
        {"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store the sequences with a folder per bucket."""
    bucketed = pieces.withColumn("bucket", F.col("length"))
    bucketed.write.mode("overwrite").partitionBy("bucket").parquet(path)
