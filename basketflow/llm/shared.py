"""What the corpus operators share: tables, stored passes, bitmaps, the code on executors."""

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.sources.tables import materialize

__all__ = ["crc_bucket", "documents", "key_bitmap", "in_bitmap", "map_text", "materialize", "sample_by_label", "ship", "trimmed"]

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ARROW_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as --py-files would, once per application.

    Batches of texts for Python are kept small as well: workers hold a few of them at a time.
    """
    for key, value in ARROW_BATCHES.items():
        spark.conf.set(key, value)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    folder = tempfile.mkdtemp(prefix="code-")
    path = os.path.join(folder, "corpus_code.zip")
    root = os.path.dirname(PACKAGE)
    with zipfile.ZipFile(path, "w") as archive:
        for where, _, names in sorted(os.walk(PACKAGE)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(where, name)
                    archive.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


def crc_bucket(key: str, buckets: int) -> Column:
    """crc32 of the key as text, modulo ``buckets``; null for a null key."""
    return F.crc32(F.col(key).cast("string")) % buckets


def key_bitmap(keys: DataFrame, key: str, bits: int) -> np.ndarray:
    """A bitmap of 2**bits bits with the bit of every key set; its size does not grow with rows.

    Only 4 KB pieces that hold a bit reach the driver, 2**bits / 8 bytes at most. The bits are
    dealt out by piece before they are put together, so that no task sends pieces of its own.
    """
    bit = F.pmod(F.col(key), F.lit(1 << bits)) + 1
    pieces = (
        keys.select(F.bitmap_bucket_number(bit).alias("piece"), F.bitmap_bit_position(bit).alias("at"))
        .repartition("piece")
        .groupBy("piece")
        .agg(F.bitmap_construct_agg("at").alias("bits"))
    )
    bitmap = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for piece, part in pieces.collect():
        low = (piece - 1) * 4096
        bitmap[low : low + 4096] = np.frombuffer(part, dtype=np.uint8)[: len(bitmap) - low]
    return bitmap


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the (unsigned) keys have their bit set."""
    at = keys & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def trimmed(run: Callable) -> Callable:
    """``run`` for mapInArrow that gives freed memory back to the machine when its task ends.

    Workers are used again and would hold on to what their largest task took.
    """

    def inside(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return inside


def map_text(
    docs: DataFrame,
    compute: Callable[[pa.Array], list[pa.Array]],
    added: dict[str, str],
    beside: dict[str, Column] | None = None,
    drop_text: bool = False,
) -> DataFrame:
    """``docs`` with columns that ``compute`` makes of a batch of its text column.

    ``beside`` has columns that Spark computes in the same pass. Columns of ``docs`` with a name
    that is added are replaced.
    """
    beside = beside or {}
    kept = [c for c in docs.columns if c not in added and c not in beside]
    source = docs.select(
        *[F.col(f"`{c}`") for c in kept], *[v.alias(k) for k, v in beside.items()]
    )
    where = source.columns.index("text")
    passed = [i for i, c in enumerate(source.columns) if not (drop_text and i == where)]
    fields = [source.schema.fields[i] for i in passed]
    schema = T.StructType(fields + [T.StructField(k, T._parse_datatype_string(v)) for k, v in added.items()])

    def run(batches):
        for batch in batches:
            columns = [batch.column(i) for i in passed] + compute(batch.column(where))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)


def sample_by_label(docs: DataFrame, examples: Callable, rows: int) -> list[list[tuple[bytes, bytes]]]:
    """``rows`` distinct examples of smallest digest without and ``rows`` with a finding, of all texts.

    ``examples`` gives of a text column (has a finding, digest, its two values) of every example, the
    values maybe as a function that makes them. A task keeps no more than it may have to send.
    """

    def run(batches):
        best: list[dict[int, object]] = [{}, {}]
        for batch in batches:
            for has, digest, values in examples(batch.column(0)):
                best[has].setdefault(digest, values)
                if len(best[has]) > 2 * rows + 1000:
                    best[has] = {k: best[has][k] for k in sorted(best[has])[:rows]}
        for has, kept in enumerate(best):
            some = sorted(kept)[:rows]
            made = [kept[k]() if callable(kept[k]) else kept[k] for k in some]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([bool(has)] * len(some), pa.bool_()),
                    pa.array(some, pa.int64()),
                    *[pa.array([m[i] for m in made], pa.binary()) for i in range(2)],
                ],
                names=["has", "digest", "one", "two"],
            )

    found = docs.select("text").where("text is not null")
    stored = materialize(
        found.mapInArrow(run, "has boolean, digest long, one binary, two binary"), "examples"
    )
    return [
        [(r["one"], r["two"]) for r in some.dropDuplicates(["digest"]).orderBy("digest").limit(rows).collect()]
        for some in (stored.where("not has"), stored.where("has"))
    ]
