"""Token ids in training order: sequences at shuffled global slots, in shards of fixed-size records.

The documents of a task, each with an end id, make one stream of ids, which is cut into sequences of
``length`` ids. A sequence may hold the end of one document and the start of the next, so only the
last sequence of a task is padded; every sequence lists the documents in it. Sequences are numbered
0 .. n - 1 by one pass that stores them and a count per stored part. A keyed Feistel network permutes
the numbers: it is a bijection of the numbers with an even number of bits, and a result beyond n - 1 goes
through it again until it is below n (cycle-walking). The permuted number is the sequence's slot. Slots
are range-partitioned by shard and sorted, so that record i of shard s is slot s * ``per_shard`` + i.
Every shard is written from its range as one raw file of records without anything between them, so that
record i starts at byte i * stride of ``shard-<s>.bin``, and a reader goes on from any slot by seeking.
Beside it ``shard-<s>.index`` has an entry of fixed size per record and ``shard-<s>.pieces`` one per
stretch of a document in a record: an entry says how many stretches there are, and which is the first.
Sequences are compressed while they are stored and shuffled, with a dictionary made from a bounded
sample of texts; what the shards hold does not depend on it. Nothing else but counts per part is
gathered.
"""

import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketflow.llm.shared import materialize
from basketflow.llm.textbytes import mix
from basketflow.llm.tokens import encoder
from basketflow.operators.lookup import lookup

LENGTH = 1024
PER_SHARD = 8192
END_ID = 2
PAD_ID = 0
KEY = 2024
ROUNDS = 4
_ENTRY = np.dtype([("n_ids", "<i4"), ("ids_crc32", "<i8"), ("first", "<i8"), ("pieces", "<i4")])
_PIECE = np.dtype([("doc_id", "<i8"), ("has_id", "?"), ("start", "<i8"), ("length", "<i4")])
_FILES = ("bin", "index", "pieces")
# The sample for the compression's dictionary: texts, characters of each at most, bytes made of it.
SAMPLE_TEXTS = 512
SAMPLE_CHARACTERS = 8000
DICTIONARY_BYTES = 1 << 16
_READ = 256


def permute(numbers: np.ndarray, total: int, key: int = KEY) -> np.ndarray:
    """A keyed bijection of 0 .. total - 1, applied to an array of these numbers."""
    half = max(1, -(-max(total - 1, 1).bit_length() // 2))
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix(np.arange(ROUNDS, dtype=np.uint64) + np.uint64(key << 8))
    result = np.asarray(numbers).astype(np.uint64)
    open_ = np.arange(len(result))
    while len(open_):
        left, right = result[open_] >> shift, result[open_] & mask
        for i in range(ROUNDS):
            left, right = right, left ^ (mix(right ^ keys[i]) & mask)
        result[open_] = left << shift | right
        open_ = open_[result[open_] >= np.uint64(total)]
    return result.astype(np.int64)


class _Stream:
    """The ids of documents one after the other, and which stretch of them is whose."""

    def __init__(self, length: int, kind: str, common: bytes):
        self.length, self.at = length, 0
        self.ids, self.pieces = np.zeros(0, kind), np.zeros(0, _PIECE)
        self.press = zstandard.ZstdCompressor(level=6, dict_data=_dictionary(common))

    def add(self, ids: np.ndarray, sizes: np.ndarray, docs: pa.Array) -> None:
        pieces = np.zeros(len(sizes), _PIECE)
        pieces["doc_id"] = docs.fill_null(0).to_numpy()
        pieces["has_id"] = docs.is_valid().to_numpy(zero_copy_only=False)
        pieces["length"] = sizes
        self.ids = np.concatenate((self.ids, ids))
        self.pieces = np.concatenate((self.pieces, pieces))

    def take(self, part: int, rest: bool = False) -> pa.RecordBatch:
        """All whole sequences, and what is left as a shorter one if it is the ``rest``."""
        count = -(-len(self.ids) // self.length) if rest else len(self.ids) // self.length
        begins = np.concatenate(([0], np.cumsum(self.pieces["length"], dtype=np.int64)))
        cuts = np.union1d(begins, np.arange(0, len(self.ids), self.length))
        own = np.searchsorted(begins, cuts[:-1], side="right") - 1
        pieces = self.pieces[own]
        pieces["start"] += cuts[:-1] - begins[own]
        pieces["length"] = np.diff(cuts)
        firsts = np.searchsorted(cuts[:-1], np.arange(count + 1) * self.length)
        packed = []
        for i in range(count):
            ids = self.ids[i * self.length : (i + 1) * self.length]
            raw, listed = ids.tobytes(), pieces[firsts[i] : firsts[i + 1]]
            head = np.array([len(ids), zlib.crc32(raw), len(listed)], "<u4")
            packed.append(self.press.compress(head.tobytes() + listed.tobytes() + raw))
        made = pa.RecordBatch.from_pydict(
            {
                "part": pa.array(np.full(count, part, np.int32)),
                "at": pa.array(np.arange(self.at, self.at + count)),
                "packed": pa.array(packed, pa.binary()),
            }
        )
        self.at += count
        self.ids, self.pieces = self.ids[count * self.length :].copy(), pieces[firsts[-1] :]
        return made


def _dictionary(common: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(common) if common else None


def _common(docs: DataFrame, tokenizer: str, length: int, kind: str) -> bytes:
    """What compression takes for known: a dictionary from the ids of a few texts, or nothing."""
    texts = docs.select(F.substring("text", 1, SAMPLE_CHARACTERS).alias("text")).where("text <> ''")
    column = pa.array([r.text for r in texts.limit(SAMPLE_TEXTS).collect()], pa.string())
    ids = [some.ids.astype(kind) for some in encoder(tokenizer).slices(column)]
    flat = np.concatenate(ids) if ids else np.zeros(0, kind)
    samples = [flat[i : i + length].tobytes() for i in range(0, len(flat), length)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little to learn from
        return b""


def _sequences(tokenizer: str, length: int, end_id: int, kind: str, common: bytes):
    most = np.iinfo(kind).max

    def run(batches):
        slices = encoder(tokenizer).slices
        part, stream = TaskContext.get().partitionId(), _Stream(length, kind, common)
        for batch in batches:
            for some in slices(batch.column(1)):
                ids = np.insert(some.ids, some.ends[1:], end_id)
                if ids.max() > most:
                    raise ValueError(f"id {ids.max()} does not fit into {kind}")
                sizes = np.diff(some.ends) + 1
                stream.add(ids.astype(kind), sizes, batch.column(0).slice(some.first, len(sizes)))
                yield stream.take(part)
        yield stream.take(part, rest=True)

    return run


def training_order(
    docs: DataFrame,
    tokenizer: str,
    length: int = LENGTH,
    per_shard: int = PER_SHARD,
    key: int = KEY,
    end_id: int = END_ID,
    pad_id: int = PAD_ID,
    kind: str = "<u2",
) -> DataFrame:
    """A row per sequence, in slot order within every shard: slot, shard, byte_offset, n_ids,
    ids_crc32, doc_ids, starts, lengths, record.

    ``doc_ids``, ``starts`` and ``lengths`` list the stretches of documents in the record, in order: whose
    it is, its document's ids before it, and its number of ids. ``kind`` is the numpy type of an id; an
    id that does not fit is an error. ``ids_crc32`` covers the ids without padding. A null or empty
    text has the end id alone; rows with one doc_id are separate documents; a null doc_id is kept. An
    empty table gives no rows. Columns other than doc_id and text are not read.
    """
    common = _common(docs, tokenizer, length, kind)
    stored = materialize(
        docs.select("doc_id", "text").mapInArrow(
            _sequences(tokenizer, length, end_id, kind, common),
            "part int, at long, packed binary",
        ),
        "sequences",
    )
    sizes = stored.groupBy("part").agg(F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A row per task of the first pass.
    offsets = materialize(
        sizes.select("part", (F.sum("rows").over(before) - F.col("rows")).alias("before"), "rows"),
        "offsets",
    )
    parts, total = offsets.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    total = max(total, 1)

    @F.pandas_udf("long")
    def slot_of(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), total, key))

    placed = lookup(stored, offsets.select("part", "before"), ["part"], parts, "at")
    placed = placed.withColumn("slot", slot_of(F.col("before") + F.col("at")))
    shards = -(-total // per_shard)
    shard = F.floor(F.col("slot") / per_shard)
    ordered = placed.select("slot", "packed").repartitionByRange(shards, shard).sortWithinPartitions("slot")
    return ordered.mapInArrow(_unpacked(length, per_shard, pad_id, kind, common), _READ_SCHEMA)


def _unpacked(length: int, per_shard: int, pad_id: int, kind: str, common: bytes):
    """The whole rows of (slot, packed), their records padded."""

    def run(batches):
        pad = np.full(length, pad_id, kind).tobytes()
        press = zstandard.ZstdDecompressor(dict_data=_dictionary(common))
        for batch in batches:
            slots = batch.column(0).to_numpy()
            heads, pieces, records = [], [], []
            for raw in map(press.decompress, batch.column(1).to_pylist()):
                head = np.frombuffer(raw, "<u4", 3)
                begin = head.nbytes + int(head[2]) * _PIECE.itemsize
                heads.append(head)
                pieces.append(raw[head.nbytes : begin])
                records.append(raw[begin:] + pad[len(raw) - begin :])
            heads = np.array(heads, np.int64).reshape(-1, 3)
            yield _rows(
                slots,
                per_shard,
                len(pad),
                heads[:, 0],
                heads[:, 1],
                np.concatenate(([0], np.cumsum(heads[:, 2]))),
                np.frombuffer(b"".join(pieces), _PIECE),
                pa.array(records, pa.binary()),
            )

    return run


def _rows(
    slots: np.ndarray,
    per_shard: int,
    stride: int,
    n_ids: np.ndarray,
    crcs: np.ndarray,
    firsts: np.ndarray,
    pieces: np.ndarray,
    records: pa.Array,
) -> pa.RecordBatch:
    """Rows of _READ_SCHEMA; the pieces of row i are those from ``firsts[i]`` to ``firsts[i + 1]``."""
    lists = [
        pa.array(pieces["doc_id"].copy(), mask=~pieces["has_id"]),
        pa.array(pieces["start"].copy()),
        pa.array(pieces["length"].copy()),
    ]
    columns = [slots, slots // per_shard, slots % per_shard * stride, n_ids.astype(np.int32), crcs]
    return pa.RecordBatch.from_arrays(
        [
            *[pa.array(x) for x in columns],
            *[pa.ListArray.from_arrays(firsts.astype(np.int32), x) for x in lists],
            records,
        ],
        names=_READ_NAMES,
    )


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that driver and executors share, and the folder's path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


class _ShardFile:
    """A shard in the making, under names of its own until it is whole."""

    def __init__(self, path: str, shard: int):
        self.files, folder = _store(path)
        self.shard, self.rows, self.pieces = shard, 0, 0
        self.names = [f"{folder}/shard-{shard:08d}.{kind}" for kind in _FILES]
        self.own = [f"{folder}/_{uuid.uuid4().hex}.part" for _ in self.names]
        self.streams = [self.files.open_output_stream(name) for name in self.own]

    def write(self, rows: pa.RecordBatch) -> None:
        entries = np.zeros(rows.num_rows, _ENTRY)
        lists = {name: rows.column(name) for name in ("doc_ids", "starts", "lengths")}
        docs = lists["doc_ids"].flatten()
        for name in ("n_ids", "ids_crc32"):
            entries[name] = rows.column(name).to_numpy()
        entries["pieces"] = lists["doc_ids"].value_lengths().to_numpy()
        entries["first"] = self.pieces + np.cumsum(entries["pieces"]) - entries["pieces"]
        pieces = np.zeros(len(docs), _PIECE)
        pieces["doc_id"] = docs.fill_null(0).to_numpy()
        pieces["has_id"] = docs.is_valid().to_numpy(zero_copy_only=False)
        pieces["start"] = lists["starts"].flatten().to_numpy()
        pieces["length"] = lists["lengths"].flatten().to_numpy()
        records = b"".join(rows.column("record").to_pylist())
        for stream, raw in zip(self.streams, (records, entries.tobytes(), pieces.tobytes())):
            stream.write(raw)
        self.rows += len(entries)
        self.pieces += len(pieces)

    def close(self) -> None:
        for stream, own, name in zip(self.streams, self.own, self.names):
            stream.close()
            self.files.move(own, name)


def _written(path: str):
    """Writes the shards of a task, whose rows come in slot order; (shard, rows) of each."""

    def run(batches):
        made: _ShardFile | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            shards, places = batch.column("shard").to_numpy(), batch.column("byte_offset").to_numpy()
            stride = len(batch.column("record")[0].as_buffer())
            bounds = np.flatnonzero(np.diff(shards)) + 1
            for low, high in zip([0, *bounds], [*bounds, batch.num_rows]):
                if made is None or made.shard != shards[low]:
                    if made is not None:
                        made.close()
                        yield _count(made)
                    made = _ShardFile(path, int(shards[low]))
                if not np.array_equal(places[low:high], (made.rows + np.arange(high - low)) * stride):
                    raise ValueError(f"shard {made.shard} is not in slot order")
                made.write(batch.slice(low, high - low))
        if made is not None:
            made.close()
            yield _count(made)

    return run


def _count(made: _ShardFile) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"shard": [made.shard], "rows": [made.rows]})


def write_shards(sequences: DataFrame, path: str) -> None:
    """A raw file of records, one of index entries and one of pieces per shard, in a folder that all
    tasks share.

    Files get their names when they are whole, so a task may be tried again. What the folder had
    before goes.
    """
    files, folder = _store(path)
    files.create_dir(folder)
    files.delete_dir_contents(folder)
    sequences.mapInArrow(_written(path), "shard long, rows long").agg(F.sum("rows")).collect()


def read_from(spark: SparkSession, path: str, slot: int, per_shard: int = PER_SHARD) -> DataFrame:
    """The records from a slot on, in slot order: earlier shards are not opened, and the first one is
    read from the slot's byte on. A task reads whole shards, one after the other."""
    files, folder = _store(path)
    found = files.get_file_info(fs.FileSelector(folder))
    names = [i.base_name for i in found if i.base_name.endswith(".bin")]
    shards = 1 + max((int(n.removeprefix("shard-").removesuffix(".bin")) for n in names), default=-1)

    def run(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                first = max(slot - shard * per_shard, 0)
                yield from _records(path, shard, first, per_shard)

    first = min(slot // per_shard, shards)
    numbers = spark.range(first, shards, 1, max(shards - first, 1))
    return numbers.mapInArrow(run, _READ_SCHEMA)


def _records(path: str, shard: int, first: int, per_shard: int):
    """The records of a shard from its ``first`` on, by seeking in its files."""
    files, folder = _store(path)
    streams = [files.open_input_file(f"{folder}/shard-{shard:08d}.{kind}") for kind in _FILES]
    with streams[0] as records, streams[1] as index, streams[2] as pieces:
        rows = index.size() // _ENTRY.itemsize
        stride = records.size() // rows
        records.seek(first * stride)
        index.seek(first * _ENTRY.itemsize)
        for low in range(first, rows, _READ):
            entries = np.frombuffer(index.read(_READ * _ENTRY.itemsize), _ENTRY)
            count = len(entries)
            raw = records.read(count * stride)
            ends = pa.py_buffer((np.arange(count + 1) * stride).astype(np.int32))
            begin, end = entries["first"][0], entries["first"][-1] + entries["pieces"][-1]
            pieces.seek(begin * _PIECE.itemsize)
            yield _rows(
                shard * per_shard + np.arange(low, low + count),
                per_shard,
                stride,
                entries["n_ids"],
                entries["ids_crc32"],
                np.append(entries["first"], end) - begin,
                np.frombuffer(pieces.read((end - begin) * _PIECE.itemsize), _PIECE),
                pa.Array.from_buffers(pa.binary(), count, [None, ends, pa.py_buffer(raw)]),
            )


_READ_SCHEMA = (
    "slot long, shard long, byte_offset long, n_ids int, ids_crc32 long, doc_ids array<long>, "
    "starts array<long>, lengths array<int>, record binary"
)
_READ_NAMES = [field.split()[0] for field in _READ_SCHEMA.split(", ")]
