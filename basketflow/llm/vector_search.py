"""Nearest vectors by inner product with randomly rotated one-bit codes.

A vector is divided by its length, rotated at random and coded by the signs of its components. With
b the code as a unit vector of +-1/sqrt(d), <b, q> / <b, o> estimates the inner product of the unit
vector o with a query q without bias, and the error is below ``error`` * |q| *
sqrt((1 - <b, o>**2) / <b, o>**2 / (d - 1)) but for a share of cases that falls with exp(-error**2).
Codes are stored as packed bits with two numbers per vector, its length and <b, o>.

Every query meets every vector, in blocks: index blocks and query blocks are rows that hold some
thousands of vectors, and each pair of blocks is one row of a join on block numbers. Within a pair
the estimates less their bounds give, for every query, a value that its ``k``-th neighbour reaches;
vectors whose estimate plus bound stays below it are left out, all others are reranked by the inner
products of the original vectors, as one matrix product per block. The pairs' best ``k`` are merged by a window.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm.shared import materialize

NEAREST = 20
ERROR = 4.0
BLOCK = 2048
MOST_TASKS = 4096
SEED = 29
_CHUNK = 256


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same for the same dimension and seed."""
    square = np.random.default_rng(seed).normal(size=(dim, dim))
    q, r = np.linalg.qr(square)
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed bits, lengths, <b, o>) of non-zero vectors."""
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    rotated = (vectors / lengths[:, None]) @ turn.T
    bits = rotated > 0
    aligned = np.abs(rotated).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(bits, axis=1), lengths, aligned


def estimates(codes, lengths, aligned, queries, turn, error: float = ERROR):
    """(estimate, bound) of every query's inner product with every coded vector."""
    dim = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    rotated = (queries @ turn.T).astype(np.float32)
    scale = (lengths / aligned / np.sqrt(dim)).astype(np.float32)
    guess = (rotated @ signs.T) * scale
    spread = np.sqrt(np.maximum(1 - aligned**2, 0)) / aligned / np.sqrt(max(dim - 1, 1))
    size = np.sqrt((queries * queries).sum(axis=1))
    bound = (error * size[:, None] * (lengths * spread)).astype(np.float32)
    return guess, bound + 1e-5 * np.abs(guess) + 1e-6 * bound.max(initial=0)


def exact(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed in double precision from the first component on."""
    total = np.zeros(len(queries))
    for j in range(queries.shape[1]):
        total += queries[:, j] * vectors[:, j]
    return total


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there, finite in every component and not zero."""
    value = F.col(vector)
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(value.isNotNull() & finite & F.exists(value, lambda x: x != 0))


def _blocks(rows: DataFrame, name: str, size: int) -> tuple[DataFrame, int]:
    """(block number, ids, vectors) rows of about ``size`` vectors of one dimension."""
    spread = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(1 << 30))
    counted = rows.groupBy("dim").count().collect()
    each = {r["dim"]: max(1, -(-r["count"] // size)) for r in counted}
    if not each:
        return rows.sparkSession.createDataFrame([], f"dim int, {name} int, ids binary, vectors binary"), each
    number = F.create_map(*[F.lit(x) for pair in each.items() for x in pair])
    placed = rows.withColumn(name, (spread % number[F.col("dim")]).cast("int"))

    def gather(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id")
        return pd.DataFrame(
            {
                "dim": [part["dim"].iloc[0]],
                name: [part[name].iloc[0]],
                "ids": [part["vec_id"].to_numpy(np.int64).tobytes()],
                "vectors": [np.stack(part["embedding"].to_list()).astype(np.float64).tobytes()],
            }
        )

    blocks = placed.groupBy("dim", name).applyInPandas(
        gather, f"dim int, {name} int, ids binary, vectors binary"
    )
    return materialize(blocks, name), each


def index(blocks: DataFrame) -> DataFrame:
    """``blocks`` with the packed codes, lengths and alignments of their vectors."""

    def run(batches):
        for batch in batches:
            codes, lengths, aligned = [], [], []
            for dim, raw in zip(batch.column("dim").to_pylist(), batch.column("vectors").to_pylist()):
                vectors = np.frombuffer(raw).reshape(-1, dim)
                found = encode(vectors, rotation(dim))
                codes.append(found[0].tobytes())
                lengths.append(found[1].tobytes())
                aligned.append(found[2].tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(codes, pa.binary()), pa.array(lengths, pa.binary()), pa.array(aligned, pa.binary())],
                names=[*batch.schema.names, "codes", "lengths", "aligned"],
            )

    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema)
    coded = blocks.mapInArrow(run, f"{names}, codes binary, lengths binary, aligned binary")
    return materialize(coded, "codes")


def _best(k: int, error: float):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield _search(row, k, error)

    return run


def _search(row: dict, k: int, error: float) -> pa.RecordBatch:
    """The ``k`` best vectors of one index block for every query of one query block."""
    dim = row["dim"]
    vectors, queries = (np.frombuffer(row[n]).reshape(-1, dim) for n in ("vectors", "query_vectors"))
    ids, query_ids = (np.frombuffer(row[n], np.int64) for n in ("ids", "query_ids"))
    codes = np.frombuffer(row["codes"], np.uint8).reshape(len(ids), -1)
    lengths, aligned = np.frombuffer(row["lengths"]), np.frombuffer(row["aligned"])
    turn = rotation(dim)
    parts = []
    for low in range(0, len(query_ids), _CHUNK):
        some = queries[low : low + _CHUNK]
        guess, bound = estimates(codes, lengths, aligned, some, turn, error)
        own = query_ids[low : low + _CHUNK, None] == ids
        floor = np.where(own, -np.inf, guess - bound)
        if floor.shape[1] > k:
            reach = np.partition(floor, -k, axis=1)[:, -k]
        else:
            reach = np.full(len(some), -np.inf, np.float32)
        wanted = (guess + bound >= reach[:, None]) & ~own
        # A product of matrices ranks the wanted vectors; those that reach the k-th place, give or
        # take the rounding, are summed again in a fixed order.
        some_vectors = np.flatnonzero(wanted.any(axis=0))
        wanted = wanted[:, some_vectors]
        products = np.where(wanted, some @ vectors[some_vectors].T, -np.inf)
        if products.shape[1] > k:
            slack = 1e-9 * np.abs(products, where=wanted, out=np.zeros_like(products)).max(axis=1)
            kth = np.partition(products, -k, axis=1)[:, -k] - slack
            wanted &= products >= kth[:, None]
        q, v = np.nonzero(wanted)
        v = some_vectors[v]
        scores = exact(some[q], vectors[v])
        order = np.lexsort((ids[v], -scores, q))
        q, v, scores = q[order], v[order], scores[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        kept = nth < k
        parts.append((query_ids[low + q[kept]], ids[v[kept]], scores[kept]))
    columns = [np.concatenate(x) for x in zip(*parts)]
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in columns], names=["query_id", "vec_id", "score"]
    )


def nearest(
    rows: DataFrame, is_query, k: int = NEAREST, error: float = ERROR, block: int = BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows of every query row.

    Rows need vec_id and embedding; others are not read. A vector that is null, empty, zero or has
    a null or non-finite component takes no part, nor does a row without vec_id. Vectors meet those
    of their own dimension. Repeated rows, and rows that share a vec_id, are candidates apart, each
    with a rank of its own; a query's own id is never its neighbour. A query id that is there several
    times is answered once, for the smallest of its vectors.
    Equal scores are ordered by vec_id. An empty table gives no rows.
    """
    valid = usable(rows.select("vec_id", "embedding").where("vec_id is not null"), "embedding")
    valid = valid.withColumn("dim", F.size("embedding"))
    candidates, many = _blocks(valid, "block", block)
    queries = valid.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked, few = _blocks(queries.withColumn("dim", F.size("embedding")), "query_block", block)
    asked = asked.withColumnsRenamed({"ids": "query_ids", "vectors": "query_vectors"})
    if not many or not few:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # Every query block goes to every index block of its dimension, and the other way round.
    to_all = F.create_map(*[F.lit(x) for pair in few.items() for x in pair])
    spread = index(candidates).withColumn(
        "query_block", F.explode(F.sequence(F.lit(0), to_all[F.col("dim")] - 1))
    )
    number = sum(many[dim] * few.get(dim, 0) for dim in many)
    pairs = spread.join(asked, ["dim", "query_block"]).repartition(min(number, MOST_TASKS))
    found = pairs.mapInArrow(_best(k, error), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
