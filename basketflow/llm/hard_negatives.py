"""Hard negatives by an inverted multi-index.

Vectors of whole numbers are cut into two halves, each with a codebook learned by k-means on a bounded
sample. The codewords of both halves form cells, and an index block is some thousands of vectors in
the order of their cells. For a query, codeword i of a half bounds the half's share of any inner
product by <q, c_i> + |q| r_i, with r_i the greatest distance of the block's vectors from c_i. A heap
visits the cells of a block in descending order of the two bounds' sum (multi-sequence search), scores
their vectors exactly and stops once every window of scores that is asked for is certified: it has
its ``k`` best and no cell left can reach the last of them, or none can reach the window.

Two rounds of the same search: the positives of an anchor (same label, all scores), then its negatives
(another label, one window per positive). Query blocks are sent to every index block of their
dimension, where Python meets them pair by pair; a window function merges the blocks' best.
"""

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm.shared import materialize

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # percent of the positive's score
CODEWORDS = 16  # per half
SAMPLE = 4096  # rows that the codebooks are learned from
BLOCK, QUERY_BLOCK = 8192, 2048
STEP = 1024  # vectors scored together
_NONE = np.iinfo(np.int64).min
_EXACT = 2.0**52  # sums of products below this are exact in double precision
_PARTS = 16

INDEX = "dim int, block int, ids binary, labels binary, vectors binary, cells binary"
QUERIES = "dim int, query_block int, query_ids binary, query_labels binary, query_vectors binary, windows binary"


def codebooks(vectors: np.ndarray, words: int = CODEWORDS, rounds: int = 12) -> list[np.ndarray]:
    """The codewords of both halves, from k-means with seeds far from each other."""
    at, made = vectors.shape[1] // 2, []
    for half in (vectors[:, :at].astype(float), vectors[:, at:].astype(float)):
        centres, away = half[:1], ((half - half[0]) ** 2).sum(axis=1)
        while len(centres) < words and away.max(initial=0) > 0:
            centres = np.concatenate((centres, half[away.argmax()][None]))
            away = np.minimum(away, ((half - centres[-1]) ** 2).sum(axis=1))
        for _ in range(rounds):
            nearest = _nearest(half, centres)
            count = np.bincount(nearest, minlength=len(centres))
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, half)
            centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
        made.append(centres)
    return made


def _nearest(half: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * half @ centres.T).argmin(axis=1)


def cells_of(vectors: np.ndarray, books: list[np.ndarray]) -> np.ndarray:
    at = vectors.shape[1] // 2
    first = _nearest(vectors[:, :at].astype(float), books[0])
    return first * len(books[1]) + _nearest(vectors[:, at:].astype(float), books[1])


class Block:
    """The vectors of an index block by cell, with the radii of the codewords among them."""

    def __init__(self, ids, labels, vectors, cells, books):
        at = vectors.shape[1] // 2
        self.ids, self.labels, self.books, self.at = ids, labels, books, at
        # Doubles are exact unless the numbers are huge, which Python's whole numbers then add up.
        self.longest = float(np.abs(vectors).max(initial=0)) if len(vectors) else 0.0
        self.vectors, self.whole = vectors.astype(float), vectors
        width = len(books[1])
        self.first = np.searchsorted(cells, np.arange(len(books[0]) * width + 1))
        self.radii = []
        halves = (self.vectors[:, :at], cells // width), (self.vectors[:, at:], cells % width)
        for (half, words), book in zip(halves, books):
            away = np.sqrt(((half - book[words]) ** 2).sum(axis=1))
            radius = np.full(len(book), -np.inf)
            np.maximum.at(radius, words, away)
            self.radii.append(radius)

    def bounds(self, query: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(codewords by descending bound, their upper bounds, their lower bounds) of both halves."""
        made = []
        for part, book, radius in zip((query[: self.at], query[self.at :]), self.books, self.radii):
            here = np.flatnonzero(radius >= 0)
            middle = book[here] @ part
            reach = np.sqrt(part @ part) * radius[here]
            slack = 1e-9 * (np.abs(middle) + reach) + 1e-6
            order = np.argsort(-(middle + reach), kind="stable")
            upper, lower = middle + reach + slack, middle - reach - slack
            made.append((here[order], upper[order], lower[order]))
        return made

    def scores(self, at: np.ndarray, query: np.ndarray, whole: np.ndarray) -> np.ndarray:
        biggest = max(self.longest, 1.0) * max(float(np.abs(query).max(initial=0)), 1.0)
        if biggest * len(query) < _EXACT:
            return (self.vectors[at] @ query).astype(np.int64)
        rows = self.whole[at].astype(object)
        return np.array((rows * whole.astype(object)).sum(axis=1), dtype=np.int64)

    def search(self, own, label, same: bool, whole, lows, highs, k: int):
        """(window, id, score) of the ``k`` best per window, and how many vectors were scored.

        Cells are visited in the order of their bounds and scored together, STEP vectors at a time.
        """
        query = whole.astype(float)
        (w1, u1, l1), (w2, u2, l2) = ([x.tolist() for x in half] for half in self.bounds(query))
        width, first = len(self.books[1]), self.first
        best: list[list[tuple[int, int]]] = [[] for _ in lows]
        least = [float(x) for x in lows]  # what a cell has to reach to matter to a window
        lowest, highest = min(least, default=np.inf), max(highs, default=_NONE)
        scored, waiting, parts = 0, 0, []
        heap = [(-(u1[0] + u2[0]), 0, 0)] if w1 and w2 else []
        while True:
            # No cell left, or none that can reach a window that is not certified.
            last = not heap or -heap[0][0] < lowest
            if not last:
                _, a, b = heapq.heappop(heap)
                if b + 1 < len(w2):
                    heapq.heappush(heap, (-(u1[a] + u2[b + 1]), a, b + 1))
                if b == 0 and a + 1 < len(w1):
                    heapq.heappush(heap, (-(u1[a + 1] + u2[0]), a + 1, 0))
                cell = w1[a] * width + w2[b]
                size = first[cell + 1] - first[cell]
                if size and l1[a] + l2[b] <= highest:
                    parts.append(np.arange(first[cell], first[cell + 1]))
                    waiting += size
            if parts and (last or waiting >= STEP):
                at = np.concatenate(parts)
                at = at[((self.labels[at] == label) == same) & (self.ids[at] != own)]
                scored, waiting, parts = scored + len(at), 0, []
                found = self.scores(at, query, whole)
                near = np.flatnonzero((found >= lowest) & (found <= highest))
                at, found = at[near], found[near]
                for w in range(len(lows)):
                    _keep(best[w], k, found, self.ids[at], max(lows[w], least[w]), highs[w])
                    if len(best[w]) == k:
                        least[w] = float(-best[w][-1][0])
                lowest = min(least, default=np.inf)
            if last:
                return [(w, i, -s) for w, kept in enumerate(best) for s, i in kept], scored


def _keep(best: list, k: int, found: np.ndarray, ids: np.ndarray, low: float, high: int) -> None:
    """The ``k`` of highest score, then smallest id, of ``best`` and of those found in the window."""
    at = np.flatnonzero((found >= low) & (found <= high))
    if len(at) > 4 * k:
        at = at[found[at] >= np.partition(found[at], -k)[-k]]
    if len(at):
        best[:] = heapq.nsmallest(k, [*best, *zip((-found[at]).tolist(), ids[at].tolist())])


def _index(rows: DataFrame, books: dict, size: int) -> tuple[DataFrame, dict[int, int]]:
    """Index blocks of the rows of every dimension, stored, and their number."""
    counts = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}
    many = {dim: max(1, -(-n // size)) for dim, n in counts.items()}
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def gather(part: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(part["vector"].to_list()).astype(np.int64)
        cells = cells_of(vectors, shared.value[vectors.shape[1]])
        order = np.lexsort((part["vec_id"], cells))
        return pd.DataFrame(
            {
                "dim": [vectors.shape[1]],
                "block": [part["block"].iloc[0]],
                "ids": [part["vec_id"].to_numpy(np.int64)[order].tobytes()],
                "labels": [part["label"].to_numpy(np.int64)[order].tobytes()],
                "vectors": [_packed(vectors[order])],
                "cells": [cells[order].astype(np.int32).tobytes()],
            }
        )

    # The place in the input deals rows out, so that copies of one row go to different blocks.
    placed = rows.withColumn("block", _dealt(many, F.monotonically_increasing_id()))
    blocks = placed.groupBy("dim", "block").applyInPandas(gather, INDEX)
    return materialize(blocks, "multi-index"), many


def _dealt(many: dict[int, int], key: Column) -> Column:
    number = F.create_map(*[F.lit(x) for pair in many.items() for x in pair])
    return F.pmod(F.xxhash64(key), number[F.col("dim")]).cast("int")


def _packed(vectors: np.ndarray) -> bytes:
    """The narrowest whole numbers that hold them, after a byte with their size."""
    top = max(int(vectors.max(initial=0)), -int(vectors.min(initial=0)) - 1)
    size = 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8
    return bytes([size]) + vectors.astype(f"<i{size}").tobytes()


def _unpacked(raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{raw[0]}", offset=1).reshape(-1, dim).astype(np.int64)


def _search_all(
    index: DataFrame, many: dict, asked: DataFrame, books: dict, same: bool, k: int, size: int
) -> DataFrame:
    """(query_id, window, vec_id, score): the best of every index block for every query.

    ``asked`` has vec_id, label, vector, dim, and lows and highs, the windows of a query.
    """
    counts = {r["dim"]: r["count"] for r in asked.groupBy("dim").count().collect()}
    few = {dim: max(1, -(-n // size)) for dim, n in counts.items()}
    schema = "query_id long, window int, vec_id long, score long"
    if not few:
        return asked.sparkSession.createDataFrame([], schema)
    shared = asked.sparkSession.sparkContext.broadcast(books)

    def gather(part: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(part["vector"].to_list()).astype(np.int64)
        width = part["lows"].map(len).max()
        windows = np.full((len(part), 2, width), _NONE)
        windows[:, 0] = np.iinfo(np.int64).max  # a window that nothing fits
        for at, (lows, highs) in enumerate(zip(part["lows"], part["highs"])):
            windows[at, 0, : len(lows)], windows[at, 1, : len(highs)] = lows, highs
        return pd.DataFrame(
            {
                "dim": [vectors.shape[1]],
                "query_block": [part["query_block"].iloc[0]],
                "query_ids": [part["vec_id"].to_numpy(np.int64).tobytes()],
                "query_labels": [part["label"].to_numpy(np.int64).tobytes()],
                "query_vectors": [_packed(vectors)],
                "windows": [windows.tobytes()],
            }
        )

    placed = asked.withColumn("query_block", _dealt(few, F.col("vec_id")))
    blocks = placed.groupBy("dim", "query_block").applyInPandas(gather, QUERIES)
    to_all = F.create_map(*[F.lit(x) for pair in many.items() for x in pair])
    sent = blocks.withColumn("block", F.explode(F.sequence(F.lit(0), to_all[F.col("dim")] - 1)))

    def run(batches):
        held: tuple = (None, None)
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                if held[0] != (dim, row["block"]):
                    ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
                    cells = np.frombuffer(row["cells"], np.int32).astype(np.int64)
                    block = Block(ids, labels, _unpacked(row["vectors"], dim), cells, shared.value[dim])
                    held = ((dim, row["block"]), block)
                yield _answers(held[1], row, dim, same, k)

    return index.join(sent, ["dim", "block"]).mapInArrow(run, schema)


def _answers(block: Block, row: dict, dim: int, same: bool, k: int) -> pa.RecordBatch:
    ids, labels = (np.frombuffer(row[c], np.int64) for c in ("query_ids", "query_labels"))
    vectors = _unpacked(row["query_vectors"], dim)
    windows = np.frombuffer(row["windows"], np.int64).reshape(len(ids), 2, -1)
    found: list[tuple[int, int, int, int]] = []
    for own, label, vector, (lows, highs) in zip(ids.tolist(), labels.tolist(), vectors, windows):
        best, _ = block.search(own, label, same, vector, lows.tolist(), highs.tolist(), k)
        found += [(own, w, i, s) for w, i, s in best]
    columns = list(zip(*found)) or [(), (), (), ()]
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], names=["query_id", "window", "vec_id", "score"]
    )


def _first(found: DataFrame, k: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def whole_numbers(vector: str, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null where a component is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    floors = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return F.when(F.col(vector).isNotNull() & finite, floors)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    codewords: int = CODEWORDS,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` need vec_id, vector (whole numbers) and label; other columns are not read. Rows with a
    null in one of them, within the vector too, or an empty vector take no part. Vectors meet those of their own
    dimension. Scores are inner products; higher ones come first and ties go by vec_id. The
    positives of an anchor are its first ``positives`` other rows of its label. Per positive, its first
    ``negatives`` rows of other labels whose score is ``low`` to ``high`` percent of the positive's are
    returned; a negative positive score leaves no room for any. A row with the anchor's vec_id is
    neither; of other repeated rows each counts. An anchor that is there several times is answered
    once, by the smallest of its rows in (label, vector). An empty table gives no rows. Scores have
    to fit a BIGINT.
    """
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("vector").isNotNull()
        & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull())
    )
    spark = rows.sparkSession
    valid = rows.select("vec_id", "vector", F.col("label").cast("bigint").alias("label")).where(usable)
    valid = materialize(valid.withColumn("dim", F.size("vector")), "vectors")
    books = _books(valid, codewords)
    schema = (
        "anchor_id long, positive_id long, rank int, negative_id long,"
        " positive_score long, negative_score long"
    )
    if not books:
        return spark.createDataFrame([], schema)
    index, many = _index(valid, books, block)
    smallest = F.min(F.struct("label", "vector", "dim")).alias("_row")
    anchors = valid.where(is_anchor).groupBy("vec_id").agg(smallest).select("vec_id", "_row.*")
    everything = [F.array(F.lit(x).cast("bigint")) for x in (_NONE, np.iinfo(np.int64).max)]
    asked = anchors.withColumns({"lows": everything[0], "highs": everything[1]})
    found = _search_all(index, many, asked, books, True, positives, query_block)
    best = materialize(
        _first(found, positives, "query_id").select(
            "query_id",
            (F.col("rank") - 1).alias("window"),
            F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ),
        "positives",
    )
    # At most ``positives`` windows an anchor, in the order of the positives.
    listed = F.array_sort(F.collect_list(F.struct("window", "positive_score")))
    # Decimals, as the products with percents may not fit a BIGINT.
    parts = [
        F.transform(listed, lambda x: x["positive_score"].cast("decimal(20,0)") * percent / 100)
        for percent in (low, high)
    ]
    windows = best.groupBy(F.col("query_id").alias("vec_id")).agg(
        F.transform(parts[0], lambda x: F.ceil(x).cast("bigint")).alias("lows"),
        F.transform(parts[1], lambda x: F.floor(x).cast("bigint")).alias("highs"),
    )
    found = _search_all(index, many, anchors.join(windows, "vec_id"), books, False, negatives, query_block)
    ranked = _first(found, negatives, "query_id", "window")
    return ranked.join(best, ["query_id", "window"]).select(
        F.col("query_id").alias("anchor_id"),
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _books(valid: DataFrame, codewords: int, rows: int = SAMPLE) -> dict[int, list[np.ndarray]]:
    """The codebooks of every dimension, from the ``rows`` rows of smallest hash of each."""
    digest = F.xxhash64("vec_id", "label", "vector")
    keyed = valid.select("dim", "vector", digest.alias("digest"), F.pmod(digest, F.lit(_PARTS)).alias("part"))
    order = Window.partitionBy("dim", "part").orderBy("digest")
    sample = keyed.withColumn("at", F.row_number().over(order)).where(F.col("at") <= -(-rows // _PARTS))
    vectors: dict[int, list] = {}
    for r in sample.orderBy("dim", "digest").select("dim", "vector").collect():
        vectors.setdefault(r["dim"], []).append(r["vector"])
    return {dim: codebooks(np.array(v, dtype=np.int64), codewords) for dim, v in vectors.items()}
