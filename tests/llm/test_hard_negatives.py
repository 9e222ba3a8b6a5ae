import numpy as np
import pytest
from pyspark.sql import functions as F

from basketflow.llm import catalog
from basketflow.llm import hard_negatives as hn
from basketflow.llm.shared import ship

SCHEMA = "vec_id long, vector array<long>, label int"


def by_force(rows, positives=5, negatives=3):
    good = [r for r in rows if None not in r and r[1] and None not in r[1]]
    firsts = {}
    for i, v, label in good:
        if i % 50 == 0 and (i not in firsts or (label, v) < firsts[i]):
            firsts[i] = (label, v)
    found = []
    for own, (label, v) in firsts.items():
        scored = [
            (-sum(x * y for x, y in zip(v, w)), i, of)
            for i, w, of in good
            if i != own and len(w) == len(v)
        ]
        best = sorted((s, i) for s, i, of in scored if of == label)[:positives]
        for s, p in best:
            window = sorted((t, i) for t, i, of in scored if of != label and 50 * s >= 100 * t >= 95 * s)
            found += [(own, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(window[:negatives])]
    return found


def table(count=420, dim=12, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dim)) * 200
    vectors = np.floor(centres[rng.integers(0, 9, count)] + 60 * rng.normal(size=(count, dim)))
    rows = [(i, [int(x) for x in v], int(rng.integers(0, 4))) for i, v in enumerate(vectors)]
    rows += [(i, rows[7][1], 1) for i in range(1000, 1040)]  # ties
    rows += [rows[50], rows[50], (100, rows[3][1], 0), rows[11], rows[11]]  # repeated rows and ids
    rows += [(2000, None, 1), (2050, [1] * dim, None), (None, [1] * dim, 1), (2100, [], 1)]
    rows += [(2150, [None] + [1] * (dim - 1), 1), (2200, [0] * dim, 2), (2250, [-x for x in rows[0][1]], 3)]
    rows += [(3000, [1], 1), (3001, [4], 1), (3002, [3], 2), (3050, [2, 1], 1), (3051, [4, 4], 9)]
    return rows


def same(got, expected):
    assert sorted(tuple(r) for r in got) == sorted(expected)


def test_same_as_brute_force_over_several_blocks(spark):
    ship(spark)
    rows = table()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = hn.mine(frame, F.col("vec_id") % 50 == 0, codewords=5, block=64, query_block=4)
    same(found.collect(), by_force(rows))


def test_clashing_columns_and_other_numbers(spark):
    rows = table(150, 7, 4)
    names = ("block", "dim", "rank", "score", "window", "lows", "_row", "query_id", "positive_id")
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in names})
    found = hn.mine(frame, F.col("vec_id") % 50 == 0, positives=2, negatives=1)
    same(found.collect(), by_force(rows, 2, 1))


def test_large_numbers_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [int(x) for x in rng.integers(-(1 << 30), 1 << 30, 6)], i % 2) for i in range(60)]
    found = hn.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0)
    same(found.collect(), by_force(rows))


def test_empty_tables(spark):
    frame = spark.createDataFrame(table(), SCHEMA)
    assert hn.mine(frame.limit(0), F.lit(True)).count() == 0
    assert hn.mine(frame, F.lit(False)).count() == 0
    assert hn.mine(frame.where("vec_id = 0"), F.lit(True)).count() == 0


def block_of(rng, count=3000, dim=16, noise=6):
    centres = rng.normal(size=(12, dim)) * 250
    vectors = np.floor(centres[rng.integers(0, 12, count)] + noise * rng.normal(size=(count, dim))).astype(np.int64)
    books = hn.codebooks(vectors[:500])
    cells = hn.cells_of(vectors, books)
    order = np.argsort(cells, kind="stable")
    labels = rng.integers(0, 3, count)
    return hn.Block(np.arange(count)[order], labels[order], vectors[order], cells[order], books), vectors, labels


def test_bounds_hold_and_clustered_vectors_are_left_unscored():
    rng = np.random.default_rng(8)
    block, vectors, labels = block_of(rng)
    shares = []
    for own in range(0, 3000, 100):
        query = vectors[own].astype(float)
        for (words, upper, lower), part, half in zip(
            block.bounds(query), (query[:8], query[8:]), (block.vectors[:, :8], block.vectors[:, 8:])
        ):
            assert (np.diff(upper) <= 1e-6 + 1e-9 * np.abs(upper).max()).all() and (lower <= upper).all()
            assert (half @ part).max() <= upper[0] and (half @ part).min() >= lower.min()
        best, scored = block.search(
            own, labels[own], True, vectors[own], [hn._NONE], [np.iinfo(np.int64).max], 5
        )
        products = vectors @ vectors[own]
        fits = [i for i in np.lexsort((np.arange(3000), -products)) if i != own and labels[i] == labels[own]]
        assert sorted((-s, i) for _, i, s in best) == [(-products[i], i) for i in fits[:5]]
        shares.append(scored / len(fits))
    assert np.mean(shares) < 0.5


def test_a_certified_window_ends_the_search():
    rng = np.random.default_rng(9)
    block, vectors, labels = block_of(rng)
    lows, highs = [10**9], [2 * 10**9]  # no score is that high
    assert block.search(0, 0, False, vectors[0], lows, highs, 3) == ([], 0)


def test_whole_numbers(spark):
    rows = [(1, [0.5, -0.001, 1.0]), (2, [float("nan")]), (3, [None, 1.0]), (4, None), (5, [float("inf")])]
    frame = spark.createDataFrame(rows, "i int, e array<float>")
    found = {r.i: r.v for r in frame.select("i", hn.whole_numbers("e").alias("v")).collect()}
    assert found == {1: [128, -1, 256], 2: None, 3: None, 4: None, 5: None}


@pytest.mark.parametrize("size", [1 << 10, 1 << 20, 1 << 40])
def test_packed_vectors_come_back(size):
    vectors = np.array([[size, -size], [0, 1]], dtype=np.int64)
    assert (hn._unpacked(hn._packed(vectors), 2) == vectors).all()


def test_query_columns(spark, tables):
    found = catalog.op13_hard_negatives(spark, tables)
    assert found.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    assert found.count() > 0
