import numpy as np
from pyspark.sql import functions as F

from basketflow.llm import vector_search as vs
from basketflow.llm.shared import ship

SCHEMA = "vec_id long, embedding array<float>, label int"


def dot(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += float(x) * float(y)
    return total


def by_force(rows, k, is_query):
    found = []
    good = [
        (i, np.array(v, float))
        for i, v in rows
        if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
    ]
    asked = {}
    for q, a in good:
        if is_query(q):
            asked[q] = min(asked.get(q, a), a, key=list)
    for q, a in asked.items():
        scored = [(-dot(a, b), i) for i, b in good if i != q and len(a) == len(b)]
        found += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return found


def table(spark, count, dim=24, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    vectors = (centres[rng.integers(0, 8, count)] + 0.4 * rng.normal(size=(count, dim))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(count + i, vectors[5 % count].tolist()) for i in range(30)]  # ties
    rows += [(9000, None), (9020, [0.0] * dim), (9040, [None] + [1.0] * (dim - 1))]
    rows += [(9060, [float("nan")] * dim), (9080, [float("inf")] * dim), (9100, []), (None, vectors[1 % count].tolist())]
    rows += [(9120, [1.0, 2.0]), (9140, [3.0, 1.0])]
    ship(spark)
    return rows, spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def test_same_as_brute_force_over_several_blocks(spark):
    rows, frame = table(spark, 400)
    got = vs.nearest(frame, F.col("vec_id") % 20 == 0, k=5, block=64).collect()
    assert sorted(tuple(r) for r in got) == sorted(by_force(rows, 5, lambda i: i % 20 == 0))


def test_repeated_rows_and_queries(spark):
    """A near vector that is there 30 times takes 30 places; a query asked twice is answered once."""
    rows, _ = table(spark, 60)
    rows += [rows[7]] * 30 + [rows[20], (40, rows[3][1]), (40, rows[4][1])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = vs.nearest(frame, F.col("vec_id") % 20 == 0, block=32).collect()
    assert sorted(tuple(r) for r in got) == sorted(by_force(rows, 20, lambda i: i % 20 == 0))
    assert sum(r.query_id == 20 for r in got) == 20


def test_fewer_candidates_than_asked_for_and_no_rows(spark):
    rows, frame = table(spark, 3)
    got = vs.nearest(frame.where("vec_id < 3"), F.col("vec_id") == 0, k=20).collect()
    assert [r["rank"] for r in sorted(got, key=lambda r: r["rank"])] == [1, 2]
    assert vs.nearest(frame.limit(0), F.col("vec_id") == 0).count() == 0
    assert vs.nearest(frame, F.lit(False)).count() == 0
    clashing = frame.withColumns({c: F.lit("x") for c in ("dim", "block", "ids", "score", "rank")})
    assert vs.nearest(clashing, F.col("vec_id") == 0, k=3).count() == 3


def test_estimates_stay_within_their_bounds():
    rng = np.random.default_rng(7)
    vectors, queries = rng.normal(size=(500, 64)), rng.normal(size=(40, 64))
    turn = vs.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    codes, lengths, aligned = vs.encode(vectors, turn)
    assert codes.shape == (500, 8)
    guess, bound = vs.estimates(codes, lengths, aligned, queries, turn, error=4.0)
    off = np.abs(guess - queries @ vectors.T)
    assert (off <= bound).mean() > 0.999
    narrow = vs.estimates(codes, lengths, aligned, queries, turn, error=1.9)[1]
    assert (off <= narrow).mean() > 0.9 and abs((guess - queries @ vectors.T).mean()) < 0.1
