"""The personal model: every cell counts, the fit is the optimum, and it knows customers apart."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketflow.operators import neighbours, personal, transitions
from basketflow.schemas import CUST

WIDTH = 14


def _rows(seed, n=120):
    """Customers of two tastes: items 1-6 or 7-12, so a taste's other items are likely next."""
    rng, rows = random.Random(seed), []
    for c in range(n):
        taste = range(1, 7) if c % 2 else range(7, 13)
        baskets = [sorted(rng.sample(taste, rng.randint(1, 3))) for _ in range(rng.randint(2, 4))]
        baskets = [b + [0] * (4 - len(b)) for b in baskets]
        rows.append((f"c{c:03d}", baskets[:-1], baskets[-1]))
    return rows


@pytest.fixture(scope="module")
def parts(spark):
    train = spark.createDataFrame(_rows(1), f"{CUST} string, x array<array<int>>, y array<int>").cache()
    popularity = personal.popularity_of(train, WIDTH)
    near = neighbours.item_neighbours(train.selectExpr("explode(x) as items"), 20)
    known = (near, transitions.item_transitions(train), popularity, WIDTH, 20)
    own = personal.cells(train, *known).cache()
    return train, popularity, known, own, personal.training_rows(train, own, popularity, WIDTH)


def test_rows_stand_for_every_cell(parts):
    train, _, _, own, rows = parts
    counts = {r.y: r.n for r in rows.groupBy("y").agg(F.sum("times").alias("n")).collect()}
    positives = sum(len(set(r.y)) for r in train.collect())
    assert counts == {1: positives, 0: 120 * WIDTH - positives}
    assert own.groupBy(CUST, "idx").count().where("count > 1").isEmpty()
    assert own.where("recency = 0 and neighbours > 0").count() > 0


def test_fit_is_the_optimum(parts):
    *_, rows = parts
    fitted = personal.fit(rows)
    assert max(map(abs, fitted.gradient.values())) < 1e-6 and fitted.steps < 30
    for r in personal.fit_check(rows, fitted).collect():
        assert r.observed == pytest.approx(r.fitted, abs=1e-6)
    # Against a plain gradient check: no step in any direction lowers the loss.
    table = rows.toPandas()
    x = np.column_stack([np.ones(len(table)), table[personal.FEATURES]])
    y, times = table["y"].to_numpy(), table["times"].to_numpy()

    def loss(w):
        z = x @ w
        return (times * (np.logaddexp(0, z) - y * z)).sum() + personal.RIDGE / 2 * (w[1:] ** 2).sum()

    w = np.array(list(fitted.coefficients.values()))
    assert loss(w) == pytest.approx(fitted.loss)
    rng = np.random.default_rng(0)
    assert all(loss(w + 1e-3 * rng.normal(size=len(w))) >= loss(w) for _ in range(20))


def test_fit_of_one_class_and_of_no_rows(parts):
    *_, rows = parts
    fitted = personal.fit(rows.where("y = 0"), steps=20)
    assert fitted.coefficients["intercept"] < -1 and np.isfinite(fitted.loss)
    assert personal.fit(rows.limit(0)).steps == 0


def test_customers_differ_outside_their_history(spark, parts):
    _, popularity, known, _, rows = parts
    test = spark.createDataFrame(
        [("odd", [[1, 2, 0, 0]], [0]), ("even", [[7, 8, 0, 0]], [0])],
        f"{CUST} string, x array<array<int>>, y array<int>",
    )
    own = personal.cells(test, *known, labelled=False)
    scores, background = personal.predict(personal.fit(rows), own, popularity)
    p = {(r[CUST], r.idx): r.p for r in scores.collect()}
    others = {r.idx: r.p for r in background.collect()}
    assert set(others) == set(range(WIDTH)) and all(0 < v < 1 for v in [*p.values(), *others.values()])
    taste = [p.get(("odd", i), others[i]) for i in range(3, 7)]
    other = [p.get(("odd", i), others[i]) for i in range(9, 13)]
    assert min(taste) > max(other)
    best = Counter(c for (c, i), v in p.items() if i in range(3, 7) and v > others[i])
    assert best["odd"] == 4 and best["even"] == 0
