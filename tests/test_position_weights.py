import math
import random

import pytest
from pyspark.sql import functions as F

from basketflow.operators import position_weights as pw
from basketflow.schemas import CUST

WIDTH, AGES = 30, 8


def _rows(seed, n=150):
    """The next basket repeats the newest one, and sometimes the third newest."""
    rng, rows = random.Random(seed), []
    for c in range(n):
        x = [rng.sample(range(1, WIDTH), rng.randint(1, 4)) + [0] for _ in range(rng.randint(1, 7))]
        source = x[-1] if rng.random() < 0.8 or len(x) < 3 else x[-3]
        rows.append((f"c{c}", x, rng.sample(source, 2) + [0]))
    rows += [("bare", [[0, 0]], [3]), ("none", [[2]], [0])]
    return rows


@pytest.fixture(scope="module")
def examples(spark):
    return spark.createDataFrame(_rows(1), f"{CUST} string, x array<array<int>>, y array<int>").cache()


@pytest.fixture(scope="module")
def draws(examples):
    return pw.draws(examples, pw.item_shares(examples, WIDTH), WIDTH)


def _loss(rows, b, shares):
    total = 0.0
    for _, x, y in rows:
        aged = [(age, set(basket) - {0}) for age, basket in enumerate(reversed(x)) if set(basket) - {0}]
        weights = [math.exp(math.tanh(b[age])) for age, _ in aged]
        for i in set(y) - {0}:
            s = sum(w * (i in items) / len(items) for w, (_, items) in zip(weights, aged))
            s = s / sum(weights) if aged else 0.0
            total -= math.log((1 - pw.MIXED) * s + pw.MIXED * shares[i])
    return total


def test_loss_and_gradient(examples, draws):
    shares = {r.idx: r.share for r in pw.item_shares(examples, WIDTH).collect()}
    assert set(shares) == set(range(1, WIDTH)) and sum(shares.values()) == pytest.approx(1)
    rows, b = _rows(1), [0.3 - 0.1 * age for age in range(AGES)]
    found = {r.age: r.value for r in pw.loss_and_gradient(draws, b).collect()}
    assert found.pop(-1) == pytest.approx(_loss(rows, b, shares))
    for age in range(AGES):
        up, down = ([v + d * (j == age) for j, v in enumerate(b)] for d in (1e-5, -1e-5))
        slope = (_loss(rows, up, shares) - _loss(rows, down, shares)) / 2e-5
        assert found.get(age, 0.0) == pytest.approx(slope, abs=1e-4)


def test_fit_beats_even_and_decaying_weights(draws):
    found = pw.fit_positions(draws, AGES, steps=25)
    assert all(a > b for a, b in zip(found.losses, found.losses[1:]))
    assert found.b[0] > 0.5 and found.b[0] > found.b[2] > found.b[1]

    def mean(b):
        total = pw.loss_and_gradient(draws, b).where("age = -1").first().value
        return total / draws.count()

    assert found.loss == pytest.approx(mean(found.b))
    decaying = [math.atanh(0.999 - 0.1 * age) for age in range(AGES)]
    assert found.loss < mean(decaying) < mean([0.0] * AGES)


def test_scores(examples):
    b = [0.5, 0.1, -0.2, 0.0, 0.0, 0.0, 0.0, 0.0]
    found = {(r[CUST], r.idx): r.p for r in pw.position_scores(examples, b).collect()}
    for c, x, _ in _rows(1)[:20]:
        weights = [math.exp(math.tanh(b[age])) for age in range(len(x))]
        for i in set().union(*x):
            p = sum(w for w, basket in zip(weights, reversed(x)) if i in basket) / sum(weights)
            assert found[c, i] == pytest.approx(p, abs=1e-8)


def test_nothing_to_learn_from(examples):
    none = examples.where(F.lit(False))
    rows = pw.draws(none, pw.item_shares(none, WIDTH), WIDTH)
    assert pw.fit_positions(rows, AGES).b == [0.0] * AGES
