"""Weights, losses, metrics and rankings against brute force over the dense matrix."""

import math
import random

import pytest

from basketflow.operators import metrics as met
from basketflow.operators import scoring
from basketflow.schemas import CUST

# Three customers, four labels. Label 0 is always set, label 3 never.
Y = {"a": [1, 1, 0, 0], "b": [1, 0, 1, 0], "c": [1, 0, 0, 0]}
P = {"a": [0.9, 0.4, 0.7, 0.0], "b": [0.8, 0.6, 0.9, 0.2], "c": [0.7, 0.1, 0.0, 0.0]}
# Class weights by hand: 3 examples; labels 1 and 2 have one positive each.
W_NEG = [1.0, 0.75, 0.75, 1.0]
W_POS = [1.0, 1.5, 1.5, 1.0]


def _tables(spark, y, p, background=None):
    """Sparse tables of dense lists; scores equal to the background are left out."""
    width = len(next(iter(y.values())))
    base = background or [0.0] * width
    labels = [(c, i) for c, row in y.items() for i, on in enumerate(row) if on]
    scores = [(c, i, v) for c, row in p.items() for i, v in enumerate(row) if v != base[i]]
    return (
        spark.createDataFrame([(c,) for c in y], f"{CUST} string"),
        spark.createDataFrame(labels, f"{CUST} string, idx int"),
        spark.createDataFrame(scores, f"{CUST} string, idx int, p double"),
        spark.createDataFrame(list(enumerate(base)), "idx int, p double") if background else None,
        width,
    )


def _dense(y, p, w_neg, w_pos):
    """(loss, accuracy, precision, recall, f1) by looping over all cells."""
    width = len(next(iter(y.values())))
    loss, right = 0.0, 0
    tp, fp, fn = [0] * width, [0] * width, [0] * width
    for c in y:
        for i in range(width):
            q = min(max(p[c][i], 1e-7), 1 - 1e-7)
            loss += -math.log(q) * w_pos[i] if y[c][i] else -math.log(1 - q) * w_neg[i]
            guess = int(p[c][i] > 0.5)
            right += guess == y[c][i]
            tp[i] += guess and y[c][i]
            fp[i] += guess and not y[c][i]
            fn[i] += y[c][i] and not guess
    cells = len(y) * width

    def mean(parts):
        return sum(a / b if b else 0.0 for a, b in parts) / width

    return (
        loss / cells,
        right / cells,
        mean([(t, t + f) for t, f in zip(tp, fp)]),
        mean([(t, t + f) for t, f in zip(tp, fn)]),
        mean([(2 * t, 2 * t + f + g) for t, f, g in zip(tp, fp, fn)]),
    )


def _top(p, k):
    return {c: sorted(range(len(row)), key=lambda i: (-row[i], i))[:k] for c, row in p.items()}


def test_class_weights(spark):
    examples, labels, _, _, width = _tables(spark, Y, P)
    found = met.class_weights(labels, met.example_count(examples), width).orderBy("idx").collect()
    assert [r.w_neg for r in found] == W_NEG and [r.w_pos for r in found] == W_POS


@pytest.mark.parametrize("weighted", [False, True])
def test_summary_by_hand(spark, weighted):
    examples, labels, scores, _, width = _tables(spark, Y, P)
    n = met.example_count(examples)
    weights = met.class_weights(labels, n, width) if weighted else None
    row = met.summary(met.label_outcomes(labels, scores, n, width, None, weights), n).first()
    ones = [1.0] * width
    expected = _dense(Y, P, W_NEG if weighted else ones, W_POS if weighted else ones)
    assert tuple(row) == pytest.approx(expected)
    assert row.accuracy == pytest.approx(9 / 12)
    # Label precision 1, 0, 1/2, 0; recall 1, 0, 1, 0.
    assert row.precision == pytest.approx(1.5 / 4) and row.recall == pytest.approx(2 / 4)


def test_top_k_by_hand(spark):
    examples, labels, scores, _, width = _tables(spark, Y, P)
    row = met.top_k_metrics(labels, scores, examples, width, k=2).first()
    # Best two: a 0, 2; b 2, 0; c 0, 1. Hits: 1 + 2 + 1 of 5 labels, of 6 predictions.
    assert tuple(row) == pytest.approx((4 / 5, 4 / 6))


def _random_case(seed):
    rng = random.Random(seed)
    width, customers = 40, [f"c{i}" for i in range(25)]
    base = [round(rng.random(), 2) for _ in range(width)]
    y = {c: [int(rng.random() < 0.15) for _ in range(width)] for c in customers}
    p = {c: list(base) for c in customers}
    for c in customers[1:]:  # the first customer has no scores of its own
        for i in rng.sample(range(width), rng.randint(0, 30)):
            p[c][i] = round(rng.random(), 2)
    return y, p, base


@pytest.mark.parametrize("seed", range(3))
def test_sparse_scores_with_background_equal_the_dense_matrix(spark, seed):
    y, p, base = _random_case(seed)
    examples, labels, scores, background, width = _tables(spark, y, p, base)
    n = met.example_count(examples)
    outcomes = met.label_outcomes(labels, scores, n, width, background)
    ones = [1.0] * width
    assert tuple(met.summary(outcomes, n).first()) == pytest.approx(_dense(y, p, ones, ones))
    top = _top(p, 7)
    found = scoring.top_items(scores, examples, 7, width, background).orderBy(CUST, "rank")
    ranked = {}
    for r in found.collect():
        ranked.setdefault(r[CUST], []).append(r.idx)
        assert r.p == p[r[CUST]][r.idx]
    assert ranked == top
    hits = sum(y[c][i] for c, best in top.items() for i in best)
    row = met.top_k_metrics(labels, scores, examples, width, 7, background).first()
    expected = (hits / sum(map(sum, y.values())), hits / (7 * len(y)))
    assert tuple(row) == pytest.approx(expected)


def test_more_ranks_than_labels(spark):
    examples, labels, scores, _, width = _tables(spark, Y, P)
    assert scoring.top_items(scores, examples, 20, width).count() == 12
    assert tuple(met.top_k_metrics(labels, scores, examples, width, 20).first()) == pytest.approx(
        (1.0, 5 / 12)
    )


def test_top_scored(spark):
    _, _, scores, _, _ = _tables(spark, Y, P)
    found = scoring.top_scored(scores, 2).orderBy(CUST, "rank").collect()
    assert [(r[CUST], r.idx) for r in found] == [
        ("a", 0),
        ("a", 2),
        ("b", 2),
        ("b", 0),
        ("c", 0),
        ("c", 1),
    ]


def test_recency(spark):
    schema = f"{CUST} string, x array<array<int>>"
    df = spark.createDataFrame([("a", [[1, 1, 0], [2, 0, 0], [1, 2, 0]])], schema)
    found = {r.idx: r for r in scoring.item_history(df, decay=0.5).collect()}
    weight = [math.exp(-1.0), math.exp(-0.5), 1.0]
    norm = sum(weight) + 1e-7
    expected = {0: sum(weight) / norm, 1: (weight[0] + 1) / norm, 2: (weight[1] + 1) / norm}
    assert {i: r.recency for i, r in found.items()} == pytest.approx(expected, abs=1e-8)
    assert {i: r.frequency for i, r in found.items()} == pytest.approx({0: 1, 1: 2 / 3, 2: 2 / 3})
    assert {i: r.in_last for i, r in found.items()} == {0: 1.0, 1: 1.0, 2: 1.0}


def test_no_examples(spark):
    examples, labels, scores, _, width = _tables(spark, Y, P)
    none = examples.limit(0)
    n = met.example_count(none)
    row = met.summary(met.label_outcomes(labels.limit(0), scores.limit(0), n, width), n).first()
    assert (row.loss, row.accuracy, row.precision) == (None, None, 0.0)
