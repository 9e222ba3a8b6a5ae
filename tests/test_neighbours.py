"""Neighbours, substitutes, personal scores and transitions against plain counts."""

import math
import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from basketflow.operators import affinity, neighbours, scoring, transitions
from basketflow.schemas import CUST

WIDTH = 40


def _histories(seed, n=60, items=30):
    rng, rows = random.Random(seed), []
    for c in range(n):
        x = []
        for _ in range(rng.randint(1, 6)):
            basket = sorted(rng.sample(range(1, items), rng.randint(0, 5)))
            x.append(basket + [0] * (6 - len(basket)))
        rows.append((f"c{c:02d}", x, x[0]))
    return rows


@pytest.fixture(scope="module")
def rows():
    return _histories(3) + [("alone", [[0] * 6], [0]), ("same", [[7, 9, 0]] * 4, [7])]


@pytest.fixture(scope="module")
def examples(spark, rows):
    return spark.createDataFrame(rows, f"{CUST} string, x array<array<int>>, y array<int>").cache()


@pytest.fixture(scope="module")
def baskets(examples):
    return examples.selectExpr("explode(x) as items").cache()


def _counts(rows):
    sets = [{i for i in b if i} for _, x, _ in rows for b in x]
    both, single = Counter(), Counter()
    for s in sets:
        single.update(s)
        both.update(frozenset(p) for p in combinations(s, 2))
    return both, single


def _lists(rows, best):
    both, single = _counts(rows)
    found = defaultdict(list)
    for pair, n in both.items():
        for a, b in (tuple(pair), tuple(pair)[::-1]):
            found[a].append((-round(n / math.sqrt(single[a] * single[b]), 9), b))
    return {a: sorted(x) for a, x in found.items()}


@pytest.mark.parametrize("best", [3, 100])
def test_neighbour_lists_and_what_they_leave_out(baskets, rows, best):
    expected = _lists(rows, best)
    found = defaultdict(list)
    for r in neighbours.item_neighbours(baskets, best).collect():
        found[r.idx].append((r.rank, -r.similarity, r.other, r.cut))
    assert set(found) == set(expected)
    for a, x in expected.items():
        cut = -x[best][0] if len(x) > best else 0.0
        assert sorted(found[a]) == [(i + 1, s, b, cut) for i, (s, b) in enumerate(x[:best])]


@pytest.mark.parametrize("broadcast", [True, False])
def test_scores_miss_no_more_than_the_slack(examples, baskets, rows, broadcast):
    width = WIDTH if broadcast else 1 << 30  # beyond any broadcast
    history = scoring.item_history(examples)
    recency = {(r[CUST], r.idx): r.recency for r in history.collect()}
    lists, whole = _lists(rows, 3), _lists(rows, 100)
    cut, full = Counter(), Counter()
    for (c, i), w in recency.items():
        for s, j in lists.get(i, [])[:3]:
            cut[c, j] -= w * s
        for s, j in whole.get(i, []):
            full[c, j] -= w * s
    kept = neighbours.item_neighbours(baskets, 3)
    found = {(r[CUST], r.idx): r.p for r in neighbours.collaborative_scores(history, kept, width, 3).collect()}
    assert found == pytest.approx(dict(cut), abs=1e-7)
    slack = {r[CUST]: r.slack for r in neighbours.collaborative_slack(history, kept, width, 3).collect()}
    for key, value in full.items():
        assert found.get(key, 0.0) <= value + 1e-7 <= found.get(key, 0.0) + slack[key[0]] + 3e-7
    assert any((c, j) not in recency for c, j in found)


@pytest.mark.parametrize("least", [0.1, 0.35, 0.6])
def test_substitutes_against_all_pairs(baskets, rows, least):
    both, _ = _counts(rows)
    profiles = {}
    for a, x in _lists(rows, 5).items():
        norm = math.sqrt(sum(s * s for s, _ in x[:5]))
        profiles[a] = {b: -s / norm for s, b in x[:5]}
    expected = defaultdict(list)
    for a, b in combinations(sorted(profiles), 2):
        if frozenset((a, b)) not in both:
            s = sum(w * profiles[b].get(k, 0) for k, w in profiles[a].items())
            if s >= least:
                expected[a].append((-s, b))
                expected[b].append((-s, a))
    kept, counted = neighbours.item_neighbours(baskets, 5), affinity.counted_pairs(baskets)
    found = defaultdict(list)
    for r in neighbours.item_substitutes(kept, counted, WIDTH, least, 4, 5).orderBy("idx", "rank").collect():
        found[r.idx].append((-r.similarity, r.other))
    assert set(found) == set(expected) and (least > 0.5 or found)
    for a, x in expected.items():
        assert [s for s, _ in found[a]] == pytest.approx([s for s, _ in sorted(x)[:4]], abs=1e-7)


def test_transitions_and_what_follows(examples, rows):
    shrink, n, from_a, to_b, steps = 2.0, Counter(), Counter(), Counter(), 0
    for _, x, _ in rows:
        for before, after in zip(x, x[1:]):
            before, after, steps = set(before) - {0}, set(after) - {0}, steps + 1
            from_a.update(before)
            to_b.update(after)
            n.update((a, b) for a in before for b in after)
    known = transitions.item_transitions(examples, shrink)
    found = {(r.idx_a, r.idx_b): r for r in known.collect()}
    assert {k: r.n_ab for k, r in found.items()} == dict(n)
    for (a, b), r in found.items():
        share = to_b[b] / steps
        assert (r.n_a, r.n_b) == (from_a[a], to_b[b])
        assert r.p == pytest.approx((n[a, b] + shrink * share) / (from_a[a] + shrink))
        assert r.lift == pytest.approx(r.p / share)
    expected = Counter()
    for c, x, _ in rows:
        last = set(x[-1]) - {0}
        for a in last:
            for (i, b), count in n.items():
                if i == a:
                    expected[c, b] += count / (from_a[a] + shrink) / len(last)
    scores = {(r[CUST], r.idx): r.p for r in transitions.following_scores(examples, known, WIDTH, shrink).collect()}
    assert scores == pytest.approx(dict(expected), abs=1e-7)


def test_nothing_to_learn_from(spark, examples):
    none = examples.limit(0)
    assert transitions.item_transitions(none).count() == 0
    baskets = none.selectExpr("explode(x) as items")
    kept = neighbours.item_neighbours(baskets)
    assert kept.count() == 0
    assert neighbours.item_substitutes(kept, affinity.counted_pairs(baskets), WIDTH).count() == 0
    assert neighbours.collaborative_scores(scoring.item_history(none), kept, WIDTH).count() == 0
