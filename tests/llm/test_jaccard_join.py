import itertools
import random
from collections import Counter

import corpus
import numpy as np
import pytest

from basketflow.llm import jaccard_join as jj


def shingles(value):
    words = corpus.words_of(value, lower=True)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def by_force(rows):
    """(doc_id, set size, smallest doc_id that links reach) of every row, all pairs compared."""
    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            label[find(j)] = find(i)
    best = {}
    for i, r in enumerate(rows):
        ids = best.setdefault(find(i), [])
        if r[0] is not None:
            ids.append(r[0])
    return [(r[0], len(sets[i]), min(best[find(i)], default=None)) for i, r in enumerate(rows)]


def found(docs, **options):
    columns = ("doc_id", "n_shingles", "component_id")
    return [tuple(r[c] for c in columns) for r in jj.jaccard_components(docs, **options).collect()]


@pytest.mark.parametrize("long_lists", [jj.LONG_LISTS, (2,), ()])
def test_same_components_as_all_pairs(docs, long_lists):
    rows = [tuple(r) for r in docs.collect()]
    assert Counter(found(docs, long_lists=long_lists)) == Counter(by_force(rows))


def test_extra_columns_and_empty_table(docs, no_docs):
    assert Counter(found(corpus.clashing(docs))) == Counter(found(docs))
    assert found(no_docs) == []


def test_group_of_near_copies_with_chains(spark):
    """Near copies that link through each other only, beside a passage that many texts share."""
    rng = random.Random(4)
    base, passage = corpus.text(rng, 60).split(), corpus.text(rng, 40)
    rows = []
    for i in range(60):
        words = list(base)
        for at in range(0, 60, 7)[: i % 5]:
            words[(at + i // 5) % 60] = corpus.word(rng) + str(i)
        rows.append((100 - i, " ".join(words), "en", "s", 0))
    rows += [(200 + i, passage + " " + corpus.text(rng, 30), "en", "s", 0) for i in range(40)]
    rows += [(300 + i, passage + " " + corpus.text(rng, 3), "en", "s", 0) for i in range(40)]
    frame = spark.createDataFrame(rows, corpus.SCHEMA)
    assert Counter(found(frame, long_lists=(3, 9))) == Counter(by_force(rows))


def test_at_the_threshold(spark):
    """Three quarters exactly is a link, a little less is not."""
    words = [f"w{i}" for i in range(11)]  # 7 shingles
    rows = [(1, " ".join(words), "en", "s", 0), (2, " ".join(words[:10]), "en", "s", 0)]
    rows += [(3, " ".join(f"v{i}" for i in range(8)), "en", "s", 0)]
    rows += [(4, " ".join(f"v{i}" for i in range(7)), "en", "s", 0)]  # 3 of 4 shingles
    rows += [(5, " ".join(f"u{i}" for i in range(7)), "en", "s", 0)]
    rows += [(6, " ".join(f"u{i}" for i in range(6)), "en", "s", 0)]  # 2 of 3
    assert Counter(found(spark.createDataFrame(rows, corpus.SCHEMA))) == Counter(by_force(rows))


def test_signatures_never_rule_out_too_much():
    rng = np.random.default_rng(1)
    for _ in range(200):
        common = rng.integers(0, 1 << 63, rng.integers(0, 50)).astype(np.uint64)
        a, b = (
            np.unique(np.append(common, rng.integers(0, 1 << 63, rng.integers(1, 200)).astype(np.uint64)))
            for _ in range(2)
        )
        apart = len(np.setxor1d(a, b))
        assert jj._apart(jj._signature(a), jj._signature(b)) <= apart


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "node long, node2 long")
    assert {tuple(r) for r in jj.components(links).collect()} == {(i, 0) for i in range(41)}
