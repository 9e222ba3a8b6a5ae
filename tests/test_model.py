"""Affinity, embeddings and the model."""

import math
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from basketflow.operators import affinity, embeddings, model
from basketflow.operators import examples as ex
from basketflow.operators.metrics import class_weights, example_count
from basketflow.operators.scoring import top_items
from basketflow.schemas import CUST

WIDTH, MAX_ITEMS, MAX_SEQ = 13, 6, 12


def _baskets(seed, n=150):
    """Customers who buy the same favourites again; items 1 and 2 always go together."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        favourites = rng.sample(range(3, 12), 2)
        baskets = []
        for _ in range(rng.randint(3, 8)):
            items = set(favourites) | {rng.randint(3, 11)}
            if rng.random() < 0.4:
                items |= {1, 2}
            items = sorted(items)[: MAX_ITEMS - 1]
            baskets.append(items + [0] * (MAX_ITEMS - len(items)))
        rows.append((f"c{c:03d}", baskets))
    return rows


@pytest.fixture(scope="module")
def examples(spark):
    df = spark.createDataFrame(_baskets(1), f"{CUST} string, baskets array<array<int>>")
    return ex.x_y(df, MAX_SEQ).cache()


@pytest.fixture(scope="module")
def vectors(spark, examples):
    baskets = examples.select(F.explode("x").alias("items"))
    learned = embeddings.fit_item_embeddings(baskets, MAX_ITEMS, size=8, iterations=3, partitions=2)
    return embeddings.item_embeddings(learned, WIDTH).cache()


def test_affinity(spark):
    baskets = [[0, 1, 2, 3], [1, 2, 0, 0], [2, 3], [1, 1, 4], None, [5], []]
    df = spark.createDataFrame([(b,) for b in baskets], "items array<int>")
    found = {(r.idx_a, r.idx_b): r for r in affinity.item_affinity(df).collect()}
    sets = [{i for i in b if i} for b in baskets if b is not None]
    both = Counter(pair for s in sets for pair in combinations(sorted(s), 2))
    single = Counter(i for s in sets for i in s)
    assert {k: r.n_both for k, r in found.items()} == dict(both)
    for (a, b), r in found.items():
        assert r.support == pytest.approx(both[a, b] / len(sets))
        assert r.confidence_ab == pytest.approx(both[a, b] / single[a])
        assert r.confidence_ba == pytest.approx(both[a, b] / single[b])
        assert r.lift == pytest.approx(both[a, b] * len(sets) / (single[a] * single[b]))
    assert {(r.idx_a, r.idx_b) for r in affinity.item_affinity(df, 2).collect()} == {(1, 2), (2, 3)}


def test_embeddings_have_a_row_per_label(vectors):
    rows = {r.idx: r.vector for r in vectors.collect()}
    assert sorted(rows) == list(range(WIDTH)) and {len(v) for v in rows.values()} == {8}
    assert not any(rows[0]) and not any(rows[12]) and any(rows[3])


@pytest.mark.parametrize("skip_pads", [False, True])
def test_basket_vectors(spark, vectors, skip_pads):
    table = {r.idx: r.vector for r in vectors.collect()}
    schema = f"{CUST} string, basket_pos int, items array<int>"
    rows = [("a", 1, [3, 4, 0]), ("a", 2, [5, 0, 0]), ("b", None, None)]
    df = spark.createDataFrame(rows, schema)
    found = embeddings.basket_vectors(df, vectors, WIDTH, skip_pads).orderBy("basket_pos").collect()
    for row, items in zip(found, ([3, 4], [5])):
        size = len(items) if skip_pads else 3
        expected = [sum(table[i][d] for i in items) / size for d in range(8)]
        assert row.vector == pytest.approx(expected, abs=1e-6)


def test_pair_similarity(spark, vectors):
    table = {r.idx: r.vector for r in vectors.collect()}
    pairs = spark.createDataFrame([(1, 2), (3, 0)], "idx_a int, idx_b int")
    found = {r.idx_a: r.cosine for r in embeddings.pair_similarity(pairs, vectors, WIDTH).collect()}
    a, b = table[1], table[2]
    expected = sum(x * y for x, y in zip(a, b)) / math.sqrt(
        sum(x * x for x in a) * sum(y * y for y in b)
    )
    assert found[1] == pytest.approx(expected) and found[3] == 0.0


@pytest.mark.parametrize("weighted", [False, True])
def test_training_rows_stand_for_every_cell(examples, vectors, weighted):
    """The sums over the weighted rows are those over all customers and labels."""
    popularity = model.item_popularity(examples, WIDTH)
    features = model.own_features(examples, popularity, WIDTH, vectors)
    own = model.own_cells(examples, features)
    data = {r[CUST]: (r.x, set(r.y)) for r in examples.collect()}
    n = len(data)
    positives = Counter(i for _, y in data.values() for i in y)
    weights, w = None, {}
    if weighted:
        weights = class_weights(ex.labels(examples), example_count(examples), WIDTH)
        w = {r.idx: (r.w_neg, r.w_pos) for r in weights.collect()}
    rows = model.training_rows(examples, own, popularity, weights, WIDTH).collect()
    for y in (0, 1):
        count = {i: positives[i] if y else n - positives[i] for i in range(WIDTH)}
        expected = sum(c * w.get(i, (1, 1))[y] for i, c in count.items())
        assert sum(r.weight for r in rows if r.y == y) == pytest.approx(expected)
    owned = sum(len({i for b in x for i in b}) for x, _ in data.values())
    assert sum(1 for r in rows if r.recency > 0) == owned
    assert len(rows) <= owned + 2 * WIDTH
    known = {
        (c, i): int(i in y) for c, (x, y) in data.items() for i in {i for b in x for i in b}
    }
    assert {(r[CUST], r.idx): r.y for r in own.collect()} == known


def test_model_learns_repeat_purchases(spark, examples, vectors, tmp_path):
    fitted, popularity = model.fit_next_basket(
        examples, WIDTH, vectors, use_class_weights=False, iterations=30
    )
    path = str(tmp_path / "model")
    model.save_model(fitted, path)
    scores, background = model.predict(model.load_model(path), examples, popularity, WIDTH, vectors)
    row = model.evaluate(examples, scores, WIDTH, background, k=4).first()
    assert row.accuracy > 0.8 and 0 < row.loss < 0.5
    assert row.recall_top_k > 0.6 and row.precision_top_k > 0.6
    bare = model.evaluate(
        examples, scores, WIDTH, background, k=4, exclude_pad_label=True
    ).first()
    assert bare.accuracy < row.accuracy and bare.recall_top_k == row.recall_top_k
    named = model.evaluate(examples, scores, WIDTH, background, k=4, rank_pad_label=False).first()
    assert named.accuracy == row.accuracy and named.recall_top_k != row.recall_top_k
    without = top_items(scores, examples, 3, WIDTH, background, exclude_pad_label=True)
    assert without.where("idx = 0").isEmpty() and without.count() == 3 * examples.count()
    best = top_items(scores, examples, 3, WIDTH, background)
    assert best.count() == 3 * examples.count()
    assert background.count() == WIDTH
    assert background.where("p < 0 or p > 1").count() == 0

