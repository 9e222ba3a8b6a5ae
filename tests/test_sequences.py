"""Rollups, vocabulary, encoding and padding against brute force on seeded lines."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from basketflow.operators import sequences as seq
from basketflow.operators import vocabulary as voc
from basketflow.schemas import BASKET, CUST, PROD

NUM_PRODS = 6


@pytest.fixture(scope="module")
def known(purchases):
    """The five commonest items by frequency and code, after the unknown item."""
    counts = Counter(i for _, _, i in purchases)
    ranked = sorted(counts, key=lambda i: (-counts[i], i))[: NUM_PRODS - 1]
    return {"UNK": 0} | {item: n + 1 for n, item in enumerate(ranked)}


@pytest.fixture(scope="module")
def vocab(spark, known):
    return spark.createDataFrame(list(known.items()), "prod_code string, idx int")


def test_nested_sequences(lines, expected):
    rows = seq.customer_sequences(lines, max_items=16, max_seq=80).collect()
    assert {r[CUST]: [set(b) for b in r.baskets] for r in rows} == expected
    assert all(b == sorted(b) for r in rows for b in r.baskets)


def test_long_sequences(lines, expected):
    found = defaultdict(lambda: defaultdict(set))
    for r in seq.basket_sequences(lines).collect():
        found[r[CUST]][r.basket_pos].add(r[PROD])
    assert {c: [b[i] for i in sorted(b)] for c, b in found.items()} == expected
    assert all(sorted(b) == list(range(1, len(b) + 1)) for b in found.values())


@pytest.mark.parametrize("stretch", [2, 1000])
def test_history_adds_up_the_baskets(lines, expected, stretch):
    rows = seq.basket_history(lines, stretch).collect()
    assert len(rows) == sum(map(len, expected.values()))
    for r in rows:
        baskets = expected[r[CUST]][: r.basket_pos]
        assert (r.n_items, r.n_history) == (len(baskets[-1]), sum(map(len, baskets)))


def test_large_baskets_and_long_customers_stay(spark, vocab):
    """A basket of 40 items and a customer of 200 baskets: rows leave nothing out."""
    rows = [("wide", "1", f"i{i:02d}") for i in range(40)]
    rows += [("wide", "2", "i01")]
    rows += [("long", f"{b:04d}", f"i{b % 7:02d}") for b in range(200)]
    rows += [("huge", "1", f"i{i:02d}") for i in range(30)]
    df = spark.createDataFrame(rows, f"{CUST} string, {BASKET} string, {PROD} string")
    places = seq.basket_sequences(df).groupBy(CUST).agg(F.max("basket_pos").alias("last"))
    assert {r[CUST]: r.last for r in places.collect()} == {"wide": 2, "long": 200, "huge": 1}
    indexed = seq.indexed_rows(df, vocab, NUM_PRODS)
    assert indexed.where(f"{CUST} = 'wide' and basket_pos = 1").count() == 40
    last = seq.basket_history(df).where(f"{CUST} = 'long'").orderBy(F.desc("basket_pos")).first()
    assert (last.basket_pos, last.n_history) == (200, 200)
    padded = seq.padded_rows(df, vocab, NUM_PRODS, 16).collect()
    assert sorted(r.basket_pos for r in padded if r[CUST] == "long") == list(range(1, 201))
    assert [r.basket_pos for r in padded if r[CUST] == "wide"] == [1]
    assert [(r.basket_pos, r["items"]) for r in padded if r[CUST] == "huge"] == [(None, None)]
    assert all(len(r["items"]) == 16 for r in padded if r["items"] is not None)


def test_item_lines_keep_repeats(lines, purchases):
    assert voc.item_lines(lines).count() == len(purchases)


def test_vocabulary(lines, known):
    found = voc.vocabulary(lines, NUM_PRODS)
    assert {r.prod_code: r.idx for r in found.collect()} == known
    reverse = voc.reverse_vocabulary(found)
    assert {r.idx: r.prod_code for r in reverse.collect()} == {i: p for p, i in known.items()}


def test_large_vocabulary_is_ranked_in_slices(spark, monkeypatch):
    rng = random.Random(5)
    items = [f"P{rng.randint(0, 400):04d}" for _ in range(3000)]
    df = spark.createDataFrame([(i,) for i in items], f"{PROD} string")
    plain = voc.vocabulary(df, 300).collect()
    monkeypatch.setattr(voc, "SINGLE_TASK_ROWS", 10)
    assert sorted(voc.vocabulary(df, 300).collect()) == sorted(plain)


def test_encoding(lines, vocab, known, expected):
    """Items in code order; misses are 0, and their number is kept."""
    rows = seq.indexed_sequences(lines, vocab, NUM_PRODS, 16, 80).collect()
    want = {
        c: [[known.get(p, 0) for p in sorted(b)] for b in baskets]
        for c, baskets in expected.items()
    }
    assert {r[CUST]: r.baskets for r in rows} == want


def test_encoding_through_the_salted_join(lines, vocab):
    few = voc.encode_items(lines, vocab, NUM_PRODS)
    many = voc.encode_items(lines, vocab, 10**9)
    assert sorted(few.collect()) == sorted(many.select(few.columns).collect())


def test_decoding(spark, vocab, known):
    rows = spark.createDataFrame([("a", 2), ("a", 0)], f"{CUST} string, idx int")
    named = voc.decode_items(rows, vocab, NUM_PRODS, spread=CUST)
    second = next(item for item, n in known.items() if n == 2)
    assert {r.idx: r.prod_code for r in named.collect()} == {2: second, 0: "UNK"}


def test_basket_padding(spark):
    """Baskets of every size up to beyond the width, and a customer with none left."""
    rng = random.Random(3)
    rows = [(f"k{n}", [[rng.randint(0, 9) for _ in range(m)] for m in range(1, n + 1)]) for n in range(8)]
    rows += [("full", [[1, 2, 3, 4], [5, 6, 7, 8, 9]])]
    df = spark.createDataFrame(rows, f"{CUST} string, baskets array<array<int>>")
    want = {c: [b + [0] * (4 - len(b)) for b in bs if len(b) < 4] for c, bs in rows}
    assert {r[CUST]: r.baskets for r in seq.pad_baskets(df, 4).collect()} == want


def test_bounds_are_strict(lines, expected):
    """Baskets of max_items items and customers of max_seq kept baskets are left out."""
    rows = seq.customer_sequences(lines, max_items=5, max_seq=4).collect()
    found = {r[CUST]: [set(b) for b in r.baskets] for r in rows}
    kept = {c: [b for b in baskets if len(b) < 5] for c, baskets in expected.items()}
    assert found == {c: b for c, b in kept.items() if len(b) < 4}
    assert 0 < len(found) < len(expected)


def test_customer_without_kept_basket_stays(spark):
    df = spark.createDataFrame(
        [("a", "1", p) for p in "xyz"] + [("b", "2", "x")],
        f"{CUST} string, {BASKET} string, {PROD} string",
    )
    rows = seq.customer_sequences(df, max_items=3, max_seq=5).collect()
    assert {r[CUST]: r.baskets for r in rows} == {"a": [], "b": [["x"]]}


def test_null_items_and_null_customers(spark):
    df = spark.createDataFrame(
        [("a", "1", None), ("a", "2", "x"), ("a", "2", None), (None, "3", "y"), (None, "4", "z")],
        f"{CUST} string, {BASKET} string, {PROD} string",
    )
    rows = seq.customer_sequences(df, 16, 80).collect()
    assert {r[CUST]: r.baskets for r in rows} == {"a": [[], ["x"]]}
    rows = seq.customer_sequences(df, 16, 80, anonymous="keep").collect()
    assert {r[CUST]: r.baskets for r in rows} == {"a": [[], ["x"]], None: [["y"], ["z"]]}
    with pytest.raises(ValueError):
        seq.basket_items(df, anonymous="other")


def _skewed(spark):
    """A third of all lines in one basket, a third in one customer, a third of one item."""
    rng = random.Random(7)
    rows = [("hot", "b00000", f"p{rng.randint(0, 300):03d}") for _ in range(2000)]
    rows += [
        ("hot", f"b{rng.randint(0, 900):05d}", f"p{rng.randint(0, 300):03d}") for _ in range(2000)
    ]
    rows += [(f"c{rng.randint(0, 50)}", f"b{rng.randint(0, 400):05d}", "p000") for _ in range(2000)]
    return rows, spark.createDataFrame(rows, f"{CUST} string, {BASKET} string, {PROD} string")


def _positions(rows):
    """Brute force: dense rank of the basket per customer."""
    baskets = defaultdict(set)
    for c, b, _ in rows:
        baskets[c].add(b)
    rank = {c: {b: i + 1 for i, b in enumerate(sorted(bs))} for c, bs in baskets.items()}
    return sorted((c, rank[c][b], b, p) for c, b, p in set(rows))


@pytest.mark.parametrize("heavy_after", [20, 500, 10**6])
def test_positions_of_heavy_customers(spark, heavy_after):
    rows, df = _skewed(spark)
    found = seq.basket_sequences(df, heavy_after=heavy_after)
    assert sorted(tuple(r) for r in found.collect()) == _positions(rows)


def test_nested_form_of_skewed_lines(spark):
    rows, df = _skewed(spark)
    baskets = defaultdict(lambda: defaultdict(set))
    for c, b, p in rows:
        baskets[c][b].add(p)
    expected = {}
    for c, bs in baskets.items():
        kept = [sorted(bs[b]) for b in sorted(bs) if len(bs[b]) < 4]
        if len(kept) < 45:
            expected[c] = kept
    found = seq.customer_sequences(df, max_items=4, max_seq=45).collect()
    assert {r[CUST]: r.baskets for r in found} == expected
    assert "hot" not in expected and len(expected) > 10


def test_result_does_not_depend_on_partitioning(spark):
    _, df = _skewed(spark)
    a = seq.basket_sequences(df.repartition(1), heavy_after=50).collect()
    b = seq.basket_sequences(df.repartition(7, F.rand(1)), heavy_after=50).collect()
    assert sorted(a) == sorted(b)


def test_history_items_as_of(spark, lines, expected):
    occurrences = seq.item_occurrences(lines)
    asked = [(c, b) for c, baskets in expected.items() for b in range(0, len(baskets) + 2)]
    asked += asked[:3] + [("nobody", 1), (None, 1)]
    requests = spark.createDataFrame(asked, "CUST_CODE string, as_of long")
    found = {
        (r.CUST_CODE, r.as_of, r.PROD_CODE): (r.first_pos, r.last_pos, r.times)
        for r in seq.history_items_as_of(occurrences, requests).collect()
    }
    wanted = {}
    for c, baskets in expected.items():
        for b in range(1, len(baskets) + 2):
            for item in set().union(*baskets[:b]):
                at = [i for i, basket in enumerate(baskets[:b], 1) if item in basket]
                wanted[c, b, item] = (at[0], at[-1], len(at))
    assert found == wanted
