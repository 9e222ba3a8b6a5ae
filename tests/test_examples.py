"""Samples, splits, x / y, labels, padding and batches."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from basketflow.operators import batches as bat
from basketflow.operators import examples as ex
from basketflow.operators import sampling
from basketflow.schemas import CUST

NESTED = f"{CUST} string, baskets array<array<int>>"


def _customers(spark, n):
    return spark.range(n).select(F.concat(F.lit("c"), F.col("id")).alias(CUST))


def test_sample_is_a_property_of_the_key(spark):
    df = _customers(spark, 2000).crossJoin(spark.range(2).withColumnRenamed("id", "line"))
    one = sampling.sample_customers(df.repartition(1), 0.3)
    many = sampling.sample_customers(df.repartition(9), 0.3)
    assert sorted(one.collect()) == sorted(many.collect())
    kept = {r[CUST] for r in one.collect()}
    assert 500 < len(kept) < 700 and one.count() == 2 * len(kept)
    for c in list(kept)[:20]:
        assert int(hashlib.md5(f"42|{c}".encode()).hexdigest()[:8], 16) < 0.3 * 2**32


def test_sample_bounds(spark):
    df = _customers(spark, 10).unionByName(spark.createDataFrame([(None,)], f"{CUST} string"))
    assert sampling.sample_customers(df, 1.0).count() == 10
    assert sampling.sample_customers(df, 0.0).count() == 0
    assert sampling.sample_customers(df, 1 - 1e-12).count() == 10
    assert sampling.sample_customers(df, 1e-12).count() == 0
    assert 0 < sampling.sample_customers(_customers(spark, 100), 0.5).count() < 100
    with pytest.raises(ValueError):
        sampling.sample_customers(df, -0.1)


@pytest.mark.parametrize(
    "n, shares, sizes",
    [
        (6, (0.33, 0.33, 0.34), (2, 2, 2)),
        (5, (0.5, 0.3, 0.2), (2, 2, 1)),  # 2.5 rounds to the even 2
        (1000, (0.6, 0.2, 0.2), (600, 200, 200)),
        (10, (0.0, 1.0, 0.0), (0, 10, 0)),
        (10, (1.0, 0.0, 0.0), (10, 0, 0)),
        (12345, (0.1, 0.2, 0.7), (1234, 2470, 8641)),  # 1234.5 to 1234, 3703.5 to 3704
    ],
)
def test_split_sizes_are_exact(spark, n, shares, sizes):
    customers = _customers(spark, n)
    found = ex.split_customers(customers, shares).collect()
    assert len(found) == n and len({r[CUST] for r in found}) == n
    counted = ex.split_sizes(ex.split_customers(customers, shares)).collect()
    count = {r.split: r.n_customers for r in counted}
    assert tuple(count.get(part, 0) for part in ("train", "test", "valid")) == sizes
    digest = {r[CUST]: hashlib.md5(f"1234|{r[CUST]}".encode()).hexdigest() for r in found}
    ranked = sorted(found, key=lambda r: digest[r[CUST]])
    order = ["train"] * sizes[0] + ["test"] * sizes[1] + ["valid"] * sizes[2]
    assert [r.split for r in ranked] == order


def test_split_depends_on_the_seed_only(spark):
    customers = _customers(spark, 500)
    a = ex.split_customers(customers.repartition(1)).collect()
    b = ex.split_customers(customers.repartition(8)).collect()
    c = ex.split_customers(customers, seed=7).collect()
    assert sorted(a) == sorted(b) != sorted(c)


def test_split_rejects_other_sums(spark):
    with pytest.raises(ValueError):
        ex.split_cuts(_customers(spark, 3), (0.5, 0.2, 0.2))


def _sequences(seed, customers=12, width=4, top=7):
    """Customers with two padded baskets and more."""
    rng = random.Random(seed)
    return [
        (f"k{c:02d}", [[rng.randint(0, top) for _ in range(width)] for _ in range(rng.randint(2, 5))])
        for c in range(customers)
    ]


def test_x_y(spark):
    rows = _sequences(2)
    df = ex.x_y(spark.createDataFrame(rows, NESTED), max_seq=9)
    dense = {r[CUST]: r for r in ex.with_multi_hot(df, 8).collect()}
    for c, baskets in rows:
        assert dense[c].x == baskets[:-1]
        assert dense[c].y == [int(i in baskets[-1]) for i in range(9)]
    labels = {(r[CUST], r.idx) for r in ex.labels(df).collect()}
    assert labels == {(c, i) for c, baskets in rows for i in baskets[-1]}
    bare = {(r[CUST], r.idx) for r in ex.labels(df, exclude_pad_label=True).collect()}
    assert bare == {(c, i) for c, i in labels if i}


def test_dense_labels_at_the_ends(spark):
    rows = [("none", []), ("first", [0]), ("last", [5, 5]), ("beyond", [6, -1]), ("all", list(range(6)))]
    df = spark.createDataFrame(rows, f"{CUST} string, y array<int>")
    found = {r[CUST]: r.y for r in ex.with_multi_hot(df, 5).collect()}
    assert found == {c: [int(i in y) for i in range(6)] for c, y in rows}


def test_x_y_needs_two_baskets_and_fewer_than_max_seq(spark):
    rows = [(str(n), [[n]] * n) for n in range(6)]
    df = ex.x_y(spark.createDataFrame(rows, NESTED), max_seq=4)
    assert {r[CUST]: len(r.x) for r in df.collect()} == {"2": 1, "3": 2}


def test_sequence_padding(spark):
    """Present baskets are not touched, whatever their width; sequences of max_seq and more go."""
    rows = _sequences(4) + [("wide", [[1] * 6, [2]]), ("long", [[1]] * 4)]
    df = spark.createDataFrame(rows, NESTED)
    padded = ex.pad_sequences(df, 4, 3, column="baskets").collect()
    want = {c: bs + [[0] * 3] * (4 - len(bs)) for c, bs in rows if len(bs) < 4}
    assert {r[CUST]: r.baskets for r in padded} == want and "long" not in want


def test_checks_count_broken_examples(spark):
    schema = f"{CUST} string, split string, x array<array<int>>, y array<int>"
    rows = [
        ("a", "train", [[1, 0], [0, 0]], [1]),
        ("b", "train", [[1, 0]], [1]),
        ("c", "train", [[1], [0, 0]], [1]),
        ("d", "train", None, [1]),
        ("e", "test", [[1, 0], [0, 0]], None),
    ]
    found = ex.check_examples(spark.createDataFrame(rows, schema), 2, 2).collect()
    assert {r.split: tuple(r)[1:] for r in found} == {"train": (4, 1, 1, 1), "test": (1, 1, 0, 0)}


def test_batches_in_order(spark):
    """Three customers in pairs: the second pair wraps around."""
    rows = [("0", [[1, 2]], [1]), ("1", [[20, 15]], [0]), ("2", [[11, 8]], [1])]
    df = spark.createDataFrame(rows, f"{CUST} string, x array<array<int>>, y array<int>")
    found = bat.batches(df, batch_size=2, passes=2, shuffle=False).orderBy("batch_id", "slot")
    assert [(r.batch_id, r.slot, r[CUST]) for r in found.collect()] == [
        (0, 0, "0"),
        (0, 1, "1"),
        (1, 0, "2"),
        (1, 1, "0"),
        (2, 0, "1"),
        (2, 1, "2"),
    ]
    assert found.first().x == [[1, 2]] and found.first().y == [1]
    short = bat.batches(df, batch_size=2, passes=1, shuffle=False)
    assert sorted(r[CUST] for r in short.collect()) == ["0", "1"]


def test_batches_carry_their_examples(spark):
    rows = _sequences(6, customers=9)
    df = ex.with_multi_hot(ex.x_y(spark.createDataFrame(rows, NESTED), max_seq=9), 8)
    found = bat.batches(df, 4, passes=2, shuffle=False).orderBy("batch_id", "slot").collect()
    assert len(found) == 16
    for place, r in enumerate(found):
        customer, baskets = rows[place % 9]
        assert (r.batch_id, r.slot, r[CUST]) == (place // 4, place % 4, customer)
        assert r.x == baskets[:-1] and r.y == [int(i in baskets[-1]) for i in range(9)]


def test_shuffled_batches(spark):
    df = _customers(spark, 700)
    found = bat.batches(df, batch_size=32, passes=3)
    rows = found.orderBy("batch_id", "slot").collect()
    assert len(rows) == 3 * 700 // 32 * 32
    assert [(r.batch_id, r.slot) for r in rows] == [(i // 32, i % 32) for i in range(len(rows))]
    first, second = [r[CUST] for r in rows[:700]], [r[CUST] for r in rows[700:1400]]
    assert len(set(first)) == len(set(second)) == 700 and first != second


def test_many_rows_in_order(spark):
    """Enough rows for cut points to be drawn from the sample."""
    df = spark.range(30000).select(F.md5(F.col("id").cast("string")).alias(CUST))
    rows = bat.batches(df, 100, shuffle=False).orderBy("batch_id", "slot").collect()
    assert [r[CUST] for r in rows] == sorted(r[CUST] for r in rows) and len(rows) == 30000


def test_batch_arguments(spark):
    with pytest.raises(ValueError):
        bat.batches(_customers(spark, 3), 0)
