"""Profiles of a table with nulls, NaN and all kinds of types."""

import datetime
import math
import random
import statistics
from collections import Counter

import pytest

from basketflow.operators import profiling as prof

ROWS = [
    (1, 1.5, "a", True, datetime.datetime(2024, 1, 1)),
    (2, float("nan"), "a", False, None),
    (3, None, None, None, datetime.datetime(2024, 1, 2)),
    (None, 2.5, "b", True, None),
    (1, 1.5, "a", True, datetime.datetime(2024, 1, 1)),
]
SCHEMA = "i int, f double, s string, b boolean, t timestamp_ntz"


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_column_kinds(mixed):
    assert prof.string_columns(mixed) == ["s"]
    assert prof.numeric_columns(mixed) == ["i", "f"]
    assert [r.type for r in prof.schema_table(mixed).orderBy("position").collect()] == [
        "int",
        "double",
        "string",
        "boolean",
        "timestamp_ntz",
    ]


def test_counts(mixed):
    assert tuple(prof.counts(mixed).first()) == (5, 5)
    assert tuple(prof.duplicate_counts(mixed).first()) == (5, 4)
    names = {"i": "ni", "s": "ns", "b": "nb"}
    assert prof.distinct_counts(mixed, names).first().asDict() == {"ni": 4, "ns": 3, "nb": 3}


def test_duplicates_tell_shifted_values_apart(spark):
    rows = [("a", None), (None, "a"), ("a", ""), ("", "a"), ("1:a", None), ("a-", ""), ("a", "-")]
    df = spark.createDataFrame(rows + rows[:2], "x string, y string")
    assert tuple(prof.duplicate_counts(df).first()) == (9, 7)
    assert tuple(prof.duplicate_counts(df.limit(0)).first()) == (0, 0)


def test_missing_fractions(mixed):
    found = {r.column: r.missing for r in prof.missing_fractions(mixed).collect()}
    assert found == {"i": 0.2, "f": 0.4, "s": 0.2, "b": 0.2, "t": 0.4}
    empty = prof.missing_fractions(mixed.limit(0)).collect()
    assert all(r.missing is None for r in empty)


def test_numeric_profile(mixed, spark):
    found = {r.column: r for r in prof.numeric_profile(mixed).collect()}
    values = [r[0] for r in ROWS if r[0] is not None]
    assert tuple(found["i"])[1:4] == (statistics.mean(values), 3.0, 1.0)
    assert math.isclose(found["i"].stddev, statistics.stdev(values))
    assert set(found) == {"i", "f"}
    single = prof.numeric_profile(spark.createDataFrame([(7,)], "i int")).first()
    assert tuple(single) == ("i", 7.0, 7.0, 7.0, None)
    assert prof.numeric_profile(mixed.select("s")).count() == 0


def test_top_values(spark):
    values = [f"v{i % 37:02d}" for i in range(500)] + ["v05"] * 3 + [None] * 100
    df = spark.createDataFrame([(v, "same") for v in values], "a string, b string")
    found = prof.top_values(df, 5).orderBy("column", "rank").collect()
    expected = sorted(Counter(values).items(), key=lambda e: (-e[1], e[0] or ""))[:5]
    assert [(r.value, r.n) for r in found if r.column == "a"] == expected
    assert [(r.rank, r.value, r.n) for r in found if r.column == "b"] == [(1, "same", 603)]
    assert prof.top_values(df.selectExpr("1 as n")).count() == 0


def test_head(mixed):
    assert prof.head(mixed, 2).count() == 2
    assert [r.i for r in prof.head(mixed, 3, ("i",)).collect()] == [None, 1, 1]


@pytest.mark.parametrize("tracked", [100, 2000])
def test_heavy_values_equal_a_full_count(spark, tracked):
    rng = random.Random(5)
    rows = []
    for i in range(6000):
        common = None if rng.random() < 0.1 else f"v{min(int(rng.expovariate(0.1)), 90):02d}"
        tail = f"h{rng.randint(0, 3)}" if rng.random() < 0.5 else f"t{i}"
        rows.append((common, tail, f"u{i % 3000}", "" if i % 2 else None, i))
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e int")
    for k in (3, 20):
        found = prof.heavy_values(df, k, tracked).collect()
        expected = prof.top_values(df, k).collect()
        assert sorted(map(str, found)) == sorted(map(str, expected))
    assert prof.heavy_values(df.select("e")).count() == 0
    assert prof.heavy_values(df.limit(0)).count() == 0
