"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as entry_points

duckdb = pytest.importorskip("duckdb")
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def db(tables):
    connection = duckdb.connect()
    for file in sorted(os.listdir(tables)):
        name, _ = os.path.splitext(file)
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{file}'")
    return connection



def _key(row):
    return tuple((v is not None, str(v)) for v in row)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, tables, db, name):
    df = QUERIES[name](spark, tables)
    found = [tuple(r) for r in df.collect()]
    cursor = db.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    assert sorted(df.columns) == sorted(names)
    order = [names.index(c) for c in df.columns]
    expected = [tuple(r[i] for i in order) for r in expected]
    assert len(found) > 0
    assert sorted(found, key=_key) == sorted(expected, key=_key)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["CUST_CODE", "basket_pos", "BASKET_ID", "PROD_CODE"]
    assert df.count() > 0
