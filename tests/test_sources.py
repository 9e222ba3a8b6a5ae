"""Landing files, staged tables and the stages from end to end."""

import os

import pytest
from pyspark.sql import functions as F

from basketflow import jobs
from basketflow.operators import profiling
from basketflow.plans import stages
from basketflow.schemas import CALENDAR_SCHEMA, TRANSACTIONS_SCHEMA
from basketflow.session import scratch_path
from basketflow.sources import landing, sample_tables, tables as tab


def _write(path, header, *rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write("\n".join([header, *rows]) + "\n")


def _line(week, cust, basket, prod, spend="1.25"):
    values = dict.fromkeys(TRANSACTIONS_SCHEMA.names, "")
    values.update(SHOP_WEEK=week, CUST_CODE=cust, BASKET_ID=basket, PROD_CODE=prod, SPEND=spend)
    return ",".join(values.values())


@pytest.fixture
def root(tmp_path):
    header = ",".join(TRANSACTIONS_SCHEMA.names)
    root = tmp_path / "landing"
    _write(str(root / "transactions_200607.csv"), header, _line("200607", "c1", "b1", "p1"))
    _write(
        str(root / "transactions_200608.csv"),
        header,
        _line("200608", "c1", "b2", "p1"),
        _line("200608", "c1", "b2", "p1"),
        _line("oops", "c2", "b3", "p2", spend="n/a"),
    )
    _write(str(root / "time.csv"), "SHOP_WEEK,DATE_FROM,DATE_TO", "200607,20060410,20060416")
    _write(str(root / "readme.csv"), "a", "b")
    _write(str(root / "more" / "transactions_3.csv"), header, _line("200609", "c3", "b4", "p3"))
    _write(str(root / "transactions_4" / "part.csv"), header, _line("200610", "c4", "b5", "p4"))
    return str(root)


def test_landing(spark, root):
    calendar, transactions = landing.read_landing(spark, root)
    assert calendar.schema == CALENDAR_SCHEMA and transactions.schema == TRANSACTIONS_SCHEMA
    assert [tuple(r) for r in calendar.collect()] == [(200607, 20060410, 20060416)]
    rows = transactions.orderBy("BASKET_ID").collect()
    assert [(r.SHOP_WEEK, r.SPEND) for r in rows] == [
        (200607, 1.25),
        (200608, 1.25),
        (200608, 1.25),
        (None, None),
        (200609, 1.25),
        (200610, 1.25),
    ]
    assert len(transactions.select("_metadata.file_path").distinct().collect()) == 4


def test_nothing_found_gives_empty_tables(spark, tmp_path):
    for root in (tmp_path, tmp_path / "missing"):
        _check_empty(*landing.read_landing(spark, str(root)))


def _check_empty(calendar, transactions):
    assert calendar.count() == 0 and calendar.schema == CALENDAR_SCHEMA
    assert transactions.count() == 0 and transactions.schema == TRANSACTIONS_SCHEMA


def test_staged_table_round_trip(spark, tables, tmp_path):
    df = sample_tables.transactions(spark, tables)
    tab.write_staged(df, str(tmp_path / "t"))
    again = tab.read_table(spark, str(tmp_path / "t"))
    assert again.schema == TRANSACTIONS_SCHEMA
    assert again.exceptAll(df).count() == 0 and df.exceptAll(again).count() == 0


def test_csv_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    tab.write_csv(df, str(tmp_path / "c"))
    again = spark.read.csv(str(tmp_path / "c"), header=True, schema=df.schema)
    assert sorted(again.collect()) == sorted(df.collect())


def test_scratch_folder_is_the_clusters(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_stages_from_files_to_evaluation(spark, tables, tmp_path):
    land, staging, data, out = (str(tmp_path / p) for p in ("land", "staging", "data", "out"))
    tab.write_csv(sample_tables.transactions(spark, tables), f"{land}/transactions_1")
    tab.write_csv(sample_tables.calendar(spark, tables), f"{land}/time.csv")
    options = ["--num-prods", "50", "--max-items", "8", "--max-seq", "16"]
    options += ["--scratch", str(tmp_path / "scratch")]
    options += ["--sample-rate", "0.9", "--embedding-size", "4"]
    jobs.main(["stage", land, staging])
    jobs.main(["preprocess", staging, data, *options])
    jobs.main(["train", data, out, *options])
    staged = tab.read_table(spark, f"{staging}/trans-data")
    counts = tab.read_table(spark, f"{staging}/profile/trans-data/counts").first()
    assert tuple(counts) == (staged.count(), 22)
    assert tab.read_table(spark, f"{data}/vocabulary").count() == 50
    examples = tab.read_table(spark, f"{data}/examples")
    assert {r.split for r in examples.select("split").distinct().collect()} == {
        "train",
        "test",
        "valid",
    }
    settings = stages.Settings(num_prods=50, max_items=8, max_seq=16)
    dense = stages.padded_examples(examples, settings)
    assert dense.where((F.size("x") != 16) | (F.size("y") != 51)).count() == 0
    assert tab.read_table(spark, f"{out}/embeddings").count() == 51
    for split in ("valid", "test"):
        result = tab.read_table(spark, f"{out}/evaluation/{split}").first()
        assert result.split == split and 0 < result.accuracy <= 1 and result.loss > 0
        assert result.regularization in stages.Settings().regularizations


def test_profile_has_all_tables(spark, tables):
    calendar = sample_tables.calendar(spark, tables)
    found = stages.profile(calendar, stages.CALENDAR_KEYS)
    assert found["head"].count() == 10 and found["numeric"].count() == 3
    assert found["top_values"].count() == 0 and found["missing"].count() == 3
    assert profiling.numeric_columns(calendar) == calendar.columns
