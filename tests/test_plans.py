"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from basketflow import catalog
from basketflow.operators import examples as ex
from basketflow.operators import profiling, sampling, scoring, sequences, vocabulary
from basketflow.schemas import CUST
from basketflow.sources import sample_tables

# Queries that fit a model when they are built.
EAGER = {
    "item_embeddings",
    "item_similarity",
    "basket_vectors",
    "next_basket_predictions",
    "evaluation",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lines") / "t")
    sample_tables.basket_lines(spark, tables).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - EAGER))
def test_no_python_and_no_cartesian_product(spark, tables, name):
    text = plan(catalog.QUERIES[name](spark, tables))
    for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoop"):
        assert word not in text


def test_sample_is_a_filter(stored):
    text = plan(sampling.sample_customers(stored, 0.5))
    assert "Exchange" not in text and "Join" not in text


def test_encoding_needs_no_shuffle_of_the_lines(stored):
    vocab = vocabulary.vocabulary(stored, 50)
    text = plan(vocabulary.encode_items(stored, vocab, 50))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_split_needs_no_shuffle_of_the_rows(stored):
    cuts = ex.split_cuts(sampling.customer_keys(stored))
    text = plan(ex.assign_split(stored, cuts))
    assert "SortMergeJoin" not in text
    assert text.index("BroadcastHashJoin") < text.index("Exchange")


def test_nested_form_limits_groups_before_the_shuffle(stored):
    text = plan(sequences.customer_sequences(stored, 16, 80))
    assert text.count("WindowGroupLimit") == 4 and text.count(", Partial") >= 2
    assert text.count("Exchange hashpartitioning") == 3


def test_ranks_are_limited_before_the_shuffle(stored):
    text = plan(profiling.top_values(stored))
    assert "row_number(), 20, Partial" in text
    scores = stored.select(CUST, F.lit(1).alias("idx"), F.lit(0.5).alias("p"))
    assert "row_number(), 20, Partial" in plan(scoring.top_scored(scores, 20))


def test_only_the_needed_columns_are_read(spark, tables):
    text = plan(vocabulary.vocabulary(sample_tables.basket_lines(spark, tables), 10))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text
    assert "o_custkey" not in text
