"""Parquet and CSV tables that pass data from one stage to the next."""

from os.path import dirname
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from basketflow.schemas import WEEK
from basketflow.session import scratch_path

# For tables with all columns of all lines: takes 0.7 of the space of the default codec.
COMPACT = "zstd"


def write_staged(df: DataFrame, path: str) -> None:
    """Overwrite a staged table, its files grouped by week.

    The rebalance hint clusters rows by week, so that file statistics prune by week, and lets AQE
    cut a week that holds too much data into several files and pack small weeks together.
    """
    df.hint("rebalance", WEEK).write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite", **options) -> None:
    """Overwrite, or by its mode extend, a table of sequences, vocabulary, embeddings or examples."""
    df.write.mode(mode).options(**options).partitionBy(*partition_by).parquet(path)


def materialize(df: DataFrame | list[DataFrame], name: str, **options) -> DataFrame:
    """Store a table that later plans read more than once in the shared scratch folder.

    Unlike a cache it outlives the loss of executors, and readers scan only the columns they use.
    Several tables become one and are stored one after another; with ``shuffles_freed`` the shuffles
    of a single one take space at a time.
    """
    parts = [df] if isinstance(df, DataFrame) else df
    spark = parts[0].sparkSession
    path = scratch_path(spark, name)
    for i, part in enumerate(parts):
        write_table(part, path, mode="append" if i else "overwrite", **options)
    return read_table(spark, path)


def release(df: DataFrame) -> None:
    """Give back the space of a materialized table that nothing reads any more; it stays, without rows."""
    empty = df.sparkSession.createDataFrame([], df.schema)
    for path in {dirname(f) for f in df.inputFiles()}:
        write_table(empty, unquote(path))


def write_examples(examples: DataFrame, path: str) -> None:
    """One folder per split, so that training reads only its own."""
    write_table(examples, path, partition_by=("split",))


def write_csv(df: DataFrame, path: str) -> None:
    """Flat tables as CSV text."""
    df.write.mode("overwrite").option("header", True).csv(path)
