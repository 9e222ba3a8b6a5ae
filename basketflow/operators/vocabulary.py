"""Item vocabulary: the most frequent items, numbered by rank; 0 is the unknown item."""

import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.operators.lookup import lookup
from basketflow.operators.ranking import SINGLE_TASK_ROWS, numbered
from basketflow.schemas import CUST, PAD, PROD, UNKNOWN_ITEM


def item_lines(df: DataFrame) -> DataFrame:
    """The item of every line, repeats and nulls kept."""
    return df.select(PROD)


def item_counts(lines: DataFrame) -> DataFrame:
    """Lines per item; lines without an item count as one more item."""
    return lines.groupBy(PROD).agg(F.count("*").alias("n_lines"))


def vocabulary(lines: DataFrame, num_prods: int) -> DataFrame:
    """(prod_code, idx): the unknown item as 0, then the ``num_prods - 1`` most frequent items.

    Equal counts are ordered by code.
    """
    size = max(num_prods - 1, 0)
    order = [-F.col("n_lines"), F.col(PROD)]
    counts = item_counts(lines)
    if size <= SINGLE_TASK_ROWS:
        counts = counts.orderBy(*order).limit(size)
        ranked = numbered(counts, order, size)
    else:
        ranked = numbered(counts, order, sys.maxsize).where(F.col("pos") < size)
    ranked = ranked.withColumn("idx", F.col("pos") + 1)
    items = ranked.select(F.col(PROD).alias("prod_code"), F.col("idx").cast("int"))
    unknown = lines.sparkSession.createDataFrame([(UNKNOWN_ITEM, PAD)], items.schema)
    return unknown.unionByName(items)


def reverse_vocabulary(vocab: DataFrame) -> DataFrame:
    return vocab.select("idx", "prod_code")


def encode_items(lines: DataFrame, vocab: DataFrame, num_prods: int) -> DataFrame:
    """Add ``idx`` to every line; items outside the vocabulary get 0."""
    codes = vocab.where(F.col("idx") != PAD).withColumnRenamed("prod_code", PROD)
    joined = lookup(lines, codes, [PROD], num_prods, spread=CUST)
    return joined.withColumn("idx", F.coalesce("idx", F.lit(PAD)))


def decode_items(rows: DataFrame, vocab: DataFrame, num_prods: int, spread: str) -> DataFrame:
    """Add ``prod_code`` to rows that carry ``idx``."""
    return lookup(rows, reverse_vocabulary(vocab), ["idx"], num_prods, spread)
