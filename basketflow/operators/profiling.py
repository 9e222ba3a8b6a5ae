"""Profiles of a table, each in a fixed number of passes whatever the number of columns."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def head(df: DataFrame, n: int = 10, order_by: tuple[str, ...] = ()) -> DataFrame:
    """n rows: any, from as few partitions as possible, or the first in the given order."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def schema_table(df: DataFrame) -> DataFrame:
    """(position, column, type, nullable)."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position INT, column STRING, type STRING, nullable BOOLEAN"
    )


def counts(df: DataFrame) -> DataFrame:
    """One row: rows and columns."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def distinct_counts(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row: distinct values of each column under the given name; null counts as a value."""

    def distinct(column: str) -> Column:
        has_null = F.max(F.when(F.col(column).isNull(), 1).otherwise(0))
        return F.count_distinct(column) + F.coalesce(has_null, F.lit(0))

    return df.agg(*[distinct(c).cast("bigint").alias(name) for c, name in columns.items()])


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a row of atomic columns, as binary. Lengths keep the values apart."""

    def marked(column: str) -> Column:
        text = F.col(column).cast("string")
        return F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[marked(c) for c in df.columns]), 256))


def duplicate_counts(df: DataFrame) -> DataFrame:
    """One row: all rows and distinct rows.

    Rows are told apart by their SHA-256, so the shuffle carries 32 bytes per row and not the row.
    """
    rows = df.groupBy(row_digest(df).alias("_digest")).agg(F.count("*").alias("_rows"))
    return rows.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_distinct_rows"),
    )


def missing_fractions(df: DataFrame) -> DataFrame:
    """(column, missing): share of null values, and of NaN in floating-point columns."""

    def is_missing(field) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, (FloatType, DoubleType)):
            return value.isNull() | F.isnan(value)
        return value.isNull()

    shares = [
        F.try_divide(F.count(F.when(is_missing(f), 1)), F.count("*")).alias(f.name)
        for f in df.schema
    ]
    wide = df.agg(*shares)
    return wide.unpivot([], wide.columns, "column", "missing")


def numeric_profile(df: DataFrame) -> DataFrame:
    """(column, mean, max, min, stddev) of every numeric column; stddev is that of a sample."""
    measures = {"mean": F.avg, "max": F.max, "min": F.min, "stddev": F.stddev}
    profiles = [
        F.struct(
            F.lit(c).alias("column"),
            *[measure(c).cast("double").alias(name) for name, measure in measures.items()],
        )
        for c in numeric_columns(df)
    ]
    if not profiles:
        empty = "column STRING, mean DOUBLE, max DOUBLE, min DOUBLE, stddev DOUBLE"
        return df.sparkSession.createDataFrame([], empty)
    return df.agg(F.array(*profiles).alias("_all")).select(F.inline("_all"))


def top_values(df: DataFrame, k: int = 20) -> DataFrame:
    """(column, rank, value, n): the k most frequent values of every string column.

    Null is a value; equal counts are ordered by value. Values are counted before the shuffle,
    and the limit on the rank is applied in every task before the ranks of a column meet.
    """
    names = string_columns(df)
    if not names:
        schema = "column STRING, rank INT, value STRING, n BIGINT"
        return df.sparkSession.createDataFrame([], schema)
    best_first = Window.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_first("value"))
    return (
        df.select(*names)
        .unpivot([], names, "column", "value")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
        .withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= k)
        .select("column", "rank", "value", "n")
    )


TRACKED = 10_000
# Fixed value: the error of a frequent-items summary is at most this share of its rows per entry of
# its table, which has 4/3 times as many entries as items are tracked; an item that is not reported
# has at most twice the error.
_ERROR_PER_ENTRY = 3.5


def heavy_values(df: DataFrame, k: int = 20, tracked: int = TRACKED) -> DataFrame:
    """``top_values`` without a shuffle of all distinct values.

    A first pass keeps a frequent-items summary of ``tracked`` values per string column, which tasks
    merge, so its size does not depend on the values. Only the values it reports are counted exactly
    in a second pass. They have the k most frequent of a column if the k-th count is above what any
    other value can have: the error bound of the summary, or the rows that are not of the reported
    values. Columns where that cannot be shown, such as keys of near equal counts, are counted in full.
    """
    names = string_columns(df)
    if not names:
        return top_values(df, k)
    listed = 5 * k
    found = df.agg(
        F.count("*").alias("_rows"),
        *[F.expr(f"approx_top_k(`{c}`, {listed}, {max(tracked, listed)})").alias(f"_{i}") for i, c in enumerate(names)],
    ).first()
    # At most 5 * k values a column reach the driver.
    reported = [(c, entry[0], entry[1]) for i, c in enumerate(names) for entry in found[f"_{i}"] or []]
    spark = df.sparkSession
    schema = "_column STRING, _value STRING, _estimate BIGINT"
    candidates = spark.createDataFrame(reported, schema)
    same = (F.col("column") == F.col("_column")) & F.col("value").eqNullSafe(F.col("_value"))
    counted = (
        df.select(*names)
        .unpivot([], names, "column", "value")
        .join(F.broadcast(candidates.drop("_estimate")), same)
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    counts = counted.collect()
    error = 2 * _ERROR_PER_ENTRY * found["_rows"] / (max(tracked, listed) / 0.75)
    proven, rows = [], []
    for c in names:
        own = sorted(((r["n"], r["value"]) for r in counts if r["column"] == c), key=lambda x: (-x[0], x[1] is not None, x[1] or ""))
        left = found["_rows"] - sum(n for n, _ in own)
        estimates = [e for name, _, e in reported if name == c]
        bound = max(error, min(estimates)) if len(estimates) >= listed else error
        if left == 0 or (len(own) >= k and own[k - 1][0] > min(bound, left)):
            proven.append(c)
            rows += [(c, i, value, n) for i, (n, value) in enumerate(own[:k], 1)]
    exact = spark.createDataFrame(rows, "column STRING, rank INT, value STRING, n BIGINT")
    others = [c for c in names if c not in proven]
    return exact.unionByName(top_values(df.select(*others), k)) if others else exact
