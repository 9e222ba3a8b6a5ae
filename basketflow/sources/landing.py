"""Scans of the CSV files as they arrive."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketflow.schemas import CALENDAR_SCHEMA, TRANSACTIONS_SCHEMA


def read_landing(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(calendar, transactions) found under ``root``; everything else there is ignored."""
    return read_calendar(spark, root), read_transactions(spark, root)


def read_transactions(spark: SparkSession, root: str) -> DataFrame:
    """All files under ``root`` with "transactions" in their path, as one scan.

    The condition on the path is met when files are listed, so no other file is opened.
    """
    root = root.rstrip("/")
    path = F.col("_metadata.file_path")
    calendar = path.endswith(f"{root.rsplit('/', 1)[-1]}/time.csv")
    files = _read_csv(spark, root, TRANSACTIONS_SCHEMA)
    if files is None:
        return _empty(spark, TRANSACTIONS_SCHEMA)
    return files.where(path.contains("transactions") & ~calendar)


def read_calendar(spark: SparkSession, root: str) -> DataFrame:
    files = _read_csv(spark, f"{root.rstrip('/')}/time.csv", CALENDAR_SCHEMA)
    return _empty(spark, CALENDAR_SCHEMA) if files is None else files


def _empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """Header rows and a fixed schema; unreadable fields become null. None if nothing is there."""
    reader = spark.read.option("header", True).option("recursiveFileLookup", True)
    try:
        return reader.schema(schema).csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
