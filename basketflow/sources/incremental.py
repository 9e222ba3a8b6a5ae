"""Staging of landing files as they arrive: a new file rewrites the weeks it has lines of, no others.

The staged table is partitioned by week and every row carries the file it came from. A manifest
beside it lists the files whose rows are in the table, by path, length and time of change. A run
compares it with the folder, replaces the rows of new and changed files and removes those of files
that are gone, in the weeks that these touch, and writes the manifest last. A run that was stopped in
between is thereby repeated by the next one, and a run without a change writes nothing.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.schemas import TRANSACTIONS_SCHEMA, WEEK
from basketflow.session import shuffles_freed
from basketflow.sources.landing import read_transactions
from basketflow.sources.tables import COMPACT, materialize, release

SOURCE = "_source"
_PART = "_week"  # the partition column; the week itself stays in the rows
_MANIFEST = "path STRING, length BIGINT, changed TIMESTAMP"
# Lines of the weeks that are rewritten at a time; their shuffle takes some 1 GB.
TURN_LINES = 10_000_000


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, changed) of the transaction files under ``root``; their contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        files = reader.load(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)
    chosen = files.where(F.col("path").contains("transactions"))
    return chosen.select("path", "length", F.col("modificationTime").alias("changed"))


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, or an empty one where none has been written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _manifest(spark: SparkSession, staging: str) -> DataFrame:
    """The entries of the latest run."""
    runs = _stored(spark, f"{staging}/manifest", f"{_MANIFEST}, run BIGINT")
    latest = runs.agg(F.max("run")).scalar()
    return runs.where(F.col("run") == latest)


def _staged(spark: SparkSession, staging: str) -> DataFrame:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRANSACTIONS_SCHEMA)
    return _stored(spark, f"{staging}/lines", f"{columns}, {SOURCE} STRING, {_PART} STRING")


def staged_lines(spark: SparkSession, staging: str) -> DataFrame:
    """All staged lines, without what the table keeps for itself."""
    return _staged(spark, staging).select(*TRANSACTIONS_SCHEMA.names)


def stage_new(spark: SparkSession, root: str, staging: str) -> dict[str, int]:
    """Bring the staged table up to date; how many files changed and how many weeks were rewritten."""
    now = materialize(landed_files(spark, root), "landed")
    known = materialize(_manifest(spark, staging).drop("run"), "manifest")
    entry = ["path", "length", "changed"]
    changed = materialize(
        now.join(known, entry, "left_anti").select("path", F.lit(True).alias("new")).unionByName(
            known.join(now, entry, "left_anti").join(now, "path", "left_anti").select("path", F.lit(False).alias("new"))
        ),
        "changed",
    )
    files = changed.count()
    if not files:
        return {"files": 0, "weeks": 0}
    arrived = changed.where("new").select(F.col("path").alias(SOURCE))
    lines = read_transactions(spark, root).withColumn(SOURCE, F.col("_metadata.file_path"))
    fresh = lines.join(arrived, SOURCE, "left_semi").withColumn(_PART, F.coalesce(F.col(WEEK).cast("string"), F.lit("none")))
    fresh = fresh.select(*TRANSACTIONS_SCHEMA.names, SOURCE, _PART)
    replaced = changed.select(F.col("path").alias(SOURCE))
    path = f"{staging}/lines"
    with shuffles_freed(spark):
        fresh = materialize(fresh, "fresh", compression=COMPACT)
        old = _staged(spark, staging)
        weeks = fresh.select(_PART).union(old.join(replaced, SOURCE, "left_semi").select(_PART)).distinct()
        weeks = materialize(weeks, "weeks")

        def after(share: Column = F.lit(True)) -> DataFrame:
            """The lines that the weeks have from now on; ``share`` is a condition on the week."""
            stay = _staged(spark, staging).where(share).join(weeks, _PART, "left_semi").join(replaced, SOURCE, "left_anti")
            return stay.select(*fresh.columns).unionByName(fresh.where(share))

        filled = materialize(after().groupBy(_PART).agg(F.count("*").alias("n")), "weeks-after")
        turns = -(-(filled.agg(F.sum("n").alias("n")).first()["n"] or 0) // TURN_LINES)
        for i in range(turns):
            # What stays is read where it is overwritten: new files replace a week's when all are written.
            some = after(F.pmod(F.xxhash64(_PART), F.lit(turns)) == i)
            writer = some.hint("rebalance", _PART).write.mode("overwrite").partitionBy(_PART)
            writer.options(partitionOverwriteMode="dynamic", compression=COMPACT).parquet(path)
        emptied = weeks.join(filled, _PART, "left_anti")
        _empty_weeks(spark, path, [r[_PART] for r in emptied.collect()])
        release(fresh)
    number = _stored(spark, f"{staging}/manifest", f"{_MANIFEST}, run BIGINT").agg(F.max("run").alias("n")).first()["n"]
    run = F.lit((number or 0) + 1).cast("bigint")
    now.withColumn("run", run).coalesce(1).write.mode("append").parquet(f"{staging}/manifest")
    return {"files": files, "weeks": weeks.count()}


def _empty_weeks(spark: SparkSession, path: str, weeks: list[str]) -> None:
    """Weeks whose last file is gone: their folders hold an empty file from now on."""
    schema = _staged_schema()
    for week in weeks:  # one per week of removed files
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/{_PART}={week}")


def _staged_schema() -> str:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRANSACTIONS_SCHEMA)
    return f"{columns}, {SOURCE} STRING"
