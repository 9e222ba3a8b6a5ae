"""Session settings the plans rely on, and the shared scratch folder."""

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE picks partition counts, splits skewed join sides and turns joins with a side that proves
# small at run time into broadcast joins; a static partition count only has to be large enough.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int | str = "*", app: str = "basketflow", **conf) -> SparkSession:
    """A single-node session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as the plan that made them ends, not when the driver collects garbage."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def scratch_root(spark: SparkSession) -> str:
    """The folder shared by all executors: spark.checkpoint.dir.

    Where that is not set, as in tests, a folder below the warehouse serves, which all executors
    share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_scratch")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")
