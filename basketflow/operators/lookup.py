"""Joins with a lookup table: broadcast below a known size, salted shuffle above it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Greatest size of a broadcast table, and the rows it allows where a row is a key and a few numbers.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64
BROADCAST_ROWS = BROADCAST_BYTES // ROW_BYTES
SALTS = 32


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    right_rows: int,
    spread: str,
    row_bytes: int = ROW_BYTES,
) -> DataFrame:
    """Left join with ``right``, unique on ``on`` and known to have at most ``right_rows`` rows.

    Beyond the broadcast size both sides are shuffled on the key and a salt taken from the
    ``spread`` column, so that the rows of one hot (or null) key are shared out over many tasks.
    """
    if right_rows * row_bytes <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), on, "left")
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    copies = copies.withColumn("_salt", F.col("_salt").cast("bigint"))
    return salted.join(copies, [*on, "_salt"], "left").drop("_salt")
