"""Mini-batches as a table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.functions.hashing import HASH_SLICES, hash_slice, key_hash
from basketflow.operators.ranking import SAMPLED_SLICES, key_slices, positions
from basketflow.schemas import CUST

SEED = 1234


def batches(
    examples: DataFrame, batch_size: int, passes: int = 1, shuffle: bool = True, seed: int = SEED
) -> DataFrame:
    """Add ``batch_id`` and ``slot``, going through the examples ``passes`` times.

    The passes follow each other without a gap, so a batch may straddle two of them; an incomplete
    last batch is left out. With ``shuffle`` every pass has an order of its own, otherwise the
    order is that of the customers. Every customer is one example.
    """
    if batch_size < 1 or passes < 1:
        raise ValueError("batch_size and passes must be positive")
    if examples.columns != [CUST]:
        # Keys alone are repeated and placed; x and y join their places.
        placed = batches(examples.select(CUST), batch_size, passes, shuffle, seed)
        return placed.join(examples, CUST).select("batch_id", "slot", *examples.columns)
    if not shuffle:
        sliced = key_slices(examples, F.col(CUST))
        placed = positions(sliced, [CUST], SAMPLED_SLICES)
        placed = placed.withColumn("_pass", _passes(passes))
    else:
        repeated = examples.withColumn("_pass", _passes(passes))
        digest = key_hash(seed, F.col("_pass"), F.col(CUST))
        sliced = repeated.withColumn("_order", digest).withColumn(
            "_slice", hash_slice(F.col("_order"))
        )
        placed = positions(sliced, ["_order", CUST], passes * HASH_SLICES, group=("_pass",))
    place = F.col("_pass") * F.col("total") + F.col("pos")
    size = F.lit(batch_size)
    return (
        placed.withColumn("_place", place)
        .withColumn("batch_id", F.floor(F.col("_place") / size).cast("bigint"))
        .withColumn("slot", (F.col("_place") % size).cast("int"))
        .where((F.col("batch_id") + 1) * size <= F.col("total") * passes)
        .select("batch_id", "slot", *examples.columns)
    )


def _passes(passes: int):
    return F.explode(F.sequence(F.lit(0), F.lit(passes - 1)))
