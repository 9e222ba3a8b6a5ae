"""Exact positions in an order without sorting a whole table, or one huge group, in one task.

The rows are cut into slices that keep the order: rows of a lower slice come first. Each slice is
ranked on its own and shifted by the number of rows in the slices before it. Slices come either
from the leading digits of a digest, which are even by nature, or from cut points taken from a
sample of the keys. The sample decides only how even the slices are, never the positions.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.operators.lookup import BROADCAST_ROWS

# Groups with more rows than this, and than 1/PARTS of the table, are cut into slices.
HEAVY_AFTER = 1_000_000
# Wanted number of slices per table. At most PARTS groups can be heavy, and they have about
# PARTS slices together, so tables of heavy groups, cuts and offsets are small enough to broadcast.
PARTS = 16_384
# A table of a known smaller size is numbered by one task.
SINGLE_TASK_ROWS = 100_000
_OVERSAMPLE = 4
_STEP = 128
SAMPLED_SLICES = 2 * PARTS


def positions(
    rows: DataFrame, order: list, slices: int, group: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``pos`` (from 0) and ``total`` to rows that carry an order-keeping ``_slice``.

    ``pos`` counts the rows of the group, or of the table, that come before. ``slices`` is the
    greatest possible number of (group, slice) pairs.
    """
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = (
        rows.groupBy(*group, "_slice")
        .agg(F.count("*").alias("_rows"))
        .select(
            *group,
            "_slice",
            (F.sum("_rows").over(earlier) - F.col("_rows")).alias("_before"),
            F.sum("_rows").over(whole).alias("total"),
        )
    )
    if slices <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    within = Window.partitionBy(*group, "_slice").orderBy(*order)
    return (
        rows.withColumn("_at", F.row_number().over(within) - 1)
        .join(offsets, [*group, "_slice"])
        .withColumn("pos", F.col("_before") + F.col("_at"))
        .drop("_slice", "_before", "_at")
    )


def numbered(rows: DataFrame, order: list, most: int) -> DataFrame:
    """Add ``pos`` (from 0) to a table of at most ``most`` rows, unique on the ``order`` columns.

    The columns are sorted upwards, nulls first.
    """
    if most <= SINGLE_TASK_ROWS:
        return rows.withColumn("pos", F.row_number().over(Window.orderBy(*order)) - 1)
    keyed = rows.withColumn("_order", F.struct(*order))
    sliced = key_slices(keyed, F.col("_order"))
    return positions(sliced, ["_order"], SAMPLED_SLICES).drop("_order", "total")


def key_slices(rows: DataFrame, key: Column) -> DataFrame:
    """Add ``_slice``: about PARTS even slices of the table in the order of a unique ``key``.

    The sample has about four keys per slice and every fourth is a cut, so that there are fewer
    than SAMPLED_SLICES slices.
    """
    total = rows.agg(F.count("*").alias("n")).scalar()
    sample = rows.select(key.alias("_key")).where(
        _uniform("_key") < F.lit(_OVERSAMPLE * PARTS) / F.greatest(total, F.lit(1))
    )
    cuts = sample.agg(F.array_sort(F.collect_list("_key")).alias("_keys")).select(_cuts("_keys"))
    return (
        rows.withColumn("_cuts", cuts.scalar())
        .withColumn("_slice", _slice_of(key))
        .drop("_cuts")
    )


def dense_positions(
    rows: DataFrame, keys: DataFrame, group: str, order: str, heavy_after: int = HEAVY_AFTER
) -> DataFrame:
    """Add ``pos`` (from 1): the dense rank of ``order`` among the rows of the same ``group``.

    ``keys`` holds the same (group, order) pairs as ``rows``, repeats allowed; a narrow scan of
    the source is best, as it is read again to find heavy groups. All its columns decide which
    rows are sampled for cut points, so with the columns that tell rows apart the slices of a
    group get even numbers of rows, not of order keys.
    """
    cuts = _heavy_cuts(keys, group, order, heavy_after)
    before = _heavy_offsets(keys, cuts, group, order)
    sliced = rows.join(F.broadcast(cuts), group, "left").withColumn(
        "_slice", F.coalesce(_slice_of(F.col(order)), F.lit(0))
    )
    within = Window.partitionBy(group, "_slice").orderBy(order)
    return (
        sliced.drop("_cuts")
        .withColumn("_at", F.dense_rank().over(within))
        .join(F.broadcast(before), [group, "_slice"], "left")
        .withColumn("pos", F.coalesce("_before", F.lit(0)) + F.col("_at"))
        .drop("_slice", "_before", "_at")
    )


def _heavy_cuts(keys: DataFrame, group: str, order: str, heavy_after: int) -> DataFrame:
    """(group, _cuts) of the groups too large for one task; usually empty."""
    sizes = keys.groupBy(group).agg(F.count("*").alias("_rows"))
    share = sizes.agg(F.sum("_rows") / PARTS).scalar()
    limit = F.greatest(F.lit(float(heavy_after)), F.coalesce(share, F.lit(0.0)))
    heavy = sizes.withColumn("_limit", limit).where(F.col("_rows") > F.col("_limit"))
    sample = (
        keys.join(F.broadcast(heavy), group)
        .where(_uniform(*keys.columns) < F.lit(_OVERSAMPLE) / F.col("_limit"))
        .select(group, order)
        .dropDuplicates()
    )
    lists = sample.groupBy(group).agg(F.array_sort(F.collect_list(order)).alias("_keys"))
    return lists.select(group, _cuts("_keys"))


def _heavy_offsets(keys: DataFrame, cuts: DataFrame, group: str, order: str) -> DataFrame:
    """(group, _slice, _before): distinct order keys in the earlier slices of a heavy group."""
    earlier = Window.partitionBy(group).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        keys.select(group, order)
        .join(F.broadcast(cuts), group)
        .withColumn("_slice", _slice_of(F.col(order)))
        .select(group, order, "_slice")
        .dropDuplicates()
        .groupBy(group, "_slice")
        .agg(F.count("*").alias("_keys"))
        .withColumn("_before", F.sum("_keys").over(earlier) - F.col("_keys"))
        .select(group, "_slice", "_before")
    )


def _uniform(*columns: str) -> Column:
    """A number in [0, 1) that depends on the values alone."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(2**53))


def _cuts(keys: str) -> Column:
    """Cut points from sorted sample keys, and every _STEP-th of them as marks to find them by."""
    cuts = F.filter(keys, lambda _, i: i % _OVERSAMPLE == _OVERSAMPLE - 1)
    step = _OVERSAMPLE * _STEP
    marks = F.filter(keys, lambda _, i: i % step == step - 1)
    return F.struct(cuts.alias("cuts"), marks.alias("marks")).alias("_cuts")


def _slice_of(key: Column) -> Column:
    """Number of cut points at or below the key; null without cut points.

    The marks tell which _STEP cut points to look at, so a search compares some 2 * sqrt(PARTS)
    keys and not PARTS.
    """

    def at_or_below(points: Column) -> Column:
        return F.size(F.filter(points, lambda point: point <= key))

    passed = at_or_below(F.col("_cuts.marks")) * _STEP
    near = F.slice(F.col("_cuts.cuts"), passed + 1, F.lit(_STEP))
    return F.when(F.col("_cuts").isNotNull(), passed + at_or_below(near))
