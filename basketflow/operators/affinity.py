"""Which items go together in a basket."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.schemas import PAD
from basketflow.sources.tables import materialize

_BASKET = -1  # stands for the basket itself where entries are counted


def counted_pairs(baskets: DataFrame) -> DataFrame:
    """(a, b, n), stored: baskets with both items for a < b, with the item for a = b.

    ``baskets`` come from ``basket_arrays`` with vocabulary indices, so a basket has fewer than
    ``max_items`` items, and what it adds is bounded. Its pairs are built inside its row and counted
    before the shuffle; baskets are not joined with themselves. There are at most as many results
    as pairs of vocabulary items, and a row (-1, -1) with all baskets. Item 0 takes no part.
    """
    known = F.array_sort(F.array_distinct(F.filter("items", lambda i: i != PAD)))
    sets = baskets.where(F.col("items").isNotNull()).select(known.alias("_set"))

    def with_later(item, at):
        """The item with itself and with each item after it."""
        here_on = F.slice(F.col("_set"), at + 1, F.size("_set"))
        return F.transform(here_on, lambda other: F.struct(item.alias("a"), other.alias("b")))

    whole = F.array(F.struct(F.lit(_BASKET).alias("a"), F.lit(_BASKET).alias("b")))
    # Pairs, single items as pairs with themselves, and baskets, all counted in one pass. The
    # counts are stored, as filters on them would otherwise count the baskets anew.
    entries = F.concat(F.flatten(F.transform("_set", with_later)), whole)
    return materialize(
        sets.select(F.explode(entries).alias("e"))
        .groupBy("e.a", "e.b")
        .agg(F.count("*").alias("n")),
        "pair-counts",
    )


def pairs_with_totals(counted: DataFrame, min_baskets: int = 1) -> DataFrame:
    """(a, b, n_both, n_a, n_b, n_baskets) of the pairs among ``counted_pairs``."""
    pairs = counted.where((F.col("a") < F.col("b")) & (F.col("n") >= min_baskets))
    single = counted.where((F.col("a") == F.col("b")) & (F.col("a") != _BASKET))
    total = counted.where(F.col("a") == _BASKET).select("n").scalar()
    return (
        pairs.withColumnRenamed("n", "n_both")
        .join(single.select("a", F.col("n").alias("n_a")), "a")
        .join(single.select("b", F.col("n").alias("n_b")), "b")
        .withColumn("n_baskets", total)
    )


def item_affinity(baskets: DataFrame, min_baskets: int = 1) -> DataFrame:
    """Support, confidence and lift of the item pairs that share at least ``min_baskets`` baskets."""
    return pairs_with_totals(counted_pairs(baskets), min_baskets).select(
        F.col("a").alias("idx_a"),
        F.col("b").alias("idx_b"),
        "n_both",
        (F.col("n_both") / F.col("n_baskets")).alias("support"),
        (F.col("n_both") / F.col("n_a")).alias("confidence_ab"),
        (F.col("n_both") / F.col("n_b")).alias("confidence_ba"),
        (
            F.col("n_both") * F.col("n_baskets") / (F.col("n_a") * F.col("n_b")).cast("double")
        ).alias("lift"),
    )
