"""Items that go with an item, items that stand in for it, and personal scores from the former.

An item's neighbours are the items it shares baskets with, by the cosine of their basket sets. Only
the ``best`` of an item are kept, so everything below is of the size of the vocabulary or of the
customers' histories times ``best``; what the cut can cost a score is kept beside it.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.operators.affinity import counted_pairs, pairs_with_totals
from basketflow.operators.lookup import lookup
from basketflow.operators.scoring import SCORE_DIGITS
from basketflow.schemas import CUST, PAD
from basketflow.sources.tables import materialize

BEST = 50
SUBSTITUTES = 10
LEAST_SIMILARITY = 0.2
_ENTRY_BYTES = 16
_SLACK = 1e-9


def item_neighbours(baskets: DataFrame, best: int = BEST) -> DataFrame:
    """(idx, rank, other, n_both, similarity, cut): the ``best`` neighbours of every item, stored.

    ``cut`` is the greatest similarity that an item's list leaves out, 0 if it is whole. Equal
    similarities are ordered by index.
    """
    pairs = pairs_with_totals(counted_pairs(baskets))
    similarity = F.round(F.col("n_both") / F.sqrt(F.col("n_a") * F.col("n_b")), SCORE_DIGITS)
    # Both directions of a pair at once.
    ends = F.array(
        F.struct(F.col("a").alias("idx"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("idx"), F.col("a").alias("other")),
    )
    both = pairs.select("n_both", similarity.alias("similarity"), F.explode(ends).alias("e"))
    order = Window.partitionBy("idx").orderBy(F.desc("similarity"), "other")
    ranked = both.select("e.*", "n_both", "similarity").withColumn("rank", F.row_number().over(order))
    kept = ranked.where(F.col("rank") <= best + 1)
    left_out = F.max(F.when(F.col("rank") > best, F.col("similarity")))
    kept = kept.withColumn("cut", F.coalesce(left_out.over(Window.partitionBy("idx")), F.lit(0.0)))
    columns = ("idx", "rank", "other", "n_both", "similarity", "cut")
    return materialize(kept.where(F.col("rank") <= best).select(*columns), "neighbours")


def _listed(neighbours: DataFrame) -> DataFrame:
    """One row per item: its neighbours as an array, and what the array leaves out."""
    entry = F.struct("other", "similarity")
    return neighbours.groupBy("idx").agg(
        F.array_sort(F.collect_list(entry)).alias("_others"), F.max("cut").alias("_cut")
    )


def _with_neighbours(history: DataFrame, neighbours: DataFrame, num_labels: int, best: int) -> DataFrame:
    known = history.where(F.col("idx") != PAD).select(CUST, "idx", "recency")
    return lookup(known, _listed(neighbours), ["idx"], num_labels, CUST, _ENTRY_BYTES * (best + 4))


def collaborative_scores(
    history: DataFrame, neighbours: DataFrame, num_labels: int, best: int = BEST
) -> DataFrame:
    """(customer, idx, p): similarity of an item to what the customer bought, weighted by recency.

    The product of the sparse history rows of ``item_history`` and the neighbour lists, summed up by
    customer and item; items of the history have a score where they are neighbours of others in it.
    """
    rows = _with_neighbours(history, neighbours, num_labels, best)
    entries = rows.select(CUST, "recency", F.explode("_others").alias("e"))
    p = F.round(F.sum(F.col("recency") * F.col("e.similarity")), SCORE_DIGITS - 1)
    return entries.groupBy(CUST, F.col("e.other").alias("idx")).agg(p.alias("p"))


def collaborative_slack(
    history: DataFrame, neighbours: DataFrame, num_labels: int, best: int = BEST
) -> DataFrame:
    """(customer, slack): what any score of the customer can miss because the lists are cut."""
    rows = _with_neighbours(history, neighbours, num_labels, best)
    slack = F.sum(F.col("recency") * F.coalesce("_cut", F.lit(0.0)))
    return rows.groupBy(CUST).agg(F.round(slack, SCORE_DIGITS - 1).alias("slack"))


def item_substitutes(
    neighbours: DataFrame,
    counted: DataFrame,
    num_labels: int,
    least: float = LEAST_SIMILARITY,
    k: int = SUBSTITUTES,
    best: int = BEST,
) -> DataFrame:
    """(idx, rank, other, similarity): items of like company that never share a basket.

    Similarity is the cosine of two items' neighbour lists, ``least`` or more. Neighbours are
    ordered from the rarest list entry to the commonest, and an item only offers its first ones: as
    soon as the norm of the rest is below ``least``, two items that meet in none of those cannot
    reach it, whatever the rest has in common. So common neighbours, which join everything with
    everything, are mostly left out. Pairs that share a basket by ``counted`` (``counted_pairs``) go.
    """
    norm = F.sqrt(F.sum(F.col("similarity") * F.col("similarity")).over(Window.partitionBy("idx")))
    listed = Window.partitionBy("other")
    order = Window.partitionBy("idx").orderBy("_lists", "other")
    on = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    profile = (
        neighbours.withColumn("_lists", F.count("*").over(listed))
        .withColumn("_w", F.col("similarity") / norm)
        .withColumn("_rest", F.sum(F.col("_w") * F.col("_w")).over(on))
    )
    profile = materialize(profile.select("idx", "other", "_w", "_rest"), "profiles")
    offered = profile.where(F.col("_rest") >= least * least - _SLACK).select("idx", "other")
    met = (
        offered.withColumnRenamed("idx", "a")
        .join(offered.withColumnRenamed("idx", "b"), "other")
        .where(F.col("a") < F.col("b"))
        .select("a", "b")
        .distinct()
    )
    apart = met.join(counted.select("a", "b"), ["a", "b"], "left_anti")
    whole = profile.groupBy("idx").agg(F.array_sort(F.collect_list(F.struct("other", "_w"))).alias("_own"))
    for side in ("a", "b"):
        named = whole.withColumnsRenamed({"idx": side, "_own": f"_{side}"})
        other = "b" if side == "a" else "a"
        apart = lookup(apart, named, [side], num_labels, other, _ENTRY_BYTES * (best + 4))
    pairs = apart.withColumn("similarity", F.round(_product(F.col("_a"), F.col("_b")), SCORE_DIGITS - 1))
    pairs = pairs.where(F.col("similarity") >= least)
    ends = F.array(
        F.struct(F.col("a").alias("idx"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("idx"), F.col("a").alias("other")),
    )
    best_first = Window.partitionBy("idx").orderBy(F.desc("similarity"), "other")
    return (
        pairs.select("similarity", F.explode(ends).alias("e"))
        .select("e.*", "similarity")
        .withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= k)
        .select("idx", "rank", "other", "similarity")
    )


def _product(a: Column, b: Column) -> Column:
    """Inner product of two lists of (other, _w)."""
    weights = F.map_from_entries(b)
    terms = F.transform(a, lambda x: x["_w"] * F.coalesce(F.try_element_at(weights, x["other"]), F.lit(0.0)))
    return F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
