"""Recency scores and ranked items.

Scores are sparse: ``scores`` has rows (customer, idx, p) for the items that say something about
the customer, and every other item has the score that ``background`` (idx, p) gives it, or 0. That
stands for the full customer by item matrix without writing it out.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.operators.lookup import lookup
from basketflow.operators.ranking import numbered
from basketflow.schemas import CUST

DECAY = 0.1
_NORM_EPSILON = 1e-7  # fixed value: keeps the normalisation away from a division by zero
SCORE_DIGITS = 9


def item_history(examples: DataFrame, decay: float = DECAY) -> DataFrame:
    """(customer, idx) for the items of x: recency, frequency and whether in the last basket.

    Recency is the share of the decayed basket weights that falls on baskets with the item; the
    newest basket weighs 1 and each older one ``exp(-decay)`` times the next. Values are rounded so
    that the order of addition cannot decide between equal scores.
    """
    length = F.size("x")
    if decay == 0:
        weight_sum = length.cast("double")
    else:
        weight_sum = (1 - F.exp(-F.lit(decay) * length)) / (1 - math.exp(-decay))
    baskets = examples.select(
        CUST,
        length.alias("_n"),
        (weight_sum + _NORM_EPSILON).alias("_norm"),
        F.posexplode("x").alias("_at", "basket"),
    )
    age = F.col("_n") - 1 - F.col("_at")
    items = baskets.select(
        CUST,
        F.explode(F.array_distinct("basket")).alias("idx"),
        (F.exp(-F.lit(decay) * age) / F.col("_norm")).alias("_weight"),
        (F.lit(1.0) / F.col("_n")).alias("_count"),
        F.when(age == 0, 1.0).otherwise(0.0).alias("_last"),
    )
    return items.groupBy(CUST, "idx").agg(
        F.round(F.sum("_weight"), SCORE_DIGITS).alias("recency"),
        F.round(F.sum("_count"), SCORE_DIGITS).alias("frequency"),
        F.max("_last").alias("in_last"),
    )


def recency_scores(examples: DataFrame, decay: float = DECAY) -> DataFrame:
    """(customer, idx, p): recency-weighted share of an item in the customer's history."""
    return item_history(examples, decay).select(CUST, "idx", F.col("recency").alias("p"))


def top_items(
    scores: DataFrame,
    customers: DataFrame,
    k: int,
    num_labels: int,
    background: DataFrame | None = None,
    exclude_pad_label: bool = False,
) -> DataFrame:
    """(customer, rank, idx, p): the k best of all ``num_labels`` items of every customer.

    Higher scores come first and lower indices win ties. ``exclude_pad_label`` leaves out index 0,
    which stands for padding and unknown items. The rows of one of the ``customers`` are
    merged with the best background items it has no row for; these lie among the first
    ``k + own rows`` of the background. Groups are bounded by the number of labels.
    """
    first = int(exclude_pad_label)
    scores = scores.where(F.col("idx") >= first)
    spine = scores.sparkSession.range(first, num_labels)
    spine = spine.select(F.col("id").cast("int").alias("idx"))
    if background is None:
        others = spine.select("idx", (F.col("idx") - first).alias("place"), F.lit(0.0).alias("p"))
    else:
        filled = lookup(spine, background.select("idx", "p"), ["idx"], num_labels, "idx")
        filled = filled.fillna({"p": 0.0})
        others = numbered(filled, [-F.col("p"), F.col("idx")], num_labels)
        others = others.select("idx", F.col("pos").cast("int").alias("place"), "p")
    places = others.select("idx", "place")
    scored = lookup(scores.select(CUST, "idx", "p"), places, ["idx"], num_labels, CUST)
    entry = F.when(F.col("idx").isNotNull(), F.struct((-F.col("p")).alias("q"), "idx"))
    own = (
        scored.unionByName(customers.select(CUST), allowMissingColumns=True)
        .groupBy(CUST)
        .agg(
            F.slice(F.array_sort(F.collect_list(entry)), 1, k).alias("_own"),
            F.collect_list("place").alias("_taken"),
        )
    )
    near = F.sequence(F.lit(0), F.least(F.size("_taken") + k, F.lit(num_labels - first)) - 1)
    free = F.slice(F.array_except(near, F.col("_taken")), 1, k)
    candidates = F.concat(
        F.transform("_own", lambda s: _candidate(-s["q"], s["idx"], F.lit(None))),
        F.transform(free, lambda place: _candidate(F.lit(None), F.lit(None), place)),
    )
    merged = own.select(CUST, F.inline(candidates))
    best_others = others.select("place", F.col("idx").alias("_idx"), F.col("p").alias("_p"))
    merged = lookup(merged, best_others, ["place"], num_labels, CUST)
    return top_scored(
        merged.select(
            CUST, F.coalesce("own_idx", "_idx").alias("idx"), F.coalesce("own_p", "_p").alias("p")
        ),
        k,
    )


def _candidate(p: Column, idx: Column, place: Column) -> Column:
    return F.struct(
        p.cast("double").alias("own_p"),
        idx.cast("int").alias("own_idx"),
        place.cast("int").alias("place"),
    )


def top_scored(scores: DataFrame, k: int) -> DataFrame:
    """(customer, rank, idx, p): the k best of the customer's own rows."""
    order = Window.partitionBy(CUST).orderBy(F.desc("p"), F.asc("idx"))
    ranked = scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(CUST, "rank", "idx", "p")
