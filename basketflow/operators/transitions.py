"""From one basket to the next: which items follow which."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.functions.arrays import last
from basketflow.operators.lookup import lookup
from basketflow.operators.scoring import SCORE_DIGITS
from basketflow.schemas import CUST, PAD
from basketflow.sources.tables import materialize

SHRINK = 5.0
_ANY = -1  # stands for the whole basket where entries are counted


def _known(basket: Column) -> Column:
    return F.array_distinct(F.filter(basket, lambda i: i != PAD))


def item_transitions(examples: DataFrame, shrink: float = SHRINK) -> DataFrame:
    """(idx_a, idx_b, n_ab, n_a, n_b, p, lift): item b in the basket right after one with item a, stored.

    ``p`` is the share of the baskets after one with a that have b, pulled towards the share of all
    later baskets that have b as if ``shrink`` more of those had been seen; ``lift`` divides it by
    that share. Only x is read. A sequence is one row of bounded length, so its steps are listed
    inside the row and counted before the shuffle; there are at most as many results as pairs of
    vocabulary items. Item 0 takes no part.
    """
    steps = examples.where(F.size("x") >= 2).select(F.transform("x", _known).alias("_x"))

    def step(at: Column) -> Column:
        """All (a, b) of a step; -1 on either side stands for its whole basket."""
        any_item = F.array(F.lit(_ANY))
        before = F.concat(F.get("_x", at), any_item)
        after = F.concat(F.get("_x", at + 1), any_item)
        return F.flatten(
            F.transform(
                before,
                lambda a: F.transform(after, lambda b: F.struct(a.alias("a"), b.alias("b"))),
            )
        )

    entries = F.flatten(F.transform(F.sequence(F.lit(0), F.size("_x") - 2), step))
    counted = materialize(
        steps.select(F.explode(entries).alias("e")).groupBy("e.a", "e.b").agg(F.count("*").alias("n")),
        "step-counts",
    )
    a, b = F.col("a"), F.col("b")
    total = counted.where((a == _ANY) & (b == _ANY)).select("n").scalar()
    from_a = counted.where((a != _ANY) & (b == _ANY)).select("a", F.col("n").alias("n_a"))
    to_b = counted.where((a == _ANY) & (b != _ANY)).select("b", F.col("n").alias("n_b"))
    share = F.col("n_b") / total
    p = (F.col("n_ab") + shrink * share) / (F.col("n_a") + shrink)
    pairs = counted.where((a != _ANY) & (b != _ANY)).withColumnRenamed("n", "n_ab")
    found = pairs.join(from_a, "a").join(to_b, "b").select(
        a.alias("idx_a"), b.alias("idx_b"), "n_ab", "n_a", "n_b", p.alias("p"), (p / share).alias("lift")
    )
    return materialize(found, "transitions")


def following_scores(
    examples: DataFrame, transitions: DataFrame, num_labels: int, shrink: float = SHRINK
) -> DataFrame:
    """(customer, idx, p): how often an item followed those of the customer's last basket, on average."""
    recent = examples.select(CUST, _known(last(F.col("x"))).alias("_last"))
    rows = recent.select(CUST, F.size("_last").alias("_n"), F.explode("_last").alias("idx_a"))
    entry = F.struct("idx_b", (F.col("n_ab") / (F.col("n_a") + shrink)).alias("_share"))
    # A list is as long as the vocabulary at most, so its bytes decide between broadcast and shuffle.
    lists = transitions.groupBy("idx_a").agg(F.collect_list(entry).alias("_next"))
    joined = lookup(rows, lists, ["idx_a"], num_labels, CUST, 16 * num_labels)
    entries = joined.select(CUST, "_n", F.explode("_next").alias("e"))
    p = F.round(F.sum(F.col("e._share") / F.col("_n")), SCORE_DIGITS - 1)
    return entries.groupBy(CUST, F.col("e.idx_b").alias("idx")).agg(p.alias("p"))
