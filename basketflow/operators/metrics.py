"""Class weights, losses and ranking metrics over all (customer, label) cells.

Labels are the sparse positives (customer, idx) and scores are sparse too, with a background
score for the cells without a row (see ``scoring``). All measures come out of one table with a row
per label: cells without a row are counted, not listed, so nothing of the size customers times
labels is ever produced, and the result is still that over every cell.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.operators.lookup import lookup
from basketflow.operators.scoring import top_items
from basketflow.schemas import CUST

THRESHOLD = 0.5
TOP_K = 20
_CLIP = 1e-7  # fixed value: scores are kept this far from 0 and 1 in logarithms


def example_count(examples: DataFrame) -> DataFrame:
    """One row with ``n``."""
    return examples.agg(F.count("*").alias("n"))


def label_spine(df: DataFrame, num_labels: int) -> DataFrame:
    """idx 0 … num_labels - 1."""
    return df.sparkSession.range(num_labels).select(F.col("id").cast("int").alias("idx"))


def class_weights(labels: DataFrame, n: DataFrame, num_labels: int) -> DataFrame:
    """(idx, w_neg, w_pos): half the examples over the examples of the class, per label.

    Both are 1 for a label that has only positives or only negatives.
    """
    positives = labels.groupBy("idx").agg(F.count("*").alias("_pos"))
    counted = (
        lookup(label_spine(labels, num_labels), positives, ["idx"], num_labels, "idx")
        .withColumn("_pos", F.coalesce("_pos", F.lit(0)))
        .withColumn("_n", n.scalar())
    )
    one_class = (F.col("_pos") == 0) | (F.col("_pos") == F.col("_n"))

    def weight(members: Column) -> Column:
        return F.when(one_class, 1.0).otherwise(F.col("_n") / (2 * members))

    return counted.select(
        "idx",
        weight(F.col("_n") - F.col("_pos")).alias("w_neg"),
        weight(F.col("_pos")).alias("w_pos"),
    )


def cells(labels: DataFrame, scores: DataFrame) -> DataFrame:
    """(customer, idx, y, p) for all cells with a label or a score; p is null without a score.

    Both sides are stacked and grouped, which takes one shuffle where an outer join takes two.
    """
    positive = labels.select(CUST, "idx", F.lit(1).alias("y"), F.lit(None).cast("double").alias("p"))
    scored = scores.select(CUST, "idx", F.lit(0).alias("y"), F.col("p").cast("double"))
    return (
        positive.unionByName(scored)
        .groupBy(CUST, "idx")
        .agg(F.max("y").alias("y"), F.max("p").alias("p"))
    )


def _loss(p: Column) -> Column:
    """Cross-entropy of a positive cell; of a negative one with 1 - p."""
    return -F.log(F.greatest(F.least(p, F.lit(1 - _CLIP)), F.lit(_CLIP)))


def label_outcomes(
    labels: DataFrame,
    scores: DataFrame,
    n: DataFrame,
    num_labels: int,
    background: DataFrame | None = None,
    weights: DataFrame | None = None,
) -> DataFrame:
    """One row per label: tp, fp, fn and the weighted loss summed over all examples."""
    positive, scored = F.col("y") == 1, F.col("p").isNotNull()
    over = scored & (F.col("p") > THRESHOLD)

    def count(rule: Column) -> Column:
        return F.sum(F.when(rule, 1).otherwise(0))

    def total(rule: Column, value: Column) -> Column:
        return F.sum(F.when(rule, value).otherwise(0.0))

    stored = (
        cells(labels, scores)
        .groupBy("idx")
        .agg(
            count(positive).alias("pos"),
            count(positive & ~scored).alias("bare_pos"),
            count(~positive).alias("scored_neg"),
            count(positive & over).alias("tp"),
            count(~positive & over).alias("fp"),
            total(positive & scored, _loss(F.col("p"))).alias("loss_pos"),
            total(~positive, _loss(1 - F.col("p"))).alias("loss_neg"),
        )
    )
    names = [c for c in stored.columns if c != "idx"]
    table = lookup(label_spine(labels, num_labels), stored, ["idx"], num_labels, "idx").fillna(0, names)
    for side, columns in ((background, {"p": 0.0}), (weights, {"w_neg": 1.0, "w_pos": 1.0})):
        if side is None:
            table = table.withColumns({c: F.lit(v) for c, v in columns.items()})
        else:
            side = side.select("idx", *columns)
            table = lookup(table, side, ["idx"], num_labels, "idx").fillna(columns)
    bare_neg = n.scalar() - F.col("pos") - F.col("scored_neg")
    guess = F.when(F.col("p") > THRESHOLD, 1).otherwise(0)
    return (
        table.withColumn("bare_neg", bare_neg)
        .withColumn("tp", F.col("tp") + guess * F.col("bare_pos"))
        .withColumn("fp", F.col("fp") + guess * F.col("bare_neg"))
        .select(
            "idx",
            "tp",
            "fp",
            (F.col("pos") - F.col("tp")).alias("fn"),
            (
                F.col("w_pos") * (F.col("loss_pos") + F.col("bare_pos") * _loss(F.col("p")))
                + F.col("w_neg") * (F.col("loss_neg") + F.col("bare_neg") * _loss(1 - F.col("p")))
            ).alias("loss"),
        )
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def summary(outcomes: DataFrame, n: DataFrame) -> DataFrame:
    """One row: loss and accuracy over all cells, macro precision, recall and F1 over labels."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    rows = outcomes.select(
        "loss",
        (fp + fn).alias("wrong"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )
    totals = rows.agg(
        F.sum("loss").alias("loss"),
        F.sum("wrong").alias("wrong"),
        F.count("*").alias("labels"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"),
    ).withColumn("n", n.scalar())
    size = F.col("n") * F.col("labels")
    return totals.select(
        F.try_divide("loss", size).alias("loss"),
        (1 - F.try_divide("wrong", size)).alias("accuracy"),
        F.col("precision"),
        F.col("recall"),
        F.col("f1"),
    )


def top_k_metrics(
    labels: DataFrame,
    scores: DataFrame,
    examples: DataFrame,
    num_labels: int,
    k: int = TOP_K,
    background: DataFrame | None = None,
    exclude_pad_label: bool = False,
) -> DataFrame:
    """One row: recall and precision when each example's k best labels count as predicted."""
    first = int(exclude_pad_label)
    labels = labels.where(F.col("idx") >= first)
    best = top_items(scores, examples, k, num_labels, background, exclude_pad_label)
    best = best.select(CUST, "idx", "p")
    hits = cells(labels, best).agg(
        F.sum(F.when((F.col("y") == 1) & F.col("p").isNotNull(), 1).otherwise(0)).alias("tp"),
        F.sum("y").alias("pos"),
    )
    predicted = example_count(examples).scalar() * min(k, num_labels - first)
    return hits.withColumn("_predicted", predicted).select(
        _ratio(F.col("tp"), F.col("pos")).alias("recall"),
        _ratio(F.col("tp"), F.col("_predicted")).alias("precision"),
    )
