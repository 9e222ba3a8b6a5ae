"""Next-basket model with a score of its own for every customer and item that has one.

Cells are the (customer, item) pairs that history, neighbours or the last basket say something about;
all others of an item look the same and are fitted as two weighted rows. The fit is exact: iteratively
reweighted least squares, each step one aggregate of the features' Gram matrix and gradient.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.operators.examples import labels as labels_of
from basketflow.operators.lookup import lookup
from basketflow.operators.metrics import example_count, label_spine
from basketflow.operators.neighbours import BEST, collaborative_scores
from basketflow.operators.scoring import DECAY, item_history
from basketflow.operators.transitions import following_scores
from basketflow.schemas import CUST
from basketflow.sources.tables import materialize

CELL_FEATURES = ["recency", "frequency", "in_last", "neighbours", "follows"]
FEATURES = [*CELL_FEATURES, "popularity"]
RIDGE = 1e-3
STEPS, CLOSE = 50, 1e-10


@dataclass
class Fit:
    """Coefficients by name, and what tells whether they are the optimum."""

    coefficients: dict[str, float]
    steps: int
    loss: float
    gradient: dict[str, float]


def popularity_of(train: DataFrame, num_labels: int) -> DataFrame:
    """(idx, popularity): log of the share of customers with the item in their next basket, stored."""
    counts = labels_of(train).groupBy("idx").agg(F.count("*").alias("_n"))
    share = F.try_divide(F.coalesce("_n", F.lit(0)) + 0.5, example_count(train).scalar() + 1)
    spine = lookup(label_spine(train, num_labels), counts, ["idx"], num_labels, "idx")
    return materialize(spine.select("idx", F.log(share).alias("popularity")), "popularity")


def cells(
    examples: DataFrame,
    neighbours: DataFrame,
    transitions: DataFrame,
    popularity: DataFrame,
    num_labels: int,
    best: int = BEST,
    decay: float = DECAY,
    labelled: bool = True,
) -> DataFrame:
    """(customer, idx, features, y) of every cell that has a feature; y is 0 without ``labelled``.

    The sources are stacked and grouped, which takes one shuffle.
    """
    history = materialize(item_history(examples, decay), "history")
    sources = [
        history,
        collaborative_scores(history, neighbours, num_labels, best).withColumnRenamed("p", "neighbours"),
        following_scores(examples, transitions, num_labels).withColumnRenamed("p", "follows"),
    ]
    if labelled:
        sources.append(labels_of(examples).withColumn("y", F.lit(1)))
    stacked = sources[0].withColumn("y", F.lit(0))
    for source in sources[1:]:
        stacked = stacked.unionByName(source, allowMissingColumns=True)
    value = [F.max(c).alias(c) for c in CELL_FEATURES]
    grouped = stacked.groupBy(CUST, "idx").agg(*value, F.coalesce(F.max("y"), F.lit(0)).alias("y"))
    known = grouped.where(F.coalesce(*CELL_FEATURES).isNotNull()).fillna(0.0, CELL_FEATURES)
    return lookup(known, popularity, ["idx"], num_labels, CUST)


def training_rows(train: DataFrame, own: DataFrame, popularity: DataFrame, num_labels: int) -> DataFrame:
    """(features, y, times), stored: cells one by one, all others of an item as two rows."""
    counts = own.groupBy("idx").agg(F.count("*").alias("_cells"), F.sum("y").alias("_pos"))
    positive = labels_of(train).groupBy("idx").agg(F.count("*").alias("_all"))
    rest = lookup(popularity, counts, ["idx"], num_labels, "idx")
    rest = lookup(rest, positive, ["idx"], num_labels, "idx").fillna(0, ["_cells", "_pos", "_all"])
    outside = F.col("_all") - F.col("_pos")
    empty = example_count(train).scalar() - F.col("_cells") - outside
    entries = F.array(
        F.struct(F.lit(1).alias("y"), outside.alias("times")), F.struct(F.lit(0).alias("y"), empty.alias("times"))
    )
    zeros = {c: F.lit(0.0) for c in CELL_FEATURES}
    rest = rest.withColumns(zeros).select(*FEATURES, F.inline(entries)).where("times > 0")
    rows = own.select(*FEATURES, "y", F.lit(1).cast("bigint").alias("times"))
    return materialize(rows.unionByName(rest), "training-rows")


def _linear(coefficients: dict[str, float]) -> Column:
    total = F.lit(coefficients["intercept"])
    for name in FEATURES:
        total = total + F.lit(coefficients[name]) * F.col(name)
    return total


def probability(coefficients: dict[str, float]) -> Column:
    return 1 / (1 + F.exp(-_linear(coefficients)))


def fit(rows: DataFrame, ridge: float = RIDGE, steps: int = STEPS) -> Fit:
    """The coefficients of smallest loss, by Newton steps that are halved while the loss grows.

    The loss is the summed cross-entropy and half of ``ridge`` times the squared coefficients, without
    the intercept. A step is one pass over the rows that adds up 36 numbers.
    """
    names = ["intercept", *FEATURES]
    pull = np.array([0.0] + [ridge] * len(FEATURES))

    def measure(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        now = dict(zip(names, map(float, w)))
        values = [F.lit(1.0), *[F.col(c) for c in FEATURES]]
        at, times = F.col("_z"), F.col("times")
        p = 1 / (1 + F.exp(-at))
        # log(1 + exp(z)) without overflow, less z for positives.
        loss = F.greatest(at, F.lit(0.0)) + F.log1p(F.exp(-F.abs(at))) - F.col("y") * at
        sums = [F.sum(times * loss)]
        sums += [F.sum(times * (p - F.col("y")) * v) for v in values]
        sums += [
            F.sum(times * p * (1 - p) * values[i] * values[j]) for i in range(len(values)) for j in range(i + 1)
        ]
        found = [0.0 if x is None else float(x) for x in rows.withColumn("_z", _linear(now)).agg(*sums).first()]
        size = len(values)
        gradient = np.array(found[1 : 1 + size]) + pull * w
        curve = np.zeros((size, size))
        curve[np.tril_indices(size)] = found[1 + size :]
        curve = curve + np.tril(curve, -1).T + np.diag(pull)
        return found[0] + float(pull @ (w * w)) / 2, gradient, curve

    w = np.zeros(len(names))
    loss, gradient, curve = measure(w)
    taken = 0
    while taken < steps and np.abs(gradient).max() > CLOSE * max(loss, 1.0):
        move = np.linalg.lstsq(curve, gradient, rcond=None)[0]
        size, better = 1.0, measure(w - move)
        while better[0] > loss * (1 + 1e-12) + 1e-12 and size > 1e-6:
            size /= 2
            better = measure(w - size * move)
        w, taken = w - size * move, taken + 1
        loss, gradient, curve = better
    return Fit(dict(zip(names, map(float, w))), taken, loss, dict(zip(names, map(float, gradient))))


def fit_check(rows: DataFrame, fitted: Fit, ridge: float = RIDGE) -> DataFrame:
    """(feature, observed, fitted): sums of every feature over positives and by the fitted probabilities.

    With the pull of the ridge added, the two are equal at the optimum, and only there.
    """
    p, times = probability(fitted.coefficients), F.col("times")
    values = {"intercept": F.lit(1.0), **{c: F.col(c) for c in FEATURES}}
    entries = [
        F.struct(
            F.lit(name).alias("feature"),
            F.sum(times * F.col("y") * value).alias("observed"),
            (
                F.sum(times * p * value)
                + F.lit(0.0 if name == "intercept" else ridge * fitted.coefficients[name])
            ).alias("fitted"),
        )
        for name, value in values.items()
    ]
    return rows.agg(F.array(*entries).alias("_all")).select(F.inline("_all"))


def predict(fitted: Fit, own: DataFrame, popularity: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(customer, idx, p) of the cells, and (idx, p) for everyone else."""
    p = probability(fitted.coefficients).alias("p")
    background = popularity.withColumns({c: F.lit(0.0) for c in CELL_FEATURES})
    return own.select(CUST, "idx", p), background.select("idx", p)
