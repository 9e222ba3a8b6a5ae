"""Learned weights of the positions in a customer's sequence.

A customer's next items are taken for draws from its baskets: a basket is chosen by its age (0 is the
newest), then one of its items, evenly. The weight of age g is exp(tanh(b_g)) over the sum of those of
the customer's baskets; a share ``MIXED`` of the draws comes from the popularity of all items, so that
no item has probability 0. The numbers b are fitted by gradient descent on the mean negative log
probability of the items of y: a step is one pass that adds up one number per age.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.operators.lookup import lookup
from basketflow.operators.metrics import label_spine
from basketflow.operators.scoring import SCORE_DIGITS
from basketflow.schemas import CUST, PAD
from basketflow.sources.tables import materialize

MIXED = 0.1
STEPS = 40
_LOSS = -1  # the age under which losses are added up


@dataclass
class Positions:
    """b by age, the mean loss at b, and the losses on the way there."""

    b: list[float]
    loss: float
    losses: list[float]


def _known(basket: Column) -> Column:
    return F.array_distinct(F.filter(basket, lambda i: i != PAD))


def item_shares(examples: DataFrame, num_labels: int) -> DataFrame:
    """(idx, share): share of an item among all items of x, with one more of each, stored."""
    items = examples.select(F.explode(F.flatten(F.transform("x", _known))).alias("idx"))
    counts = items.groupBy("idx").agg(F.count("*").alias("_n"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)) + (num_labels - 1)).scalar()
    spine = lookup(label_spine(examples, num_labels).where(F.col("idx") != PAD), counts, ["idx"], num_labels, "idx")
    return materialize(spine.select("idx", ((F.coalesce("_n", F.lit(0)) + 1) / total).alias("share")), "shares")


def draws(examples: DataFrame, shares: DataFrame, num_labels: int) -> DataFrame:
    """(customer, idx, share, parts), stored: a row per known item of y.

    ``parts`` lists the customer's baskets that have a known item by their age, each with the share
    of the item in it: 0 or 1 / size. It is as long as a sequence may be.
    """
    newest_first = F.reverse(F.transform("x", _known))
    aged = F.filter(
        F.transform(newest_first, lambda b, at: F.named_struct(F.lit("age"), at, F.lit("items"), b)),
        lambda p: F.size(p["items"]) > 0,
    )
    rows = examples.select(CUST, aged.alias("_aged"), F.explode(_known(F.col("y"))).alias("idx"))

    def inside(part: Column) -> Column:
        share = F.when(F.array_contains(part["items"], F.col("idx")), 1 / F.size(part["items"])).otherwise(0.0)
        return F.named_struct(F.lit("age"), part["age"], F.lit("share"), share)

    rows = rows.select(CUST, "idx", F.transform("_aged", inside).alias("parts"))
    return materialize(lookup(rows, shares, ["idx"], num_labels, CUST), "draws")


def _weighed(b: list[float]) -> Column:
    """The parts with the weight of their age, not yet divided by their sum."""
    table = F.array(*[F.lit(float(np.exp(np.tanh(x)))) for x in b])
    return F.transform(
        "parts",
        lambda p: F.named_struct(
            F.lit("age"), p["age"], F.lit("share"), p["share"], F.lit("w"), F.get(table, p["age"])
        ),
    )


def _total(parts: Column, value) -> Column:
    return F.aggregate(F.transform(parts, value), F.lit(0.0), lambda s, x: s + x)


def loss_and_gradient(rows: DataFrame, b: list[float], mixed: float = MIXED) -> DataFrame:
    """(age, value): the derivative of the summed loss by every b that occurs; age -1 has the loss."""
    rows = rows.withColumn("_w", _weighed(b))
    rows = rows.withColumn("_sum", _total(F.col("_w"), lambda p: p["w"]))
    met = _total(F.col("_w"), lambda p: p["w"] * p["share"])
    rows = rows.withColumn("_s", F.coalesce(F.try_divide(met, F.col("_sum")), F.lit(0.0)))
    rows = rows.withColumn("_p", (1 - mixed) * F.col("_s") + mixed * F.col("share"))
    slope = F.array(*[F.lit(1.0 - float(np.tanh(x)) ** 2) for x in b])

    def part(p: Column) -> Column:
        change = (1 - mixed) * p["w"] / F.col("_sum") * (p["share"] - F.col("_s")) / F.col("_p")
        return F.named_struct(F.lit("age"), p["age"], F.lit("value"), -change * F.get(slope, p["age"]))

    loss = F.array(F.named_struct(F.lit("age"), F.lit(_LOSS), F.lit("value"), -F.log("_p")))
    entries = rows.select(F.explode(F.concat(F.transform("_w", part), loss)).alias("e"))
    return entries.groupBy("e.age").agg(F.sum("e.value").alias("value"))


def fit_positions(rows: DataFrame, ages: int, mixed: float = MIXED, steps: int = STEPS) -> Positions:
    """Descend from even weights; steps grow while the loss falls and are halved where it does not."""
    count = max(rows.count(), 1)

    def measure(b: np.ndarray) -> tuple[float, np.ndarray]:
        loss, gradient = 0.0, np.zeros(ages)
        for row in loss_and_gradient(rows, b.tolist(), mixed).collect():
            if row["age"] == _LOSS:
                loss = row["value"] / count
            else:
                gradient[row["age"]] = row["value"] / count
        return loss, gradient

    b, size = np.zeros(ages), 1.0
    loss, gradient = measure(b)
    losses = [loss]
    for _ in range(steps):
        if np.abs(gradient).max(initial=0) < 1e-7 or size < 1e-6:
            break
        tried = b - size * gradient / np.abs(gradient).max()
        new, slope = measure(tried)
        if new < loss:
            b, loss, gradient, size = tried, new, slope, size * 1.3
            losses.append(loss)
        else:
            size /= 3
    return Positions(b.tolist(), loss, losses)


def position_scores(examples: DataFrame, b: list[float]) -> DataFrame:
    """(customer, idx, p): probability that a basket drawn by its age's weight has the item."""
    aged = F.reverse(F.transform("x", lambda basket: F.array_distinct(basket)))
    rows = examples.where(F.size("x") > 0).select(CUST, F.posexplode(aged).alias("age", "items"), F.size("x").alias("_n"))
    weights = [float(np.exp(np.tanh(x))) for x in b]
    running = F.array(*[F.lit(float(x)) for x in np.cumsum(weights)])
    table = F.array(*[F.lit(x) for x in weights])
    share = F.get(table, F.col("age")) / F.get(running, F.col("_n") - 1)
    entries = rows.select(CUST, F.explode("items").alias("idx"), share.alias("_share"))
    return entries.groupBy(CUST, "idx").agg(F.round(F.sum("_share"), SCORE_DIGITS).alias("p"))
