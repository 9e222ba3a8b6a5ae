"""Next-basket model: the probability of every item to be in a customer's next basket.

A logistic regression over (customer, item) cells. Outside its own history an item looks the same
for every customer, so those cells differ by label only and are fitted as two weighted rows per
item instead of one row per customer; the likelihood is that of all cells. For the same reason a
prediction is a score per (customer, own item) and a background score per item, which is what
``scoring`` and ``metrics`` take.
"""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.operators.embeddings import VECTOR_BYTES, cosine
from basketflow.operators.examples import labels as labels_of
from basketflow.operators.lookup import lookup
from basketflow.operators.metrics import (
    TOP_K,
    class_weights,
    example_count,
    label_outcomes,
    label_spine,
    summary,
    top_k_metrics,
)
from basketflow.operators.scoring import DECAY, item_history
from basketflow.schemas import CUST
from basketflow.sources.tables import materialize

OWN_FEATURES = ["recency", "frequency", "in_last", "fit"]
FEATURES = [*OWN_FEATURES, "popularity"]


def item_popularity(train: DataFrame, num_labels: int) -> DataFrame:
    """(idx, n_own, popularity): train customers with the item in x, and the log of their share."""
    owners = (
        train.select(CUST, F.explode(F.array_distinct(F.flatten("x"))).alias("idx"))
        .groupBy("idx")
        .agg(F.count("*").alias("n_own"))
    )
    share = F.try_divide("n_own", example_count(train).scalar())
    return (
        lookup(label_spine(train, num_labels), owners, ["idx"], num_labels, "idx")
        .fillna(0, ["n_own"])
        .withColumn("_share", F.coalesce(share, F.lit(0.0)))
        .select("idx", "n_own", F.log(F.col("_share") + 1e-6).alias("popularity"))
    )


def own_features(
    examples: DataFrame,
    popularity: DataFrame,
    num_labels: int,
    embeddings: DataFrame | None = None,
    decay: float = DECAY,
) -> DataFrame:
    """Feature row of every (customer, item of its history).

    ``fit`` is the cosine of the item's vector and the recency-weighted mean of the customer's
    item vectors, 0 without embeddings. The examples are shuffled by customer once, with their
    baskets still packed in a row; all that follows stays in place.
    """
    history = item_history(examples.repartition(CUST), decay)
    if embeddings is None:
        history = history.withColumn("fit", F.lit(0.0))
    else:
        vectors = lookup(history, embeddings, ["idx"], num_labels, CUST, VECTOR_BYTES)
        as_vector = array_to_vector(F.col("vector").cast("array<double>"))
        pooled = vectors.groupBy(CUST).agg(
            vector_to_array(Summarizer.mean(as_vector, F.col("recency"))).alias("_pooled")
        )
        history = (
            vectors.join(pooled, CUST)
            .withColumn("fit", cosine(F.col("vector"), F.col("_pooled")))
            .drop("vector", "_pooled")
        )
    return lookup(history, popularity.select("idx", "popularity"), ["idx"], num_labels, CUST)


def background_features(popularity: DataFrame, *keep: str) -> DataFrame:
    """Feature row of every item for customers without it in their history."""
    zeros = {name: F.lit(0.0) for name in OWN_FEATURES}
    return popularity.select("idx", "popularity", *keep).withColumns(zeros)


def own_cells(train: DataFrame, own: DataFrame) -> DataFrame:
    """Feature rows of the train customers with their label ``y``.

    Features and labels are stacked and grouped, which takes one shuffle.
    """
    positive = labels_of(train).withColumn("y", F.lit(1))
    return (
        own.withColumn("y", F.lit(0))
        .unionByName(positive, allowMissingColumns=True)
        .groupBy(CUST, "idx")
        .agg(F.max("y").alias("y"), *[F.max(c).alias(c) for c in FEATURES])
        .where(F.col("recency").isNotNull())
    )


def training_rows(
    train: DataFrame, own: DataFrame, popularity: DataFrame, weights: DataFrame | None, width: int
) -> DataFrame:
    """(features…, y, weight): own cells one by one, all others as two rows per item."""
    own_pos = own.groupBy("idx").agg(F.sum("y").alias("own_pos"))
    all_pos = labels_of(train).groupBy("idx").agg(F.count("*").alias("all_pos"))
    rest = lookup(popularity, own_pos, ["idx"], width, "idx")
    rest = lookup(rest, all_pos, ["idx"], width, "idx").fillna(0, ["own_pos", "all_pos"])
    rest = rest.withColumn("_n", example_count(train).scalar())
    rest_pos = F.col("all_pos") - F.col("own_pos")
    rest_neg = F.col("_n") - F.col("n_own") - rest_pos
    counted = F.array(
        F.struct(F.lit(1).alias("y"), rest_pos.alias("times")),
        F.struct(F.lit(0).alias("y"), rest_neg.alias("times")),
    )
    rest = background_features(rest, "n_own", "own_pos", "all_pos", "_n").withColumn(
        "_c", F.explode(counted)
    )
    names = [CUST, "idx", *FEATURES]
    one = F.lit(1).cast("bigint").alias("times")
    rest = rest.where(F.col("_c.times") > 0).select(*names[1:], "_c.y", "_c.times")
    rows = own.select(*names, "y", one).unionByName(rest, allowMissingColumns=True)
    if weights is None:
        weight = F.col("times").cast("double")
    else:
        rows = lookup(rows, weights, ["idx"], width, CUST)
        weight = F.col("times") * F.when(F.col("y") == 1, F.col("w_pos")).otherwise(F.col("w_neg"))
    return rows.select(*FEATURES, F.col("y").cast("double"), weight.alias("weight"))


def fit_next_basket(
    train: DataFrame,
    num_labels: int,
    embeddings: DataFrame | None = None,
    use_class_weights: bool = True,
    decay: float = DECAY,
    iterations: int = 50,
    regularization: float = 1e-4,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on examples (customer, x, y); returns the model and the item popularity it needs."""
    popularity = materialize(item_popularity(train, num_labels), "popularity")
    features = own_features(train, popularity, num_labels, embeddings, decay)
    own = materialize(own_cells(train, features), "own-cells")
    weights = None
    if use_class_weights:
        weights = class_weights(labels_of(train), example_count(train), num_labels)
        weights = materialize(weights, "class-weights")
    rows = training_rows(train, own, popularity, weights, num_labels)
    stages = [
        VectorAssembler(inputCols=FEATURES, outputCol="features"),
        LogisticRegression(
            featuresCol="features",
            labelCol="y",
            weightCol="weight",
            maxIter=iterations,
            regParam=regularization,
        ),
    ]
    return Pipeline(stages=stages).fit(rows), popularity


def _probability(model: PipelineModel, rows: DataFrame, *keys: str) -> DataFrame:
    p = F.element_at(vector_to_array("probability"), 2)
    return model.transform(rows).select(*keys, p.alias("p"))


def predict(
    model: PipelineModel,
    examples: DataFrame,
    popularity: DataFrame,
    num_labels: int,
    embeddings: DataFrame | None = None,
    decay: float = DECAY,
) -> tuple[DataFrame, DataFrame]:
    """(customer, idx, p) of own items, and (idx, p) for everyone else."""
    own = own_features(examples, popularity, num_labels, embeddings, decay)
    background = background_features(popularity)
    return _probability(model, own, CUST, "idx"), _probability(model, background, "idx")


def evaluate(
    examples: DataFrame,
    scores: DataFrame,
    num_labels: int,
    background: DataFrame | None = None,
    weights: DataFrame | None = None,
    k: int = TOP_K,
    exclude_pad_label: bool = False,
    rank_pad_label: bool = True,
) -> DataFrame:
    """One row: loss, accuracy, macro precision, recall and F1, and top-k recall and precision.

    ``exclude_pad_label`` leaves label 0, which is set for every example, out of all measures but
    the ranking, which leaves it out without ``rank_pad_label``.
    """
    y = labels_of(examples)
    n = example_count(examples)
    outcomes = label_outcomes(y, scores, n, num_labels, background, weights)
    if exclude_pad_label:
        outcomes = outcomes.where(F.col("idx") != 0)
    ranking = top_k_metrics(
        y, scores, examples, num_labels, k, background, not rank_pad_label
    )
    ranking = ranking.select(
        F.col("recall").alias("recall_top_k"), F.col("precision").alias("precision_top_k")
    )
    # Both are one row; stacked, each column has one value.
    stacked = summary(outcomes, n).unionByName(ranking, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
