"""Item vectors learned from baskets, and vectors of baskets."""

from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.operators.lookup import lookup
from basketflow.schemas import CUST, PAD

PARTITIONS = 8
VECTOR_BYTES = 4096  # room for 1024 single-precision numbers


def fit_item_embeddings(
    baskets: DataFrame,
    max_items: int,
    size: int = 128,
    iterations: int = 1,
    partitions: int = PARTITIONS,
    seed: int = 42,
) -> Word2VecModel:
    """Learn a vector per vocabulary index, with the other items of the basket as context.

    The model is as large as the vocabulary, on the driver and in every task; the baskets stay
    distributed. Training is spread over ``partitions`` tasks whose vectors are averaged after every
    iteration, so more partitions need more ``iterations``; neither depends on the cores at hand.
    """
    words = F.transform(F.filter("items", lambda i: i != PAD), lambda i: i.cast("string"))
    sentences = baskets.where(F.col("items").isNotNull()).select(words.alias("words"))
    learner = Word2Vec(
        vectorSize=size,
        minCount=1,
        windowSize=max_items,
        maxSentenceLength=max_items,
        maxIter=iterations,
        numPartitions=partitions,
        seed=seed,
        inputCol="words",
        outputCol="vector",
    )
    return learner.fit(sentences.where(F.size("words") > 0))


def item_embeddings(model: Word2VecModel, num_labels: int) -> DataFrame:
    """(idx, vector) for 0 … num_labels - 1; items never seen, and padding, have a zero vector."""
    vectors = model.getVectors()
    learned = vectors.select(
        F.col("word").cast("int").alias("idx"),
        vector_to_array("vector", "float32").alias("vector"),
    )
    spine = vectors.sparkSession.range(num_labels).select(F.col("id").cast("int").alias("idx"))
    zero = F.array_repeat(F.lit(0.0).cast("float"), model.getVectorSize())
    joined = lookup(spine, learned, ["idx"], num_labels, "idx", VECTOR_BYTES)
    return joined.withColumn("vector", F.coalesce("vector", zero))


def basket_vectors(
    baskets: DataFrame, embeddings: DataFrame, num_labels: int, skip_pads: bool = False
) -> DataFrame:
    """(customer, basket_pos, vector): mean item vector per basket, over pads too by default.

    ``baskets`` has rows (customer, basket_pos, items). Pads have a zero vector, so they are left
    out of the join and only count in the divisor. A basket of pads alone has no row if they are
    skipped, and a zero vector otherwise.
    """
    own = F.filter("items", lambda i: i != PAD)
    entries = baskets.where(F.size("items") > 0).select(
        CUST,
        "basket_pos",
        F.size(own if skip_pads else F.col("items")).alias("_width"),
        (F.explode(own) if skip_pads else F.explode_outer(own)).alias("idx"),
    )
    vectors = lookup(entries, embeddings, ["idx"], num_labels, CUST, VECTOR_BYTES)
    size = embeddings.select(F.size("vector").alias("n")).limit(1).scalar()
    zero = F.array_repeat(F.lit(0.0), size)
    vector = F.coalesce(F.col("vector").cast("array<double>"), zero)
    total = vector_to_array(Summarizer.sum(array_to_vector(vector)))
    return (
        vectors.groupBy(CUST, "basket_pos", "_width")
        .agg(total.alias("_sum"))
        .select(
            CUST,
            "basket_pos",
            F.transform("_sum", lambda v: (v / F.col("_width")).cast("float")).alias("vector"),
        )
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two array columns; 0 where one of them is all zero."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(0.0)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def pair_similarity(pairs: DataFrame, embeddings: DataFrame, num_labels: int) -> DataFrame:
    """Add ``cosine`` of the two item vectors to the pairs of ``item_affinity``."""
    for side in ("a", "b"):
        named = embeddings.select(
            F.col("idx").alias(f"idx_{side}"), F.col("vector").alias(f"_vector_{side}")
        )
        other = "idx_b" if side == "a" else "idx_a"
        pairs = lookup(pairs, named, [f"idx_{side}"], num_labels, other, VECTOR_BYTES)
    return pairs.withColumn("cosine", cosine(F.col("_vector_a"), F.col("_vector_b"))).drop(
        "_vector_a", "_vector_b"
    )

