"""Basket vectors by a learned linear map of the items' vectors, one block per place in the basket.

The map is the ridge regression of the next basket's mean item vector on the vectors at the places of
a basket. Its normal equations are sums over baskets of products of two places' vectors; Spark adds
them up block by block, and the driver solves them. They have (places * size)**2 numbers, whatever
the number of baskets.
"""

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.operators.embeddings import VECTOR_BYTES
from basketflow.operators.lookup import lookup
from basketflow.schemas import CUST, PAD
from basketflow.sources.tables import materialize

RIDGE = 1.0
# The normal equations are held on the driver; larger ones are refused.
MOST_NUMBERS = 1 << 26


def basket_parts(examples: DataFrame, vectors: DataFrame, num_labels: int) -> DataFrame:
    """(customer, basket_pos, parts, mean): place and vector of the known items of every basket of x.

    A basket has a bounded number of places; those without a known item have none.
    """
    entries = examples.select(CUST, F.posexplode("x").alias("_at", "_items")).select(
        CUST, (F.col("_at") + 1).alias("basket_pos"), F.posexplode("_items").alias("place", "idx")
    )
    known = lookup(entries.where(F.col("idx") != PAD), vectors, ["idx"], num_labels, CUST, VECTOR_BYTES)
    value = F.col("vector").cast("array<double>").alias("v")
    mean = vector_to_array(Summarizer.mean(array_to_vector(F.col("vector").cast("array<double>"))))
    return known.groupBy(CUST, "basket_pos").agg(
        F.array_sort(F.collect_list(F.struct("place", value))).alias("parts"), mean.alias("mean")
    )


def steps(parts: DataFrame) -> DataFrame:
    """(customer, basket_pos, parts, target), stored: baskets with the mean vector of the next one."""
    after = parts.select(CUST, (F.col("basket_pos") - 1).alias("basket_pos"), F.col("mean").alias("target"))
    return materialize(parts.drop("mean").join(after, [CUST, "basket_pos"]), "steps")


def _outer(a: Column, b: Column) -> Column:
    """All products of two lists, row by row."""
    return F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: x * y)))


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    total = vector_to_array(Summarizer.sum(array_to_vector("_block")))
    return rows.groupBy(*keys).agg(total.alias("_sum"))


def normal_equations(rows: DataFrame, places: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums of z z', sums of z target') over the steps, z being the vectors of all places in a row."""
    if (places * size) ** 2 > MOST_NUMBERS:
        raise ValueError("places times size is too large for the driver")
    left = rows.select("parts", "target", F.explode("parts").alias("a"))
    pairs = left.select("a", F.explode("parts").alias("b")).where("b.place >= a.place")
    blocks = pairs.select(
        F.col("a.place").alias("p"), F.col("b.place").alias("q"), _outer(F.col("a.v"), F.col("b.v")).alias("_block")
    )
    gram, aimed = np.zeros((places, size, places, size)), np.zeros((places, size, size))
    for row in _summed(blocks, "p", "q").collect():
        block = np.array(row["_sum"]).reshape(size, size)
        gram[row["p"], :, row["q"], :] = block
        gram[row["q"], :, row["p"], :] = block.T
    blocks = left.select(F.col("a.place").alias("p"), _outer(F.col("a.v"), F.col("target")).alias("_block"))
    for row in _summed(blocks, "p").collect():
        aimed[row["p"]] = np.array(row["_sum"]).reshape(size, size)
    wide = places * size
    return gram.reshape(wide, wide), aimed.reshape(wide, size)


def fit_pooling(rows: DataFrame, places: int, size: int, ridge: float = RIDGE) -> np.ndarray:
    """The map, places x size x size: a basket's vector is the sum over places of v times their block."""
    gram, aimed = normal_equations(rows, places, size)
    solved = np.linalg.solve(gram + ridge * np.eye(len(gram)), aimed)
    return solved.reshape(places, size, size)


def pooled_vectors(parts: DataFrame, pooling: np.ndarray) -> DataFrame:
    """(customer, basket_pos, vector): every basket's places through their blocks, added up.

    The blocks are a table of one row per place.
    """
    places, size, _ = pooling.shape
    flat = pa.table(
        {"place": pa.array(np.arange(places, dtype=np.int32)), "_w": pa.array(list(pooling.reshape(places, -1)))}
    )
    blocks = parts.sparkSession.createDataFrame(flat)
    entries = parts.select(CUST, "basket_pos", F.inline("parts"))
    joined = lookup(entries, blocks, ["place"], places, CUST, 8 * size * size + 16)
    columns = F.sequence(F.lit(0), F.lit(size - 1))

    def column(k: Column) -> Column:
        products = F.transform("v", lambda x, j: x * F.get("_w", j * size + k))
        return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)

    made = joined.select(CUST, "basket_pos", F.transform(columns, column).alias("_block"))
    return _summed(made, CUST, "basket_pos").withColumnRenamed("_sum", "vector")


def pooling_check(rows: DataFrame, pooling: np.ndarray, ridge: float = RIDGE) -> DataFrame:
    """(place, component, target, aimed, reached): both sides of the normal equations.

    ``aimed`` is the sum over steps of a place's component times a component of the target; ``reached``
    has the pooled vector for the target, and the ridge. They are equal at the optimum, and only there.
    """
    places, size, _ = pooling.shape
    reached = rows.drop("target").join(
        pooled_vectors(rows, pooling).withColumnRenamed("vector", "made"), [CUST, "basket_pos"]
    )
    sides = []
    for table, name, side in ((rows, "target", "aimed"), (reached, "made", "reached")):
        entries = table.select(F.explode("parts").alias("a"), name)
        blocks = entries.select(F.col("a.place").alias("place"), _outer(F.col("a.v"), F.col(name)).alias("_block"))
        sums = _summed(blocks, "place").select("place", F.posexplode("_sum").alias("_cell", side))
        sides.append(sums)
    pull = pa.table(
        {
            "place": pa.array(np.repeat(np.arange(places, dtype=np.int32), size * size)),
            "_cell": pa.array(np.tile(np.arange(size * size, dtype=np.int32), places)),
            "_pull": pa.array(ridge * pooling.reshape(-1)),
        }
    )
    cells = rows.sparkSession.createDataFrame(pull)
    return sides[0].join(sides[1], ["place", "_cell"]).join(cells, ["place", "_cell"]).select(
        "place",
        F.floor(F.col("_cell") / size).alias("component"),
        (F.col("_cell") % size).alias("target"),
        "aimed",
        (F.col("reached") + F.col("_pull")).alias("reached"),
    )
