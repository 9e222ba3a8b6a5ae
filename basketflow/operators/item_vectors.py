"""Repeatable item vectors: the leading eigenvectors of the shifted positive PMI of item pairs.

The matrix is as sparse as the pairs that share baskets. Randomised subspace iteration multiplies it
with a thin matrix of one row per item, one join and one aggregation a pass; only the thin matrix,
vocabulary times ``size`` numbers, is held on the driver, where a QR keeps its columns apart. The
start is made from hashes and signs are fixed, so the vectors do not depend on cores or partitions
beyond the rounding of sums.
"""


import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.operators.affinity import counted_pairs, pairs_with_totals
from basketflow.operators.lookup import lookup
from basketflow.sources.tables import materialize

SHIFT = 0.0
PASSES, EXTRA = 12, 10
SEED = 42
# The thin matrix is held on the driver; a larger one is refused.
MOST_NUMBERS = 1 << 27


def pmi_cells(baskets: DataFrame, shift: float = SHIFT) -> DataFrame:
    """(idx_a, idx_b, value), stored: positive shifted PMI of both orders of every pair.

    value = log(n_both * n_baskets / (n_a * n_b)) - shift where that is above 0.
    """
    pairs = pairs_with_totals(counted_pairs(baskets))
    ratio = F.col("n_both") * F.col("n_baskets") / (F.col("n_a") * F.col("n_b")).cast("double")
    upper = pairs.select("a", "b", (F.log(ratio) - shift).alias("value")).where("value > 0")
    ends = F.array(
        F.struct(F.col("a").alias("idx_a"), F.col("b").alias("idx_b")),
        F.struct(F.col("b").alias("idx_a"), F.col("a").alias("idx_b")),
    )
    return materialize(upper.select(F.explode(ends).alias("e"), "value").select("e.*", "value"), "pmi")


def _start(width: int, size: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(width, size))


def _frame(cells: DataFrame, key: str, name: str, thin: np.ndarray) -> DataFrame:
    """A row per item with its row of the thin matrix."""
    places = pa.array(np.arange(len(thin), dtype=np.int32))
    offsets = pa.array(np.arange(len(thin) + 1, dtype=np.int32) * thin.shape[1])
    rows = pa.ListArray.from_arrays(offsets, pa.array(thin.reshape(-1)))
    return cells.sparkSession.createDataFrame(pa.table({key: places, name: rows}))


def _times(cells: DataFrame, thin: np.ndarray) -> np.ndarray:
    """Product of the sparse matrix and the thin one."""
    width, size = thin.shape
    rows = _frame(cells, "idx_b", "_row", thin)
    joined = lookup(cells, rows, ["idx_b"], width, "idx_a", 8 * size + 16)
    scaled = F.transform("_row", lambda x: x * F.col("value"))
    total = vector_to_array(Summarizer.sum(array_to_vector(scaled))).alias("_sum")
    result = np.zeros(thin.shape)
    for row in joined.groupBy("idx_a").agg(total).collect():
        result[row["idx_a"]] = row["_sum"]
    return result


def fit_vectors(
    cells: DataFrame, num_labels: int, size: int, passes: int = PASSES, seed: int = SEED
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors, residuals) of the ``size`` eigenvalues of largest magnitude.

    The eigenvectors have length 1 and their largest component is positive. A residual is the length
    of A v - value * v. Fewer than ``size`` come out for a smaller vocabulary.
    """
    wide = min(size + EXTRA, num_labels)
    if num_labels * wide > MOST_NUMBERS:
        raise ValueError("vocabulary times size is too large for the driver")
    basis = np.linalg.qr(_start(num_labels, wide, seed))[0]
    for _ in range(passes):
        basis = np.linalg.qr(_times(cells, basis))[0]
    image = _times(cells, basis)
    small = basis.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-np.abs(values), kind="stable")[:size]
    values, turn = values[order], turn[:, order]
    vectors = basis @ turn
    top = np.abs(vectors).argmax(axis=0)
    signs = np.where(vectors[top, np.arange(len(order))] < 0, -1.0, 1.0)
    residuals = np.sqrt(((image @ turn - vectors * values) ** 2).sum(axis=0))
    return values, vectors * signs, residuals


def item_vectors(
    cells: DataFrame, num_labels: int, size: int, passes: int = PASSES, seed: int = SEED
) -> DataFrame:
    """(idx, vector) for 0 … num_labels - 1: eigenvectors scaled by the roots of their eigenvalues.

    Inner products of the vectors approach the PMI of the items where eigenvalues are positive; those
    of negative ones are left 0. Items without a cell, and padding, have a zero vector.
    """
    values, vectors, _ = fit_vectors(cells, num_labels, size, passes, seed)
    scaled = vectors * np.sqrt(np.maximum(values, 0))
    scaled = np.round(scaled, 12) + 0.0
    return _frame(cells, "idx", "vector", scaled.astype(np.float32))


def vector_checks(cells: DataFrame, num_labels: int, size: int, passes: int = PASSES) -> DataFrame:
    """(component, value, residual, off): eigenvalue, length of A v - value * v, and how far the vector
    is from length 1 and a right angle to those before it."""
    values, vectors, residuals = fit_vectors(cells, num_labels, size, passes)
    gram = np.abs(np.tril(vectors.T @ vectors - np.eye(len(values)))).max(axis=1)
    rows = [
        (i, float(v), float(r), float(g)) for i, (v, r, g) in enumerate(zip(values, residuals, gram))
    ]
    return cells.sparkSession.createDataFrame(rows, "component int, value double, residual double, off double")
