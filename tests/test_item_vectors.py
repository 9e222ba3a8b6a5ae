import numpy as np
import pytest

from basketflow.operators import item_vectors as iv

WIDTH = 30


@pytest.fixture(scope="module")
def baskets(spark):
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(400):
        group = rng.integers(0, 4)
        items = rng.choice(np.arange(1 + 7 * group, 8 + 7 * group), size=rng.integers(1, 5), replace=False)
        extra = rng.integers(1, 29, size=rng.integers(0, 2))
        rows.append(([int(i) for i in {*items, *extra}] + [0],))
    return spark.createDataFrame(rows, "items array<int>").cache()


def _dense(cells):
    matrix = np.zeros((WIDTH, WIDTH))
    for r in cells.collect():
        matrix[r.idx_a, r.idx_b] = r.value
    return matrix


def test_cells_and_eigenvectors(baskets):
    cells = iv.pmi_cells(baskets)
    matrix = _dense(cells)
    assert (matrix == matrix.T).all() and (matrix >= 0).all() and matrix.any()
    values, vectors, residuals = iv.fit_vectors(cells, WIDTH, 4, passes=60)
    exact = np.linalg.eigvalsh(matrix)
    top = exact[np.argsort(-np.abs(exact), kind="stable")[:4]]
    assert values == pytest.approx(top, rel=1e-6)
    assert np.allclose(matrix @ vectors, vectors * values, atol=1e-3 * abs(top[0]))
    assert residuals == pytest.approx(np.sqrt(((matrix @ vectors - vectors * values) ** 2).sum(axis=0)), abs=1e-9)
    assert np.allclose(vectors.T @ vectors, np.eye(4), atol=1e-9)


def test_vectors_do_not_depend_on_partitions(baskets):
    a, b = (
        iv.item_vectors(iv.pmi_cells(baskets.repartition(n)), WIDTH, 3).orderBy("idx").collect() for n in (1, 7)
    )
    one, other = (np.array([r.vector for r in x]) for x in (a, b))
    assert one.shape == (WIDTH, 3) and np.allclose(one, other, atol=1e-6)
    assert not one[0].any() and not one[29].any() and one[1].any()


def test_shift_small_vocabulary_and_no_baskets(baskets):
    assert iv.pmi_cells(baskets, shift=1.0).count() < iv.pmi_cells(baskets).count()
    assert iv.fit_vectors(iv.pmi_cells(baskets), WIDTH, 50)[1].shape == (WIDTH, WIDTH)
    empty = iv.pmi_cells(baskets.limit(0))
    assert {tuple(r.vector) for r in iv.item_vectors(empty, WIDTH, 2).collect()} == {(0.0, 0.0)}
    with pytest.raises(ValueError):
        iv.fit_vectors(empty, 1 << 25, 50)


def test_checks(baskets):
    rows = iv.vector_checks(iv.pmi_cells(baskets), WIDTH, 3, passes=60).orderBy("component").collect()
    assert [r.component for r in rows] == [0, 1, 2]
    assert all(r.off < 1e-9 and r.residual < 0.01 * abs(rows[0].value) for r in rows)
