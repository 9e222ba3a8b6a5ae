import numpy as np
import pytest

from basketflow.operators import pooling
from basketflow.schemas import CUST

WIDTH, PLACES, SIZE = 12, 4, 3


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(WIDTH, SIZE)).astype(np.float32)
    vectors[0] = 0
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "idx int, vector array<float>")
    rows = []
    for c in range(40):
        x = [[int(i) for i in rng.choice(np.arange(1, WIDTH), rng.integers(1, 4), replace=False)] for _ in range(4)]
        rows.append((f"c{c}", [b + [0] * (PLACES - len(b)) for b in x]))
    rows += [("pads", [[1, 0, 0, 0], [0] * 4, [2, 0, 0, 0]]), ("one", [[3, 0, 0, 0]])]
    examples = spark.createDataFrame(rows, f"{CUST} string, x array<array<int>>")
    return rows, vectors.astype(float), pooling.basket_parts(examples, table, WIDTH)


def test_fit_and_vectors_against_numpy(made):
    rows, vectors, parts = made
    z, target, every = [], [], {}
    for c, x in rows:
        for at, basket in enumerate(x):
            every[c, at + 1] = np.concatenate([vectors[i] for i in basket])
            if at + 1 < len(x) and any(basket) and any(x[at + 1]):
                z.append(every[c, at + 1])
                target.append(np.mean([vectors[i] for i in x[at + 1] if i], axis=0))
    z, target = np.array(z), np.array(target)
    steps = pooling.steps(parts)
    assert steps.count() == len(z)
    gram, aimed = pooling.normal_equations(steps, PLACES, SIZE)
    assert np.allclose(gram, z.T @ z) and np.allclose(aimed, z.T @ target)
    fitted = pooling.fit_pooling(steps, PLACES, SIZE, ridge=0.5)
    exact = np.linalg.solve(z.T @ z + 0.5 * np.eye(PLACES * SIZE), z.T @ target)
    assert np.allclose(fitted.reshape(-1, SIZE), exact)
    found = {(r[CUST], r.basket_pos): r.vector for r in pooling.pooled_vectors(parts, fitted).collect()}
    assert ("pads", 2) not in found
    for key, vector in found.items():
        assert vector == pytest.approx(list(every[key] @ exact))
    for r in pooling.pooling_check(steps, fitted, ridge=0.5).collect():
        assert r.aimed == pytest.approx(r.reached, abs=1e-8)


def test_too_large_for_the_driver(made):
    with pytest.raises(ValueError):
        pooling.normal_equations(made[2], 100, 1000)
