import os
import random
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from basketflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    conf = {"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": shared}
    session = local_session(4, "basketflow tests", **conf)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    """Folder of the smallest sample tables."""
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _purchases():
    """Lines of seven customers, some repeated: one has a single basket, one buys a great deal."""
    rng, rows = random.Random(11), []
    for c in range(7):
        for b in range(1 if c == 3 else rng.randint(2, 9)):
            for _ in range(rng.randint(1, 7)):
                rows.append((f"k{c}", f"{b * 37 + c:06d}", f"i{rng.randint(0, 14):02d}"))
    rows += rows[::5]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def purchases():
    return _purchases()


@pytest.fixture(scope="session")
def expected(purchases):
    """Items of every basket of every customer, in basket order."""
    found = {}
    for c, b, i in purchases:
        found.setdefault(c, {}).setdefault(b, set()).add(i)
    return {c: [baskets[b] for b in sorted(baskets)] for c, baskets in found.items()}


@pytest.fixture(scope="session")
def lines(spark, purchases):
    schema = "CUST_CODE string, BASKET_ID string, PROD_CODE string"
    return spark.createDataFrame(purchases, schema).cache()
