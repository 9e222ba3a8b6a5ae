import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus  # noqa: E402
from basketflow.llm.shared import ship  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    ship(spark)
    return spark.createDataFrame(corpus.rows(1), corpus.SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    ship(spark)
    return spark.createDataFrame([], corpus.SCHEMA)
