"""Customer samples."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.functions.hashing import keep_fraction, key_hash
from basketflow.schemas import CUST

SEED = 42


def customer_keys(df: DataFrame) -> DataFrame:
    """Distinct customers; null counts as one."""
    return df.select(CUST).dropDuplicates()


def sample_customers(df: DataFrame, rate: float, seed: int = SEED) -> DataFrame:
    """All rows of a share ``rate`` of the customers.

    Membership is a property of the key, so the sample is a filter on the scan: no distinct, no
    join, no shuffle. Rows without a customer never belong to a sample.
    """
    member = keep_fraction(key_hash(seed, F.col(CUST)), rate)
    return df.where(F.col(CUST).isNotNull() & member)
