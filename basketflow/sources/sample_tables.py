"""The TPC-H-like sample tables seen as retail transactions.

No join here carries a hint: the sizes of the tables are not known, so AQE chooses between
broadcast and shuffle from the sizes it measures and splits skewed keys.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.schemas import BASKET, CUST, PROD, TRANSACTIONS_SCHEMA

# Key widths: zero padding keeps string order equal to numeric order, and the widths leave room
# for keys of the largest scale factors, since lpad would cut longer ones.
CUST_WIDTH, BASKET_WIDTH, PROD_WIDTH = 12, 15, 12
# Lines whose joins are shuffled at a time: some 2 GB.
SHARE_LINES = 20_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _code(key: str, width: int) -> Column:
    return F.lpad(F.col(key).cast("string"), width, "0")


def _week(day: Column) -> Column:
    return (F.extract(F.lit("YEAROFWEEK"), day) * 100 + F.weekofyear(day)).cast("int")


def _day(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def basket_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Customer, basket and item of every line: all that the sequence operators read."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        _code("o_custkey", CUST_WIDTH).alias(CUST),
        _code("o_orderkey", BASKET_WIDTH).alias(BASKET),
        _code("l_partkey", PROD_WIDTH).alias(PROD),
    )


def transactions(spark: SparkSession, folder: str, share: tuple[int, int] = (0, 1)) -> DataFrame:
    """Every line with all 22 columns of the transaction schema.

    Of a share (i, n), the lines of the i-th of n parts of the orders, dealt by a hash of their key.
    """
    region = (
        table(spark, folder, "supplier")
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select("s_suppkey", "n_name")
    )
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    part = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    day = F.col("o_orderdate")
    values = {
        "SHOP_WEEK": _week(day),
        "SHOP_DATE": _day(day),
        "SHOP_WEEKDAY": F.dayofweek(day),
        "SHOP_HOUR": F.hour(day),
        "QUANTITY": F.col("l_quantity"),
        "SPEND": F.col("l_extendedprice"),
        "PROD_CODE": _code("l_partkey", PROD_WIDTH),
        "PROD_CODE_10": F.col("p_brand"),
        "PROD_CODE_20": F.col("p_type"),
        "PROD_CODE_30": F.col("p_size"),
        "CUST_CODE": _code("o_custkey", CUST_WIDTH),
        "CUST_LIFESTAGE": F.col("c_mktsegment"),
        "BASKET_ID": _code("o_orderkey", BASKET_WIDTH),
        "BASKET_TYPE": F.col("o_orderpriority"),
        "STORE_CODE": F.col("l_suppkey"),
        "STORE_REGION": F.col("n_name"),
    }
    # What a line has from its order comes last, with the customer: lines are shuffled once less and
    # while they are narrow.
    orders = _shared(table(spark, folder, "orders"), "o_orderkey", share).join(
        customer, F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    joined = (
        _shared(table(spark, folder, "lineitem"), "l_orderkey", share)
        .join(region, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    return joined.select(
        *[
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TRANSACTIONS_SCHEMA
        ]
    )


def transaction_shares(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The same in as many shares as keep the shuffles of each bounded."""
    n = -(-table(spark, folder, "lineitem").count() // SHARE_LINES) or 1
    return [transactions(spark, folder, (i, n)) for i in range(n)]


def _shared(df: DataFrame, key: str, share: tuple[int, int]) -> DataFrame:
    i, n = share
    # Not the hash that shuffles deal by, or a share would fill only some of their partitions.
    return df if n == 1 else df.where(F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(n)) == i)


def calendar(spark: SparkSession, folder: str) -> DataFrame:
    """First and last order day of every week."""
    day = F.col("o_orderdate")
    return (
        table(spark, folder, "orders")
        .groupBy(_week(day).alias("SHOP_WEEK"))
        .agg(_day(F.min(day)).alias("DATE_FROM"), _day(F.max(day)).alias("DATE_TO"))
    )
