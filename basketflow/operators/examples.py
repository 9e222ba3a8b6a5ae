"""Training examples: split, x / y, labels, sequence padding and checks."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.functions.arrays import all_but_last, last, multi_hot, pad_sequence
from basketflow.functions.hashing import hash_slice, key_hash
from basketflow.schemas import CUST

SEED = 1234
SHARES = (0.6, 0.2, 0.2)  # train, test, valid
_AFTER_ALL = "~"  # sorts behind every hex digest


def _order_key(seed: int):
    """Random but repeatable order of the customers; the key itself settles equal digests."""
    return F.concat(key_hash(seed, F.col(CUST)), F.coalesce(CUST, F.lit("")))


def split_cuts(customers: DataFrame, shares=SHARES, seed: int = SEED) -> DataFrame:
    """(_slice, _train_to, _test_to): the last order key of each part, per slice of digests.

    The parts have exactly the sizes that half-even rounding of the shares gives. Only the one or
    two slices that a boundary falls into are ranked, a HASH_SLICES-th of the customers each.
    """
    if len(shares) != 3 or abs(sum(shares) - 1) > 1e-9:
        raise ValueError("the three shares must sum to 1")
    keyed = customers.select(_order_key(seed).alias("_order"))
    keyed = keyed.withColumn("_slice", hash_slice(F.col("_order")))
    # One row per slice, so at most HASH_SLICES rows are summed up here.
    whole = Window.partitionBy()
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = (
        keyed.groupBy("_slice")
        .agg(F.count("*").alias("n"))
        .withColumn("start", F.sum("n").over(earlier) - F.col("n"))
        .withColumn("total", F.sum("n").over(whole))
    )

    def rows_below(share: float):
        """Rows of the slice that lie before the boundary."""
        boundary = F.bround(F.col("total") * F.lit(float(share))).cast("bigint")
        return F.least(F.greatest(boundary - F.col("start"), F.lit(0)), F.col("n"))

    sizes = sizes.select(
        "_slice",
        "n",
        rows_below(shares[0]).alias("train"),
        rows_below(shares[0] + shares[1]).alias("test"),
    )

    def inside(part: str):
        return (F.col(part) > 0) & (F.col(part) < F.col("n"))

    edges = sizes.where(inside("train") | inside("test"))
    in_slice = Window.partitionBy("_slice").orderBy("_order")
    edge_keys = (
        keyed.join(F.broadcast(edges), "_slice")
        .withColumn("_at", F.row_number().over(in_slice))
        .groupBy("_slice")
        .agg(
            F.max(F.when(F.col("_at") == F.col("train"), F.col("_order"))).alias("train_key"),
            F.max(F.when(F.col("_at") == F.col("test"), F.col("_order"))).alias("test_key"),
        )
    )

    def last_key(part: str):
        return (
            F.when(F.col(part) == 0, F.lit(""))
            .when(F.col(part) == F.col("n"), F.lit(_AFTER_ALL))
            .otherwise(F.col(f"{part}_key"))
        )

    return sizes.join(F.broadcast(edge_keys), "_slice", "left").select(
        "_slice", last_key("train").alias("_train_to"), last_key("test").alias("_test_to")
    )


def assign_split(rows: DataFrame, cuts: DataFrame, seed: int = SEED) -> DataFrame:
    """Add ``split`` to rows that carry the customer.

    A comparison with the cuts of the row's slice, at most HASH_SLICES rows to broadcast, so
    neither the rows nor the customers are shuffled for it.
    """
    return (
        rows.withColumn("_order", _order_key(seed))
        .withColumn("_slice", hash_slice(F.col("_order")))
        .join(F.broadcast(cuts), "_slice")
        .withColumn(
            "split",
            F.when(F.col("_order") <= F.col("_train_to"), "train")
            .when(F.col("_order") <= F.col("_test_to"), "test")
            .otherwise("valid"),
        )
        .drop("_slice", "_order", "_train_to", "_test_to")
    )


def split_customers(customers: DataFrame, shares=SHARES, seed: int = SEED) -> DataFrame:
    """Distinct customers with their part: train, test or valid."""
    return assign_split(customers, split_cuts(customers, shares, seed), seed)


def split_sizes(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("split").agg(F.count("*").alias("n_customers"))


def x_y(sequences: DataFrame, max_seq: int) -> DataFrame:
    """``x``, all baskets but the last, and ``y``, the last, of customers with 2 to max_seq - 1."""
    length = F.size("baskets")
    return sequences.where((length >= 2) & (length < max_seq)).select(
        *[c for c in sequences.columns if c != "baskets"],
        all_but_last(F.col("baskets")).alias("x"),
        last(F.col("baskets")).alias("y"),
    )


def pad_sequences(examples: DataFrame, max_seq: int, max_items: int, column: str = "x"):
    """Drop sequences of ``max_seq`` or more baskets and right-pad the others with zero baskets."""
    fits = examples.where(F.size(column) < max_seq)
    return fits.withColumn(column, pad_sequence(F.col(column), max_seq, max_items))


def labels(examples: DataFrame, exclude_pad_label: bool = False) -> DataFrame:
    """(customer, idx) for every distinct item of y; 0 is among them wherever y holds a pad."""
    rows = examples.select(CUST, F.explode(F.array_distinct("y")).alias("idx"))
    return rows.where(F.col("idx") != 0) if exclude_pad_label else rows


def with_multi_hot(examples: DataFrame, num_prods: int) -> DataFrame:
    """Replace y by its dense 0/1 vector of width num_prods + 1."""
    return examples.withColumn("y", multi_hot(F.col("y"), num_prods))


def check_examples(examples: DataFrame, max_seq: int, max_items: int) -> DataFrame:
    """One row per split: examples, and how many break a rule. All but the first must be 0."""

    def broken(rule):
        return F.coalesce(F.sum(F.when(rule, 1).otherwise(0)), F.lit(0))

    return examples.groupBy("split").agg(
        F.count("*").alias("n_examples"),
        broken(F.col("x").isNull() | F.col("y").isNull()).alias("n_missing"),
        broken(F.size("x") != max_seq).alias("n_wrong_length"),
        broken(F.exists("x", lambda b: F.size(b) != max_items)).alias("n_wrong_width"),
    )
