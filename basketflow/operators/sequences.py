"""Lines rolled up to baskets and baskets to customer sequences.

There are two forms. The long form has one row per distinct (customer, basket, item), or per kept
basket, and takes customers of any length: no customer is ever gathered in one place. The nested form has arrays, and its two bounds are
part of its meaning: baskets with ``max_items`` or more items are not modelled, and neither are
customers with ``max_seq`` or more baskets. Because such groups are left out anyway, no more than
``max_items`` items of a basket and ``max_seq`` baskets of a customer are looked at: a row_number
limit, which Spark also applies before the shuffle, cuts a huge group short in every task.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.functions.arrays import pad_basket
from basketflow.operators.ranking import HEAVY_AFTER, dense_positions
from basketflow.operators.vocabulary import encode_items
from basketflow.schemas import BASKET, CUST, PROD
from basketflow.sources.tables import materialize

HISTORY_STRETCH = 10_000


def known_customers(lines: DataFrame, anonymous: str = "drop") -> DataFrame:
    """Leave out lines without a customer, or keep them all as one nameless customer."""
    if anonymous not in ("drop", "keep"):
        raise ValueError("anonymous must be 'drop' or 'keep'")
    return lines if anonymous == "keep" else lines.where(F.col(CUST).isNotNull())


def basket_items(lines: DataFrame, anonymous: str = "drop") -> DataFrame:
    """Distinct (customer, basket, item) rows; lines without an item show as one null item."""
    keys = [CUST, BASKET, PROD]
    return known_customers(lines, anonymous).select(*keys).dropDuplicates(keys)


def basket_sequences(lines: DataFrame, heavy_after: int = HEAVY_AFTER) -> DataFrame:
    """``basket_items`` with ``basket_pos``, the place of the basket in the customer's sequence.

    Baskets are ordered by the string order of their id. Customers of any length are ranked.
    """
    keys = known_customers(lines).select(CUST, BASKET, PROD)
    ranked = dense_positions(basket_items(lines), keys, CUST, BASKET, heavy_after)
    return ranked.select(CUST, F.col("pos").alias("basket_pos"), BASKET, PROD)


def basket_arrays(items: DataFrame, max_items: int, value: str = PROD) -> DataFrame:
    """One row per basket: ``value`` of its items in item order, or null at ``max_items`` or more.

    ``items`` are rows of ``basket_items``, with ``idx`` where that is the value.
    """
    in_order = Window.partitionBy(CUST, BASKET).orderBy(F.asc_nulls_last(PROD))
    entry = F.when(F.col(PROD).isNotNull(), F.struct(F.col(PROD), F.col(value).alias("v")))
    sorted_items = F.array_sort(F.collect_list(entry))
    return (
        items.withColumn("_at", F.row_number().over(in_order))
        .where(F.col("_at") <= max_items)
        .groupBy(CUST, BASKET)
        .agg(sorted_items.alias("_items"))
        .select(
            CUST,
            BASKET,
            F.when(
                F.size("_items") < max_items, F.transform("_items", lambda e: e["v"])
            ).alias("items"),
        )
    )


def kept_baskets(items: DataFrame, max_items: int, value: str = PROD) -> DataFrame:
    """The baskets with fewer than ``max_items`` items, as arrays."""
    return basket_arrays(items, max_items, value).where(F.col("items").isNotNull())


def customer_arrays(baskets: DataFrame, max_seq: int) -> DataFrame:
    """One row per customer: ``baskets``, the ordered arrays of its kept baskets.

    Customers stay even if no basket is kept; those with ``max_seq`` or more kept ones do not.
    """
    kept = F.col("items").isNotNull()
    in_order = Window.partitionBy(CUST).orderBy(F.desc(kept), F.asc(BASKET))
    entry = F.when(kept, F.struct(BASKET, "items"))
    return (
        baskets.withColumn("_at", F.row_number().over(in_order))
        .where(F.col("_at") <= max_seq)
        .groupBy(CUST)
        .agg(F.array_sort(F.collect_list(entry)).alias("_baskets"))
        .where(F.size("_baskets") < max_seq)
        .select(CUST, F.transform("_baskets", lambda b: b["items"]).alias("baskets"))
    )


def customer_sequences(
    lines: DataFrame, max_items: int, max_seq: int, anonymous: str = "drop"
) -> DataFrame:
    """Nested sequences of item codes."""
    return customer_arrays(basket_arrays(basket_items(lines, anonymous), max_items), max_seq)


def basket_history(lines: DataFrame, stretch: int = HISTORY_STRETCH) -> DataFrame:
    """(customer, basket_pos, n_items, n_history): items of a basket, and of all up to it.

    The history as of a basket is the rows of ``basket_sequences`` with a ``basket_pos`` up to its
    own; written out it would be quadratic in a customer's length, so it is kept as that relation
    with its running size. Sums run within stretches of ``stretch`` baskets, to which the sums of
    the stretches before are added, so a long customer is shared out over many tasks.
    """
    sizes = basket_sequences(lines).groupBy(CUST, "basket_pos").agg(F.count(PROD).alias("n_items"))
    sizes = sizes.withColumn("_stretch", F.floor((F.col("basket_pos") - 1) / stretch))
    up_to = (Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(CUST).orderBy("_stretch").rowsBetween(*up_to)
    before = (
        sizes.groupBy(CUST, "_stretch")
        .agg(F.sum("n_items").alias("_sum"))
        .select(CUST, "_stretch", (F.sum("_sum").over(whole) - F.col("_sum")).alias("_before"))
    )
    within = Window.partitionBy(CUST, "_stretch").orderBy("basket_pos").rowsBetween(*up_to)
    return sizes.join(before, [CUST, "_stretch"]).select(
        CUST,
        "basket_pos",
        "n_items",
        (F.col("_before") + F.sum("n_items").over(within)).alias("n_history"),
    )


def item_occurrences(lines: DataFrame) -> DataFrame:
    """(customer, item, basket_pos, first_pos): the baskets of every item, and the first of them.

    The history as of a basket is the items with ``first_pos`` up to its own: a comparison, with
    one row per distinct line, where lists of items per basket are quadratic.
    """
    rows = basket_sequences(lines).where(F.col(PROD).isNotNull()).select(CUST, PROD, "basket_pos")
    first = rows.groupBy(CUST, PROD).agg(F.min("basket_pos").alias("first_pos"))
    return rows.join(first, [CUST, PROD])


def history_items_as_of(occurrences: DataFrame, requests: DataFrame) -> DataFrame:
    """(customer, as_of, item, first_pos, last_pos, times): the history as of the requested baskets.

    ``requests`` has (customer, as_of); a request that is there twice is answered once, one before
    the first basket has no rows, one after the last has the whole history. Only ``occurrences`` of
    customers that are asked for are read further, and what a request gets is summed up before the
    shuffle; a customer's occurrences meet its own requests alone.
    """
    asked = requests.select(CUST, "as_of").where(F.col(CUST).isNotNull()).distinct()
    return (
        occurrences.join(asked, CUST)
        .where(F.col("basket_pos") <= F.col("as_of"))
        .groupBy(CUST, "as_of", PROD)
        .agg(
            F.min("first_pos").alias("first_pos"),
            F.max("basket_pos").alias("last_pos"),
            F.count("*").alias("times"),
        )
    )


def indexed_sequences(
    lines: DataFrame, vocab: DataFrame, num_prods: int, max_items: int, max_seq: int
) -> DataFrame:
    """Nested sequences of vocabulary indices, items in the order of their codes."""
    items = encode_items(basket_items(lines), vocab, num_prods)
    return customer_arrays(basket_arrays(items, max_items, "idx"), max_seq)


def indexed_rows(lines: DataFrame, vocab: DataFrame, num_prods: int) -> DataFrame:
    """``basket_sequences`` with the vocabulary index of every item."""
    return encode_items(basket_sequences(lines), vocab, num_prods)


def padded_rows(
    lines: DataFrame, vocab: DataFrame, num_prods: int, max_items: int
) -> DataFrame:
    """(customer, basket_pos, items): every kept basket, right-padded with 0.

    Baskets with ``max_items`` or more items are dropped and the others numbered. A customer
    without a kept basket has one row without a basket.
    """
    items = encode_items(basket_items(lines), vocab, num_prods)
    kept = materialize(kept_baskets(items, max_items, "idx"), "kept-baskets")
    placed = dense_positions(kept, kept.select(CUST, BASKET), CUST, BASKET)
    rows = placed.select(
        CUST, F.col("pos").alias("basket_pos"), pad_basket(F.col("items"), max_items).alias("items")
    )
    customers = known_customers(lines).select(CUST).distinct()
    without = customers.join(kept.select(CUST).distinct(), CUST, "left_anti")
    return rows.unionByName(without, allowMissingColumns=True)


def pad_baskets(sequences: DataFrame, max_items: int) -> DataFrame:
    """Drop baskets with ``max_items`` or more items and right-pad the others with 0."""

    def fits(basket: Column) -> Column:
        return F.size(basket) < max_items

    padded = F.transform(F.filter("baskets", fits), lambda b: pad_basket(b, max_items))
    return sequences.withColumn("baskets", padded)


def padded_sequences(
    lines: DataFrame, vocab: DataFrame, num_prods: int, max_items: int, max_seq: int
) -> DataFrame:
    return pad_baskets(indexed_sequences(lines, vocab, num_prods, max_items, max_seq), max_items)
