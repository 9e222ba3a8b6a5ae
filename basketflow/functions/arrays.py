"""Padding and label encoding of array columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketflow.schemas import PAD


def pad_basket(basket: Column, width: int) -> Column:
    """Right-pad a basket with zeros; wider baskets are left as they are."""
    missing = F.greatest(F.lit(width) - F.size(basket), F.lit(0))
    return F.concat(basket, F.array_repeat(F.lit(PAD), missing))


def pad_sequence(baskets: Column, length: int, width: int) -> Column:
    """Right-pad a sequence with all-zero baskets; present baskets are not touched."""
    missing = F.greatest(F.lit(length) - F.size(baskets), F.lit(0))
    blank = F.array_repeat(F.lit(PAD), width)
    return F.concat(baskets, F.array_repeat(blank, missing))


def all_but_last(baskets: Column) -> Column:
    return F.slice(baskets, 1, F.greatest(F.size(baskets) - 1, F.lit(0)))


def last(baskets: Column) -> Column:
    return F.try_element_at(baskets, F.lit(-1))


def multi_hot(items: Column, num_prods: int) -> Column:
    """0/1 vector over the classes 0..num_prods; repeated items count once.

    The distinct items are sorted, and each adds the zeros up to it and a one.
    """
    known = F.filter(items, lambda i: (i >= 0) & (i <= num_prods))
    ones = F.array_sort(F.array_distinct(known)).cast("array<int>")
    before = F.concat(F.array(F.lit(-1)), ones)
    after = F.concat(ones, F.array(F.lit(num_prods + 1)))
    gaps = F.zip_with(before, after, lambda a, b: F.array_repeat(F.lit(0), b - a - 1))
    marked = F.transform(
        gaps, lambda gap, i: F.when(i < F.size(ones), F.concat(gap, F.array(F.lit(1)))).otherwise(gap)
    )
    return F.flatten(marked)
