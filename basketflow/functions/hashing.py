"""Portable, partition-independent randomness: md5 of a seed and the key.

Hex digests are compared as strings, so the same members and the same order come out on any
cluster layout and in any SQL engine.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_DIGITS = 3
HASH_SLICES = 16**SLICE_DIGITS


def key_hash(seed, *keys: Column) -> Column:
    """md5 of ``seed|key|…`` as 32 hex digits; a null key hashes like the empty string."""
    parts = [F.coalesce(k.cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def hash_slice(digest: Column) -> Column:
    """The first digits of a digest: an even, order-keeping split into HASH_SLICES parts."""
    return F.substring(digest, 1, SLICE_DIGITS)


def keep_fraction(digest: Column, rate: float) -> Column:
    """True for a share ``rate`` of all digests."""
    if rate < 0:
        raise ValueError("rate must not be negative")
    below = round(rate * 2**32)
    if below >= 2**32:
        return F.lit(True)
    return F.substring(digest, 1, 8) < F.lit(f"{below:08x}")
