"""Hash buckets whose number follows the data: one more bucket moves the rows of one other."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def address(number: Column, buckets: int) -> Column:
    """The bucket of a hash by linear hashing, for any number of buckets.

    With n + 1 buckets instead of n, only rows of bucket ``parent(n)`` change their bucket, and
    all of those that do go to bucket n.
    """
    high = 1 << (buckets - 1).bit_length()
    at = F.pmod(number, F.lit(high))
    return F.when(at < buckets, at).otherwise(at - high // 2).cast("int")


def parent(bucket: int) -> int:
    """The bucket whose rows were divided when this one was added."""
    return bucket - (1 << (bucket.bit_length() - 1))


def divided(old: int, new: int) -> list[int]:
    """Buckets among the first ``old`` that give rows away when there are ``new``."""
    out = set()
    for bucket in range(old, new):
        while bucket >= old:
            bucket = parent(bucket)
        out.add(bucket)
    return sorted(out)


def enough(rows: int, size: int, least: int = 1) -> int:
    """As many buckets as hold about ``size`` rows each."""
    return max(least, -(-rows // size))


def hash_of(keys: Iterable[str]) -> Column:
    return F.xxhash64(*keys)
