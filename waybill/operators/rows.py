"""Row-level operators: duplicate removal, filters, sorting, unions, null-safe anti join."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import as_ts


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` values, then the greatest rest.

    Written as ``max`` over a struct rather than ``row_number``: the maximum is combined on the
    map side, so a key that owns a large share of the rows never lands whole in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.max(F.struct(*order, *rest)).alias("_last")
    return df.groupBy(*keys).agg(packed).select(*keys, "_last.*").select(*df.columns)


def dedupe_repeated(df: DataFrame, repeated: DataFrame, keys: Sequence[str],
                    order: Sequence[str]) -> DataFrame:
    """As ``dedupe_latest`` for rows without null keys, where ``repeated`` holds the keys that occur
    more than once: rows of the others pass as they are, and are not shuffled for it."""
    if repeated.isEmpty():
        return df
    more = dedupe_latest(df.join(repeated, list(keys), "left_semi"), keys, order)
    return df.join(repeated, list(keys), "left_anti").select(*df.columns).unionByName(more)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; only keys are shuffled."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1).select(*keys)


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order`` values."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*order, *rest)).alias("_first")
    return df.groupBy(*keys).agg(packed).select(*keys, "_first.*").select(*df.columns)


def newer_than(df: DataFrame, ts: str, interval: str, *, as_of) -> DataFrame:
    """Rows younger than ``interval`` (such as ``'24 hours'``) at ``as_of``."""
    return df.filter(F.col(ts) > as_ts(as_of) - F.expr(f"INTERVAL {interval}"))


def between_ages(df: DataFrame, ts: str, older: str, younger: str, *, as_of) -> DataFrame:
    """Rows whose age at ``as_of`` lies between two intervals, both ends included."""
    now = as_ts(as_of)
    return df.filter(F.col(ts).between(now - F.expr(f"INTERVAL {older}"),
                                       now - F.expr(f"INTERVAL {younger}")))


def business_hours(ts: Column, first: int = 9, last: int = 17) -> Column:
    """True from ``first`` o'clock up to, not including, ``last`` o'clock."""
    hour = F.hour(ts)
    return (hour >= first) & (hour < last)


def latest_slice(df: DataFrame, column: str) -> DataFrame:
    """Rows that carry the greatest value of ``column``, by a scalar subquery."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def top_by(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows in a total order. Spark keeps n rows per task and merges those."""
    return df.orderBy(*order).limit(n)


def union_all(frames: Iterable[DataFrame], fill_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), frames)


def missing_keys(df: DataFrame, known: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``known``; null keys count as absent."""
    keys = known.select(*[F.col(k).alias(f"_known_{i}") for i, k in enumerate(on.values())])
    cond = reduce(lambda a, b: a & b,
                  [df[c] == keys[f"_known_{i}"] for i, c in enumerate(on)])
    return df.join(keys, cond, "left_anti")


def present_keys(df: DataFrame, known: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``known``; never multiplies rows."""
    keys = known.select(*[F.col(k).alias(f"_known_{i}") for i, k in enumerate(on.values())])
    cond = reduce(lambda a, b: a & b,
                  [df[c] == keys[f"_known_{i}"] for i, c in enumerate(on)])
    return df.join(keys, cond, "left_semi")
