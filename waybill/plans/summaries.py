"""Summaries of short spans that are merged into any longer one: distinct counts, percentiles.

Distinct counts by day are HyperLogLog sketches, one aggregate for all columns and no row copied;
weeks and months are unions of days. With ``2**lg_k`` registers the standard error is about
``0.83 / sqrt(2**lg_k)`` (0.6 % for the default 14); few values, up to about a tenth of the
registers, are counted exactly.

Percentiles of a value come from counts by value: a bin keeps how often each value occurred, values
from ``EXACT`` on by a bucket whose bounds differ by ``WIDTH``. Counts add up, so a month's
percentile is that of its bins' counts: exact below ``EXACT``, within ``WIDTH`` above.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import bin_floor

C = F.col
LG_K = 14
EXACT = 4096
WIDTH = 0.01


def distinct_by_day(df: DataFrame, ts: str, by: Sequence[str], columns: Sequence[str],
                    lg_k: int = LG_K) -> DataFrame:
    """(day, by, a sketch a column)."""
    return df.groupBy(F.to_date(ts).alias("day"), *by).agg(
        F.count("*").alias("rows"), *(F.hll_sketch_agg(c, F.lit(lg_k)).alias(c) for c in columns))


def distinct_over(days: DataFrame, span: Column, by: Sequence[str], columns: Sequence[str]
                  ) -> DataFrame:
    """Rows and distinct counts over longer spans of days, from the days' sketches."""
    merged = days.groupBy(span, *by).agg(
        F.sum("rows").alias("rows"), *(F.hll_union_agg(c).alias(c) for c in columns))
    return merged.withColumns({c: F.hll_sketch_estimate(c) for c in columns}).withColumnsRenamed(
        {c: f"unique_{c}" for c in columns})


def bucketed(value: Column) -> Column:
    """The value itself below ``EXACT``, else the middle of its bucket."""
    step = F.floor(F.log(value / EXACT) / F.log(F.lit(1 + WIDTH)))
    middle = F.lit(float(EXACT)) * F.pow(F.lit(1 + WIDTH), step + 0.5)
    return F.when(value >= EXACT, F.round(middle)).otherwise(value).cast("long")


def counted(df: DataFrame, ts: str, by: Sequence[str], value: Column, seconds: int = 300
            ) -> DataFrame:
    """(bin, by, value, n): how often each value occurred in each bin of time."""
    return df.select(bin_floor(C(ts), seconds).alias("bin"), *by, bucketed(value).alias("value")
                     ).groupBy("bin", *by, "value").agg(F.count("*").alias("n"))


def percentiles(bins: DataFrame, by: Sequence[str], points: Sequence[float] = (0.5, 0.95, 0.99)
                ) -> DataFrame:
    """Percentiles over all bins of the frame, from the counts alone."""
    counts = bins.filter("value is not null").groupBy(*by, "value").agg(F.sum("n").alias("n"))
    return counts.groupBy(*by).agg(F.sum("n").alias("messages"), *(
        F.round(F.percentile("value", p, C("n")), 4).alias(f"p{round(p * 100)}") for p in points))
