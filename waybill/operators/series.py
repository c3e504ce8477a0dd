"""Time series as rows: gap filling, moving averages, seasonal anomalies, period comparison."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import as_ts, bin_floor, pct_change, ratio

C = F.col


STRETCH = 1024  # bins that are made from one row


def spine(df: DataFrame, seconds: int, start, end, by: Sequence[str] = ()) -> DataFrame:
    """Bin starts from ``start`` up to, not including, ``end``, for every value of ``by``.

    Bins are made in two steps, stretches first, so that no row ever holds all of them and the
    stretches spread over tasks.
    """
    first = F.unix_seconds(bin_floor(as_ts(start), seconds))
    bins = F.ceil((F.unix_seconds(as_ts(end)) - first) / seconds).cast("bigint")
    base = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    last = F.floor((bins - 1) / STRETCH).cast("bigint")
    stretches = base.select(*by, F.explode(F.when(bins > 0, F.sequence(
        F.lit(0).cast("bigint"), last))).alias("_stretch")).repartition(*by, "_stretch")
    at = C("_stretch") * STRETCH
    return stretches.select(*by, F.explode(F.sequence(
        at, F.least(at + STRETCH, bins) - 1)).alias("_bin")).select(
        *by, F.timestamp_seconds(first + C("_bin") * seconds).alias("ts"))


def gap_fill(df: DataFrame, ts: str, seconds: int, start, end, by: Sequence[str] = (),
             name: str = "count") -> DataFrame:
    """Row count per time bin, with zero for bins in which nothing happened."""
    rows = df.filter((C(ts) >= as_ts(start)) & (C(ts) < as_ts(end)))
    counts = rows.groupBy(*by, bin_floor(C(ts), seconds).alias("ts")).agg(
        F.count("*").alias(name))
    return spine(df, seconds, start, end, by).join(counts, [*by, "ts"], "left").withColumn(
        name, F.coalesce(name, F.lit(0)))


def moving_average(series: DataFrame, value: str, n: int, seconds: int,
                   by: Sequence[str] = (), centred: bool = False, scale: int = 2,
                   name: str = "moving_avg") -> DataFrame:
    """Average of each bin and the ``n - 1`` bins before it (or around it).

    Every bin sends its value to the bins whose window holds it; one grouping by bin then gives
    the average. This keeps even a single series spread over tasks, which an ordered window
    without partition columns would not.
    """
    low, high = (-(n // 2), n - 1 - n // 2) if centred else (0, n - 1)
    spread = series.withColumn("_shift", F.explode(F.sequence(F.lit(low), F.lit(high))))
    target = C("ts") + F.make_dt_interval(secs=(C("_shift") * seconds))
    own = F.max(F.when(C("_shift") == 0, C(value)))
    return (spread.withColumn("ts", target).groupBy(*by, "ts")
            .agg(own.alias(value), ratio(F.sum(value), F.count(value), scale).alias(name))
            .filter(C(value).isNotNull()))


def anomalies(series: DataFrame, value: str, k: float = 1.5, scale: int = 4,
              by: Sequence[str] = ()) -> DataFrame:
    """Bins whose deviation from the usual value of their hour is unusual.

    Baseline: median per hour of the day, for each value of ``by``. A residual below Q1 - k*IQR
    or above Q3 + k*IQR of its series' residuals is flagged -1 or +1; ``score`` is the residual
    in units of the IQR. Medians and quartiles run over distinct values with their counts.
    """
    by = list(by)
    own = [C(f"s.{c}").eqNullSafe(C(f"o.{c}")) for c in by]
    hour = F.hour("ts")
    usual = series.groupBy(*by, hour.alias("_hour"), C(value).alias("_v")).agg(
        F.count("*").alias("_n")).groupBy(*by, "_hour").agg(
        F.percentile("_v", 0.5, C("_n")).alias("baseline"))
    at = reduce(lambda a, b: a & b, own, C("s._hour") == C("o._hour"))
    rest = (series.withColumn("_hour", hour).alias("s").join(usual.alias("o"), at)
            .select(*(C(f"s.{c}") for c in series.columns), "o.baseline")
            .withColumn("residual", C(value) - C("baseline")))
    quartiles = rest.groupBy(*by, "residual").agg(F.count("*").alias("_n")).groupBy(*by).agg(
        F.percentile("residual", [0.25, 0.75], C("_n")).alias("_q"))
    if by:
        rest = rest.alias("s").join(quartiles.alias("o"), reduce(lambda a, b: a & b, own)).select(
            "s.*", "o._q")
    else:
        rest = rest.withColumn("_q", quartiles.select("_q").scalar())
    q1, q3 = C("_q")[0], C("_q")[1]
    spread = q3 - q1
    flag = (F.when(C("residual") > q3 + F.lit(k) * spread, 1)
            .when(C("residual") < q1 - F.lit(k) * spread, -1).otherwise(0))
    return rest.withColumns({
        "anomaly": flag, "score": F.round(F.try_divide(C("residual"), spread), scale)}).drop("_q")


def period_change(df: DataFrame, ts: str, seconds: int, by: Sequence[str] = (), *,
                  as_of) -> DataFrame:
    """Rows in the last period and the one before it, with the change in percent, in one pass."""
    now = as_ts(as_of)
    width = F.make_dt_interval(secs=F.lit(seconds))
    middle, first = now - width, now - width - width
    current: Column = C(ts) > middle
    # both ends belong to the earlier period
    previous = C(ts).between(first, middle)
    return df.filter(C(ts) >= first).groupBy(*by).agg(
        F.count_if(current).alias("current"), F.count_if(previous).alias("previous"),
    ).withColumn("change_percent", pct_change(C("current"), C("previous")))
