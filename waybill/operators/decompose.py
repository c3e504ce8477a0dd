"""A series as trend, season and rest, each by medians, so that outliers do not bend them.

The period is the lag at which a series' changes repeat best: of all lags whose autocorrelation is
at least ``NEAR`` of the largest, the smallest, so that two or three periods are not taken for one.
The trend is a moving median over one period, the season the median of what is left, by phase, and
outliers are the rests beyond Tukey's fences of their own series.

A series is one row a bin of time, so its length is its time span over the bin's width; the series
are dealt over the tasks, and within one every step is a window or an aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

C = F.col
NEAR = 0.9
LEAST = 0.3  # an autocorrelation below this is no period


def _median(values: Column) -> Column:
    """Of an array without nulls; the mean of the two middle ones for an even number."""
    def middle(v: Column) -> Column:
        n = F.size(v)
        return (F.element_at(v, F.floor((n - 1) / 2).cast("int") + 1)
                + F.element_at(v, F.floor(n / 2).cast("int") + 1)) / 2

    return F.element_at(F.transform(F.array(F.array_sort(values)), middle), 1)


def periods(series: DataFrame, by: Sequence[str], index: str, value: str,
            lags: Sequence[int]) -> DataFrame:
    """(by, period) of every series; null where no lag repeats it."""
    order = Window.partitionBy(*by).orderBy(index)
    steps = series.select(*by, index, (C(value) - F.lag(value).over(order)).alias("_d"))
    lagged = steps.select(*by, "_d", *(F.lag("_d", k).over(order).alias(f"_l{k}") for k in lags))
    pairs = lagged.select(*by, C("_d").alias("x"), F.explode(F.array(*(F.struct(
        F.lit(k).alias("lag"), C(f"_l{k}").alias("y")) for k in lags))).alias("_p"))
    x, y = C("x").cast("double"), C("_p.y").cast("double")
    sums = pairs.filter(C("x").isNotNull() & C("_p.y").isNotNull()).groupBy(*by, C("_p.lag")).agg(
        F.count("*").alias("n"), *(F.sum(v).alias(k) for k, v in (
            ("sx", x), ("sy", y), ("xy", x * y), ("xx", x * x), ("yy", y * y))))
    spread = F.sqrt(F.greatest((C("n") * C("xx") - C("sx") * C("sx"))
                               * (C("n") * C("yy") - C("sy") * C("sy")), F.lit(0.0)))
    like = sums.withColumn("r", F.try_divide(C("n") * C("xy") - C("sx") * C("sy"), spread))
    found = like.groupBy(*by).agg(F.max("r").alias("_best"),
                                  F.collect_list(F.struct("lag", "r")).alias("_r"))
    fits = F.filter("_r", lambda f: (f["r"] >= NEAR * C("_best")) & (C("_best") >= LEAST))
    # a series of one or two steps has no pairs, and no period
    return series.select(*by).distinct().join(found.select(*by, F.array_min(F.transform(
        fits, lambda f: f["lag"])).alias("period")), by, "left")


def decompose(series: DataFrame, by: Sequence[str], index: str, value: str, lags: Sequence[int],
              fence: float = 3.0) -> DataFrame:
    """Adds period, trend, season, residual and is_anomaly.

    ``series`` has one row a step: ``index`` counts them without gaps. A series without a period
    has no season, and its trend is the median over the longest lag.
    """
    by, span = list(by), max(lags)
    found = periods(series, by, index, value, lags)
    rows = series.join(found, by)
    # the frame of the longest period, cut down to the series' own
    frame = Window.partitionBy(*by).orderBy(index).rangeBetween(-(span // 2), span // 2)
    half = F.floor(F.coalesce("period", F.lit(span)) / 2)
    near = F.filter(F.collect_list(F.struct(C(index).alias("i"), C(value).cast("double").alias("v")))
                    .over(frame), lambda x: F.abs(x["i"] - C(index)) <= half)
    rows = rows.withColumn("_near", near).withColumn(
        "trend", _median(F.transform("_near", lambda x: x["v"]))).drop("_near")
    phase = F.coalesce(F.pmod(C(index), C("period")), F.lit(0))
    rows = rows.withColumns({"_phase": phase, "_left": C(value) - C("trend")})
    season = rows.groupBy(*by, "_phase").agg(F.percentile("_left", 0.5).alias("_s"))
    rows = rows.join(season, [*by, "_phase"]).withColumn(
        "season", F.when(C("period").isNotNull(), C("_s")).otherwise(0.0)).withColumn(
        "residual", C("_left") - C("season"))
    fences = rows.groupBy(*by).agg(F.percentile("residual", [0.25, 0.75]).alias("_q"))
    low, high = C("_q")[0], C("_q")[1]
    outside = (C("residual") < low - fence * (high - low)) | (
        C("residual") > high + fence * (high - low))
    return rows.join(fences, by).select(*series.columns, "period", "trend", "season", "residual",
                                        outside.alias("is_anomaly"))
