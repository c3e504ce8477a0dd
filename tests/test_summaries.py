import random

from pyspark.sql import functions as F

from waybill.plans import summaries


def test_sketches_of_days_merge_within_their_error(spark):
    """Planted: k has 30,000 values over ten days, half of them every day; few has seven."""
    df = spark.range(300_000).select(
        F.timestamp_seconds(F.lit(1704067200) + (F.col("id") % 10) * 86400).alias("ts"),
        F.when(F.col("id") % 20 < 10, F.floor(F.col("id") / 20) % 15000).otherwise(
            15000 + F.floor(F.col("id") / 20)).alias("k"),
        (F.col("id") % 7).cast("string").alias("few"), F.lit("a").alias("g"))
    exact = df.agg(F.count_distinct("k").alias("k")).first().k
    assert exact == 30_000
    days = summaries.distinct_by_day(df, "ts", ["g"], ["k", "few"])
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    row = summaries.distinct_over(days, F.trunc("day", "month").alias("m"), ["g"], ["k", "few"]).first()
    assert row["rows"] == 300_000 and row.unique_few == 7
    assert abs(row.unique_k - exact) <= 3 * 0.83 / 2 ** (summaries.LG_K / 2) * exact


def test_percentiles_of_bins_are_those_of_the_values(spark):
    rng = random.Random(2)
    small = [(i * 37 % 86400, "s", rng.randrange(900)) for i in range(3000)]
    wide = [(i * 41 % 86400, "w", int(10 ** rng.uniform(1, 7))) for i in range(3000)]
    df = spark.createDataFrame(small + wide + [(5, "s", None)], "at long, g string, v long").select(
        F.timestamp_seconds("at").alias("ts"), "g", "v")
    bins = summaries.counted(df, "ts", ["g"], F.col("v"))
    assert bins.filter("value is not null").groupBy("bin").count().count() <= 288
    got = {r.g: r for r in summaries.percentiles(bins, ["g"]).collect()}
    want = {r.g: r for r in df.groupBy("g").agg(F.count("v").alias("messages"), *(
        F.percentile("v", p).alias(f"p{round(p * 100)}") for p in (0.5, 0.95, 0.99))).collect()}
    assert got["s"].asDict() == {k: round(v, 4) if isinstance(v, float) else v
                                 for k, v in want["s"].asDict().items()}
    for p in ("p50", "p95", "p99"):
        assert abs(got["w"][p] - want["w"][p]) <= 2 * summaries.WIDTH * want["w"][p]
