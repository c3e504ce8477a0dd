import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from waybill.functions import (
    aging_bucket, as_ts, bin_floor, day_of_week, diff_boundary, first_filled, pct, pct_change,
    ratio, sla_class, urgency, week_start, SLA_PRESETS,
)
from waybill.functions.policies import payment_status, remaining_days_class
from waybill.operators.ordered import in_order
from waybill.operators.rows import dedupe_first, dedupe_latest, missing_keys
from waybill.operators.series import anomalies, gap_fill, moving_average, period_change


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


@pytest.mark.parametrize("later, earlier, unit, want", [
    ("2024-01-01 11:01:00", "2024-01-01 10:59:00", "hour", 1),
    ("2024-01-01 10:59:59", "2024-01-01 10:00:00", "hour", 0),
    ("2024-01-02 00:00:00", "2024-01-01 23:59:59", "day", 1),
    ("2024-01-01 10:00:00", "2024-01-01 12:30:00", "hour", -2),
])
def test_boundaries(spark, later, earlier, unit, want):
    assert one(spark, diff_boundary(unit, as_ts(later), as_ts(earlier))) == want


def test_week_and_day(spark):
    ts = as_ts("2024-01-03 10:00:00")  # a Wednesday
    assert one(spark, week_start(ts)) == dt.date(2023, 12, 31)
    assert one(spark, day_of_week(ts)) == 3
    assert one(spark, bin_floor(as_ts("2024-01-03 10:07:31"), 300)) == dt.datetime(
        2024, 1, 3, 10, 5)


def test_ratios(spark):
    assert one(spark, pct(F.lit(1), F.lit(3))) == Decimal("33.33")
    assert one(spark, pct(F.lit(1), F.lit(0))) is None
    assert one(spark, ratio(F.lit(5), F.lit(1000))) == Decimal("0.01")
    assert one(spark, pct_change(F.lit(50), F.lit(200))) == Decimal("-75.00")
    assert one(spark, first_filled(F.lit(""), F.lit(None).cast("string"), F.lit("x"))) == "x"
    assert one(spark, first_filled(F.lit(""))) == ""


@pytest.mark.parametrize("hours, want", [(19, "Good"), (20, "At Risk"), (23, "At Risk"),
                                         (24, "Breached")])
def test_sla_limits(spark, hours, want):
    start = as_ts("2024-01-01 00:00:00")
    now = start + F.make_dt_interval(hours=F.lit(hours))
    none = F.lit(None).cast("timestamp")
    assert one(spark, sla_class(start, none, now)) == want


def test_sla_finished_and_inclusive(spark):
    start, day = as_ts("2024-01-01 00:00:00"), as_ts("2024-01-02 00:00:00")
    assert one(spark, sla_class(start, day, day)) == "Met"
    assert one(spark, sla_class(start, as_ts("2024-01-02 01:00:00"), day)) == "Missed"
    assert one(spark, sla_class(start, None, as_ts("2024-01-01 20:00:00"),
                                SLA_PRESETS["inclusive"])) == "Good"
    assert one(spark, remaining_days_class(as_ts("2024-01-04 00:00:00"), start)) == "Good"


@pytest.mark.parametrize("days, want", [(0, "Current"), (1, "1-30"), (30, "1-30"), (31, "31-60"),
                                        (60, "31-60"), (61, "61-90"), (90, "61-90"), (91, "90+")])
def test_aging(spark, days, want):
    assert one(spark, aging_bucket(F.lit(days), F.lit(days > 0))) == want


def test_payment_and_urgency(spark):
    now, past = as_ts("2024-02-01 00:00:00"), as_ts("2024-01-30 00:00:00")
    states = [one(spark, payment_status(F.lit(10), F.lit(p), d, now))
              for p, d in ((10, past), (4, past), (0, past), (0, now))]
    assert states == ["Paid", "Partial", "Overdue", "Pending"]
    assert one(spark, payment_status(F.lit(10), F.lit(0), past, now, grace_days=7)) == "Pending"
    assert [one(spark, urgency(F.lit(h))) for h in (-1, 24, 25, 49, 73)] == [
        "Overdue", "Critical", "High", "Medium", "Normal"]


def test_dedupe_total_order(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, 1, "c")],
                               "k int, t int, v string")
    assert {(r.k, r.v) for r in dedupe_latest(df, ["k"], ["t"]).collect()} == {(1, "b"), (2, "c")}
    assert {(r.k, r.v) for r in dedupe_first(df, ["k"], ["t"]).collect()} == {(1, "z"), (2, "c")}


def test_missing_keys_counts_nulls(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (None,)], "k int")
    assert {r.k for r in missing_keys(a, b, {"k": "k"}).collect()} == {2, None}


def test_in_order_across_days(spark):
    times = ["2024-01-01 10:00:00", "2024-01-01 11:00:00", "2024-01-03 09:00:00"]
    df = spark.createDataFrame([("a", t, i) for i, t in enumerate(times)] + [("b", times[0], 9)],
                               "k string, t string, v int").withColumn(
        "t", F.col("t").cast("timestamp"))
    rows = in_order(df, ["k"], ["t", "v"], ["v"]).collect()
    got = {(r.k, r.v): (r.sequence, None if r.previous is None else r.previous.v) for r in rows}
    assert got == {("a", 0): (1, None), ("a", 1): (2, 0), ("a", 2): (3, 1), ("b", 9): (1, None)}


def test_series(spark):
    start, end = "2024-01-01 00:00:00", "2024-01-01 06:00:00"
    df = spark.createDataFrame([("2024-01-01 01:10:00",), ("2024-01-01 01:20:00",),
                                ("2024-01-01 04:00:00",), (end,)], "s string").withColumn(
        "timestamp", F.col("s").cast("timestamp"))
    filled = gap_fill(df, "timestamp", 3600, start, end)
    assert [r["count"] for r in filled.orderBy("ts").collect()] == [0, 2, 0, 0, 1, 0]
    avg = moving_average(filled, "count", 3, 3600).orderBy("ts").collect()
    assert [float(r.moving_avg) for r in avg] == [0.0, 1.0, 0.67, 0.67, 0.33, 0.33]
    change = period_change(df, "timestamp", 3 * 3600, as_of=end).first()
    assert (change.current, change.previous) == (2, 2)


def test_anomaly_is_found(spark):
    rows = [(f"2024-01-{d:02d} {h:02d}:00:00", 10 + (d + h) % 3) for d in range(1, 15)
            for h in range(24)]
    rows[100] = (rows[100][0], 60)
    df = spark.createDataFrame(rows, "s string, count int").withColumn(
        "ts", F.col("s").cast("timestamp"))
    hits = anomalies(df, "count").filter("anomaly != 0").collect()
    assert [(r.s, r.anomaly) for r in hits] == [(rows[100][0], 1)]
