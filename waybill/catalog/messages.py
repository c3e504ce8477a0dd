"""Registered message analytics, time series, filters and small operators over raw messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.catalog.base import query
from waybill.catalog.gold import cnt
from waybill.catalog.views_sql import MNOW, avg, pct, rnd
from waybill.functions import bin_floor
from waybill.operators import rows, series
from waybill.plans import messages as m
from waybill.plans import reports

C = F.col
TS = '"timestamp"'


def last(interval: str) -> str:
    return f"{TS} > {MNOW} - INTERVAL {interval}"


def text(expr: str, name: str) -> str:
    return f"({expr})::VARCHAR AS {name}"


LAT_S = f"date_diff('second', {TS}, ingestion_time)"
LAT_M = f"date_diff('minute', {TS}, ingestion_time)"
HOUR = f"hour({TS})"
HOUR_BIN = f"date_trunc('hour', {TS})"
BUSINESS = f"hour({TS}) >= 9 AND hour({TS}) < 17"


def raw_query(name: str, sql: str):
    return query(name, views="raw", sql=sql)


@raw_query("msg_1_totals", f"""
SELECT {text(f'min({TS})', 'first_message')}, {text(f'max({TS})', 'last_message')},
  count(*) AS total_messages FROM raw""")
def _(t):
    return m.totals(t.raw)


@raw_query("msg_2_recent", f"""
SELECT {text(TS, 'timestamp')}, idoc_type, message_type, sap_system, docnum
FROM raw ORDER BY raw.{TS} DESC, docnum LIMIT 10""")
def _(t):
    return m.most_recent(t.raw)


for _by in ("message_type", "idoc_type", "sap_system"):
    @raw_query(f"msg_3_by_{_by}", f"SELECT {_by}, count(*) AS total FROM raw GROUP BY 1")
    def _(t, by=_by):
        return m.count_by(t.raw, by).orderBy(F.desc("total"), by)


@raw_query("msg_3_by_category", """
SELECT CASE message_type WHEN 'ORDERS' THEN 'Orders' WHEN 'INVOIC' THEN 'Invoices'
  WHEN 'WHSCON' THEN 'Warehouse Operations' WHEN 'DESADV' THEN 'Delivery Advices'
  WHEN 'SHPMNT' THEN 'Shipments' ELSE 'Other' END AS category, count(*) AS total
FROM raw GROUP BY 1""")
def _(t):
    return m.by_category(t.raw)


@raw_query("msg_3_production_only", """
SELECT message_type, count(*) AS total FROM raw WHERE sap_system = 'PRD' GROUP BY 1""")
def _(t):
    return m.count_by(t.raw.filter(C("sap_system") == "PRD"), "message_type")


@raw_query("msg_4_per_hour", f"""
SELECT {text(HOUR_BIN, 'bin')}, count(*) AS total FROM raw WHERE {last('24 HOUR')} GROUP BY 1""")
def _(t):
    return m.volume(t.raw, 3600, "24 hours", as_of=t.message_as_of)


@raw_query("msg_4_per_minute", f"""
SELECT {text(f"date_trunc('minute', {TS})", 'bin')}, count(*) AS total
FROM raw WHERE {last('1 HOUR')} GROUP BY 1""")
def _(t):
    return m.volume(t.raw, 60, "1 hour", as_of=t.message_as_of)


@raw_query("msg_4_type_per_hour", f"""
SELECT message_type, {text(HOUR_BIN, 'hour')}, count(*) AS total FROM raw
WHERE {last('7 DAY')} GROUP BY 1, 2 ORDER BY 2 DESC, 3 DESC, 1 LIMIT 50""")
def _(t):
    return m.hourly_by_type(t.raw, as_of=t.message_as_of)


@raw_query("msg_5_by_hour_of_day",
           f"SELECT {HOUR}::INTEGER AS hour, count(*) AS total FROM raw GROUP BY 1")
def _(t):
    return m.by_hour_of_day(t.raw)


@raw_query("msg_5_by_weekday", f"""
SELECT dayofweek({TS})::INTEGER AS day_number, dayname({TS}) AS day_name, count(*) AS total
FROM raw GROUP BY 1, 2""")
def _(t):
    return m.by_weekday(t.raw)


@raw_query("msg_6_top_types", """
SELECT message_type, count(*) AS total FROM raw GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def _(t):
    return m.top_types(t.raw)


@raw_query("msg_7_weekly_orders", f"""
SELECT count(*) AS total_orders, count(DISTINCT sap_system) AS systems,
  {rnd('count(*)', '7')} AS orders_per_day
FROM raw WHERE {last('7 DAY')} AND message_type LIKE 'ORDERS%'""")
def _(t):
    return m.weekly_orders(t.raw, as_of=t.message_as_of)


@raw_query("msg_8_processed_orders", f"""
SELECT {text(TS, 'timestamp')}, docnum AS order_number, sap_system, status
FROM raw WHERE {last('24 HOUR')} AND message_type = 'ORDERS' AND status = '03'""")
def _(t):
    return m.processed_orders(t.raw, as_of=t.message_as_of)


def change(days: str, by: str = "") -> str:
    cur = cnt(f"{TS} > {MNOW} - INTERVAL {days}")
    twice = f"{MNOW} - INTERVAL {days} - INTERVAL {days}"
    prev = cnt(f"{TS} BETWEEN {twice} AND {MNOW} - INTERVAL {days}")
    return (f"SELECT {by} {cur} AS current, {prev} AS previous, "
            f"{pct(f'{cur} - {prev}', prev)} AS change_percent FROM raw WHERE {TS} >= {twice}")


@raw_query("msg_9_week_over_week", change("7 DAY"))
def _(t):
    return series.period_change(t.raw, "timestamp", 7 * 86400, as_of=t.message_as_of)


@raw_query("msg_9_hour_over_hour", change("1 HOUR"))
def _(t):
    return series.period_change(t.raw, "timestamp", 3600, as_of=t.message_as_of)


@raw_query("msg_9_growth_by_type", change("7 DAY", "message_type,") + " GROUP BY message_type")
def _(t):
    return m.growth_by_type(t.raw, as_of=t.message_as_of)


@raw_query("ts_5_daily_trend", change("1 DAY", "sap_system,") + " GROUP BY sap_system")
def _(t):
    return series.period_change(t.raw, "timestamp", 86400, ["sap_system"],
                                as_of=t.message_as_of)


def quantiles(value: str) -> str:
    return ", ".join(f"round(quantile_cont({value}, {p}), 4)::DOUBLE AS p{round(p * 100)}"
                     for p in (0.5, 0.95, 0.99))


@raw_query("msg_10_latency", f"""
SELECT count(*) AS messages, {avg(LAT_S)} AS avg_latency, max({LAT_S}) AS max_latency,
  {quantiles(LAT_S)} FROM raw WHERE {last('1 HOUR')}""")
def _(t):
    return m.latency_percentiles(rows.newer_than(t.raw, "timestamp", "1 hour",
                                                 as_of=t.message_as_of))


@raw_query("msg_10_latency_by_type", f"""
SELECT message_type, {avg(LAT_S)} AS avg_latency FROM raw WHERE {last('1 HOUR')} GROUP BY 1""")
def _(t):
    return m.latency_by_type(t.raw, as_of=t.message_as_of)


@raw_query("msg_10_percentiles_by_type", f"""
SELECT message_type, count(*) AS messages, {avg(LAT_S)} AS avg_latency,
  max({LAT_S}) AS max_latency, {quantiles(LAT_S)}
FROM raw GROUP BY 1""")
def _(t):
    return m.latency_percentiles(t.raw, ["message_type"]).orderBy(F.desc("p95"), "message_type")


@raw_query("msg_10_latency_5min", f"""
SELECT {text(f"time_bucket(INTERVAL 5 MINUTE, {TS})", 'bin')}, {avg(LAT_S)} AS avg_latency
FROM raw WHERE {last('1 HOUR')} GROUP BY 1""")
def _(t):
    return m.latency_by_bin(t.raw, as_of=t.message_as_of)


SIZE = "strlen(data)"


@raw_query("msg_11_sizes", f"""
SELECT message_type, {rnd(f'sum({SIZE})', f'count({SIZE}) * 1024', 4)} AS avg_size_kb,
  {rnd(f'min({SIZE})', '1024', 4)} AS min_size_kb, {rnd(f'max({SIZE})', '1024', 4)} AS max_size_kb,
  {rnd(f'sum({SIZE})', '1024 * 1024', 4)} AS total_size_mb FROM raw GROUP BY 1""")
def _(t):
    return m.sizes(t.raw)


@raw_query("msg_12_health", f"""
SELECT *, CASE WHEN messages_received = 0 THEN 'NO DATA' WHEN avg_latency_sec < 60 THEN 'HEALTHY'
  WHEN avg_latency_sec < 300 THEN 'DEGRADED' ELSE 'WARNING' END AS status
FROM (SELECT count(*) AS messages_received, {avg(LAT_S)} AS avg_latency_sec,
  count(DISTINCT message_type) AS different_types, count(DISTINCT sap_system) AS active_systems,
  {text(f'max({TS})', 'last_message')} FROM raw WHERE {last('1 HOUR')})""")
def _(t):
    return m.health(t.raw, as_of=t.message_as_of)


@raw_query("msg_12_health_summary", f"""
SELECT *, CASE WHEN message_count = 0 THEN 'CRITICAL - No Data'
  WHEN error_rate > 10 THEN 'WARNING - High Error Rate'
  WHEN avg_latency_sec > 120 THEN 'WARNING - High Latency' ELSE 'HEALTHY' END AS health_status
FROM (SELECT count(*) AS message_count, count(DISTINCT message_type) AS distinct_types,
  {avg(LAT_S)} AS avg_latency_sec, {cnt("status <> '03'")} AS error_count,
  {pct(cnt("status <> '03'"), 'count(*)')} AS error_rate
FROM raw WHERE {last('24 HOUR')})""")
def _(t):
    return m.health_summary(t.raw, 24, as_of=t.message_as_of)


@raw_query("msg_13_errors", f"""
SELECT {text(TS, 'timestamp')}, message_type, docnum, status, sap_system
FROM raw WHERE status <> '03'""")
def _(t):
    return m.errors(t.raw)


@raw_query("msg_13_error_counts", """
SELECT message_type, status AS status_code, count(*) AS errors
FROM raw WHERE status <> '03' GROUP BY 1, 2""")
def _(t):
    return m.error_counts(t.raw)


def spike_sql(factor: str) -> str:
    mean = rnd("sum(n)", "count(n)", 4)
    return f"""
WITH week AS (SELECT {HOUR_BIN} AS b, count(*) AS n FROM raw WHERE {last('7 DAY')} GROUP BY 1),
  mean AS (SELECT {mean} AS a, sum(n)::BIGINT AS s, count(n) AS c FROM week),
  day AS (SELECT {HOUR_BIN} AS b, count(*) AS n FROM raw WHERE {last('24 HOUR')} GROUP BY 1)
SELECT b::VARCHAR AS bin, n AS total, a AS average,
  {rnd('n * 10000', 'round(a * 10000)::BIGINT')} AS ratio
FROM day, mean WHERE n > a * {factor}"""


@raw_query("msg_14_spikes", spike_sql("2"))
def _(t):
    return m.spikes(t.raw, as_of=t.message_as_of)


@raw_query("msg_14_spikes_sensitive", spike_sql("1.25"))
def _(t):
    return m.spikes(t.raw, 1.25, as_of=t.message_as_of)


BURST = f"""burst AS (SELECT * FROM raw UNION ALL SELECT raw.* FROM raw, range(5)
  WHERE {HOUR} = 5 AND {last('24 HOUR')})"""


def burst(t):
    """The messages with one hour of the last day sent six times."""
    hit = (F.hour("timestamp") == 5) & (C("timestamp") > F.lit(t.message_as_of).cast("timestamp")
                                        - F.expr("INTERVAL 24 HOURS"))
    return t.raw.withColumn("_n", F.explode(F.sequence(F.lit(1), F.when(hit, 6).otherwise(1)))).drop(
        "_n")


def over_burst(sql: str) -> str:
    return sql.replace("FROM raw", "FROM burst").replace("WITH ", f"WITH {BURST}, ", 1)


@raw_query("msg_14_spikes_in_a_burst", over_burst(spike_sql("2")))
def _(t):
    return m.spikes(burst(t), as_of=t.message_as_of)


def filled(seconds: int, hours: int) -> str:
    return f"""
  SELECT b AS ts, coalesce(n, 0) AS n FROM (SELECT unnest(generate_series(
      {MNOW} - INTERVAL {hours} HOUR, {MNOW} - INTERVAL 1 SECOND,
      INTERVAL {seconds} SECOND)) AS b)
  LEFT JOIN (SELECT time_bucket(INTERVAL {seconds} SECOND, {TS}) AS k, count(*) AS n FROM raw
    WHERE {TS} >= {MNOW} - INTERVAL {hours} HOUR AND {TS} < {MNOW} GROUP BY 1) ON b = k"""


@raw_query("msg_15_gaps", f"SELECT ts::VARCHAR AS ts FROM ({filled(300, 24)}) WHERE n = 0")
def _(t):
    return m.gaps(t.raw, as_of=t.message_as_of)


@raw_query("msg_16_late", f"""
SELECT {text(TS, 'timestamp')}, message_type, {LAT_M} AS latency_minutes, docnum
FROM raw WHERE {last('24 HOUR')} AND {LAT_M} > 5""")
def _(t):
    return m.late(t.raw, window="24 hours", as_of=t.message_as_of)


@raw_query("msg_16_late_orders", f"""
SELECT {text(TS, 'timestamp')}, docnum AS order_number, {LAT_M} AS latency_minutes,
  {HOUR}::INTEGER AS hour
FROM raw WHERE message_type LIKE 'ORDERS%' AND {BUSINESS} AND {LAT_M} > 4""")
def _(t):
    return m.late_orders(t.raw, 4)


@raw_query("msg_17_daily_report", f"""
SELECT total_messages, distinct_types, sap_systems, {text('f', 'first_message')},
  {text('l', 'last_message')}, date_diff('hour', f, l) AS duration_hours,
  {rnd('total_messages', "date_diff('hour', f, l)")} AS rate_per_hour
FROM (SELECT count(*) AS total_messages, count(DISTINCT message_type) AS distinct_types,
  count(DISTINCT sap_system) AS sap_systems, min({TS}) AS f, max({TS}) AS l
FROM raw WHERE {last('24 HOUR')})""")
def _(t):
    return m.daily_report(t.raw, as_of=t.message_as_of)


@raw_query("msg_17_executive", f"""
SELECT count(*) AS messages_last_hour, {rnd('count(*)', '60')} AS messages_per_minute,
  count(DISTINCT idoc_type) AS idoc_types, count(DISTINCT sap_system) AS source_systems
FROM raw WHERE {last('1 HOUR')}""")
def _(t):
    return m.executive_metrics(t.raw, as_of=t.message_as_of)


@raw_query("msg_17_average_per_hour", f"""
SELECT {avg('n')} AS average_messages_per_hour FROM (
  SELECT {HOUR_BIN}, count(*) AS n FROM raw WHERE {last('7 DAY')} GROUP BY 1)""")
def _(t):
    return m.average_per_hour(t.raw, as_of=t.message_as_of)


def outliers(limit: int) -> str:
    return f"""
WITH days AS (SELECT {TS}::DATE AS d, count(*) AS n FROM raw WHERE {last('7 DAY')} GROUP BY 1),
  whole AS (SELECT sum(n)::BIGINT AS s FROM days)
SELECT d::VARCHAR AS day, n AS daily_count, {rnd('s', '7', 4)} AS average,
  {pct('n * 7 - s', 's')} AS deviation_percent
FROM days, whole WHERE abs({pct('n * 7 - s', 's')}) > {limit}"""


@raw_query("msg_18_daily_outliers", outliers(50))
def _(t):
    return m.daily_outliers(t.raw, as_of=t.message_as_of)


DOUBLED = f"""burst AS (SELECT * FROM raw UNION ALL SELECT * FROM raw
  WHERE {TS}::DATE = ({MNOW} - INTERVAL 2 DAY)::DATE)"""


@raw_query("msg_18_outliers_in_a_burst", outliers(50).replace("FROM raw", "FROM burst").replace(
    "WITH ", f"WITH {DOUBLED}, ", 1))
def _(t):
    """One of the seven days twice."""
    day = F.to_date(F.lit(t.message_as_of).cast("timestamp") - F.expr("INTERVAL 2 DAYS"))
    twice = F.when(F.to_date("timestamp") == day, 2).otherwise(1)
    rows = t.raw.withColumn("_n", F.explode(F.sequence(F.lit(1), twice))).drop("_n")
    return m.daily_outliers(rows, as_of=t.message_as_of)


@raw_query("msg_18_daily_deviation", outliers(2))
def _(t):
    return m.daily_outliers(t.raw, 2, as_of=t.message_as_of)


@raw_query("msg_19_business_hours", f"""
SELECT {cnt(BUSINESS)} AS messages_business_hours, count(*) AS total_messages,
  {pct(cnt(BUSINESS), 'count(*)')} AS percent_business_hours FROM raw""")
def _(t):
    return m.business_hours_share(t.raw)


@raw_query("msg_20_busiest", f"""
SELECT message_type, sap_system, {HOUR}::INTEGER AS hour, count(*) AS total,
  {pct('count(*)', f"(SELECT count(*) FROM raw WHERE {last('7 DAY')})")} AS percent_of_total
FROM raw WHERE {last('7 DAY')} GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1, 2, 3 LIMIT 20""")
def _(t):
    return m.busiest_slices(t.raw, as_of=t.message_as_of)


@raw_query("msg_21_quality", f"""
SELECT *, missing_control + error_status + high_latency AS total_issues,
  {pct('total_messages - (missing_control + error_status + high_latency)', 'total_messages')}
  AS quality_score
FROM (SELECT count(*) AS total_messages, {cnt('docnum IS NULL')} AS missing_control,
  {cnt("status <> '03'")} AS error_status, {cnt(f'{LAT_M} > 5')} AS high_latency
FROM raw WHERE {last('24 HOUR')})""")
def _(t):
    return m.quality_line(t.raw, as_of=t.message_as_of)


@raw_query("msg_22_alerts", f"""
WITH week AS (SELECT {HOUR_BIN} AS b, count(*) AS n FROM raw WHERE {last('7 DAY')} GROUP BY 1),
  mean AS (SELECT {rnd('sum(n)', 'count(n)', 4)} AS a FROM week),
  hour AS (SELECT * FROM raw WHERE {last('1 HOUR')}),
  v AS (SELECT (SELECT count(*) FROM hour)::DOUBLE AS n,
    (SELECT date_diff('minute', max({TS}), {MNOW}) FROM raw WHERE {TS} <= {MNOW})::DOUBLE
      AS silent,
    (SELECT {pct(cnt("status <> '03'"), 'count(*)')} FROM hour) AS rate,
    (SELECT quantile_cont({LAT_S}, 0.95) FROM hour)::DOUBLE AS p95, round(a * 3, 4) AS spike
    FROM mean)
SELECT 'Volume' AS type, CASE WHEN n > spike THEN 'Volume Spike' ELSE 'Normal' END AS alert,
  n AS value, spike AS threshold FROM v
UNION ALL SELECT 'Silence', CASE WHEN silent <= 10 THEN 'Normal' ELSE 'Prolonged Silence' END,
  silent, 10 FROM v
UNION ALL SELECT 'Error Rate', CASE WHEN rate > 5 THEN 'High Error Rate' ELSE 'Normal' END,
  rate, 5 FROM v
UNION ALL SELECT 'P95 Latency', CASE WHEN p95 > 120 THEN 'High Latency' ELSE 'Normal' END,
  round(p95, 4), 120 FROM v""")
def _(t):
    return m.alerts(t.raw, as_of=t.message_as_of)


@raw_query("msg_22_alerts_after_outage", f"""
WITH one AS (SELECT date_diff('minute', max({TS}), {MNOW} + INTERVAL 3 DAY)::DOUBLE AS silent
             FROM raw WHERE {TS} <= {MNOW} + INTERVAL 3 DAY)
SELECT 'Silence' AS type, CASE WHEN silent <= 10 THEN 'Normal' ELSE 'Prolonged Silence' END
  AS alert, silent AS value, 10::DOUBLE AS threshold FROM one""")
def _(t):
    later = F.lit(t.message_as_of).cast("timestamp") + F.expr("INTERVAL 3 DAYS")
    return m.alerts(t.raw, as_of=later).filter(C("type") == "Silence")


def mean_hour(kind: str) -> str:
    s = f"epoch(date_trunc('second', {TS}))::HUGEINT"
    return (f"(sum({s}) FILTER (WHERE message_type = '{kind}') // "
            f"(3600 * {cnt(f'message_type = {chr(39)}{kind}{chr(39)}')}))")


@raw_query("msg_23_order_to_ship", f"""
SELECT sap_system, ({mean_hour('SHPMNT')} - {mean_hour('ORDERS')})::BIGINT
  AS avg_order_to_ship_hours FROM raw GROUP BY 1""")
def _(t):
    return m.order_to_ship(t.raw)


@raw_query("msg_24_top_senders", """
SELECT sender, count(*) AS order_count FROM raw WHERE message_type = 'ORDERS'
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(t):
    orders = t.raw.filter(C("message_type") == "ORDERS")
    return rows.top_by(m.count_by(orders, "sender", name="order_count"), 10,
                       F.desc("order_count"), "sender")


@raw_query("msg_24_top_invoices", f"""
SELECT {text(TS, 'timestamp')}, docnum, value::DOUBLE AS amount FROM raw
WHERE message_type = 'INVOIC' ORDER BY value DESC, docnum LIMIT 10""")
def _(t):
    bills = t.raw.filter(C("message_type") == "INVOIC").select(
        "timestamp", "docnum", C("value").alias("amount"))
    return rows.top_by(bills, 10, F.desc("amount"), "docnum")


@raw_query("msg_24_delivery_status", """
SELECT status, count(*) AS total FROM raw WHERE message_type = 'DESADV' GROUP BY 1""")
def _(t):
    return m.count_by(t.raw.filter(C("message_type") == "DESADV"), "status")


@raw_query("msg_25_cardinality", """
SELECT count(DISTINCT message_type) AS unique_message_type,
  count(DISTINCT sap_system) AS unique_sap_system, count(DISTINCT idoc_type) AS unique_idoc_type,
  count(DISTINCT docnum) AS unique_docnum FROM raw""")
def _(t):
    return m.cardinality(t.raw, "message_type", "sap_system", "idoc_type", "docnum")


@raw_query("msg_25_nulls", """
SELECT count(*) AS total_rows, count(*) - count(docnum) AS docnum_nulls,
  count(*) - count(status) AS status_nulls, count(*) - count(k) AS k_nulls,
  count(*) - count(data) AS data_nulls FROM raw""")
def _(t):
    return m.null_counts(t.raw, "docnum", "status", "k", "data")


@raw_query("msg_26_freshness", f"""
SELECT {text(f'max({TS})', 'last_message')},
  date_diff('minute', max({TS}), {MNOW}) AS minutes_since FROM raw""")
def _(t):
    return m.freshness(t.raw, as_of=t.message_as_of)


@raw_query("msg_27_bi_daily", f"""
SELECT {text(f'{TS}::DATE', 'day')}, message_type, sap_system, count(*) AS total,
  {avg(SIZE)} AS avg_size FROM raw WHERE {last('30 DAY')} GROUP BY 1, 2, 3""")
def _(t):
    return m.bi_daily(t.raw, as_of=t.message_as_of)


@raw_query("msg_29_recent", f"""
SELECT docnum, message_type, {text(TS, 'timestamp')} FROM raw WHERE {last('24 HOUR')}""")
def _(t):
    return m.recent(t.raw, as_of=t.message_as_of).select("docnum", "message_type", "timestamp")


@raw_query("msg_29_of_type", """
SELECT docnum, sap_system FROM raw WHERE idoc_type = 'INVOIC02'""")
def _(t):
    return m.of_type(t.raw, "INVOIC02").select("docnum", "sap_system")


@raw_query("msg_29_failed", "SELECT docnum, status FROM raw WHERE status IN ('51', 'FAILED')")
def _(t):
    return m.failed(t.raw, ("51", "FAILED")).select("docnum", "status")


# ---------------------------------------------------------------- time series

@raw_query("ts_1_gap_filled", f"SELECT ts::VARCHAR AS ts, n AS count FROM ({filled(3600, 168)})")
def _(t):
    return series.gap_fill(t.raw, "timestamp", 3600, "2024-01-24 00:00:00", t.message_as_of)


@raw_query("ts_2_gap_filled_by_system", f"""
WITH b AS (SELECT unnest(generate_series({MNOW} - INTERVAL 24 HOUR, {MNOW} - INTERVAL 1 SECOND,
    INTERVAL 900 SECOND)) AS ts), s AS (SELECT DISTINCT sap_system FROM raw)
SELECT s.sap_system, b.ts::VARCHAR AS ts, count(r.docnum) AS count
FROM b CROSS JOIN s LEFT JOIN raw r ON r.sap_system = s.sap_system
  AND time_bucket(INTERVAL 900 SECOND, r.{TS}) = b.ts
GROUP BY 1, 2""")
def _(t):
    return series.gap_fill(t.raw, "timestamp", 900, "2024-01-30 00:00:00", t.message_as_of,
                           ["sap_system"])


def moving(before: int, after: int, hours: int) -> str:
    w = f"OVER (ORDER BY ts ROWS BETWEEN {before} PRECEDING AND {after} FOLLOWING)"
    return (f"SELECT ts::VARCHAR AS ts, n AS count, {rnd('s', 'c')} AS moving_avg FROM "
            f"(SELECT ts, n, sum(n) {w} AS s, count(n) {w} AS c "
            f"FROM ({filled(3600, hours)}))")


@raw_query("ts_3_moving_average", moving(2, 0, 24))
def _(t):
    hourly = series.gap_fill(t.raw, "timestamp", 3600, "2024-01-30 00:00:00", t.message_as_of)
    return series.moving_average(hourly, "count", 3, 3600)


@raw_query("win_3_centred_average", moving(2, 2, 168))
def _(t):
    hourly = series.gap_fill(t.raw, "timestamp", 3600, "2024-01-24 00:00:00", t.message_as_of)
    return series.moving_average(hourly, "count", 5, 3600, centred=True)


@raw_query("ts_4_anomalies", f"""
WITH f AS ({filled(3600, 720)}),
  base AS (SELECT hour(ts) AS h, quantile_cont(n, 0.5)::DOUBLE AS baseline FROM f GROUP BY 1),
  r AS (SELECT ts, n, baseline, n - baseline AS residual FROM f JOIN base ON hour(ts) = h),
  q AS (SELECT quantile_cont(residual, 0.25) AS q1, quantile_cont(residual, 0.75) AS q3 FROM r)
SELECT ts::VARCHAR AS ts, n AS count, baseline, residual,
  (CASE WHEN residual > q3 + 1.5 * (q3 - q1) THEN 1
    WHEN residual < q1 - 1.5 * (q3 - q1) THEN -1 ELSE 0 END)::INTEGER AS anomaly,
  CASE WHEN q3 > q1 THEN round(residual / (q3 - q1), 4) END AS score FROM r, q""")
def _(t):
    hourly = series.gap_fill(t.raw, "timestamp", 3600, "2024-01-01 00:00:00", t.message_as_of)
    return series.anomalies(hourly, "count")


@raw_query("ts_4_anomalies_by_system", f"""
WITH b AS (SELECT sap_system, ts FROM (SELECT DISTINCT sap_system FROM raw),
    (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', {MNOW} - INTERVAL 1 HOUR,
                                   INTERVAL 1 HOUR)) AS ts)),
  f AS (SELECT b.sap_system, ts, coalesce(n, 0) AS n FROM b LEFT JOIN (
    SELECT sap_system AS s, {HOUR_BIN} AS h, count(*) AS n FROM raw
    WHERE {TS} >= TIMESTAMP '2024-01-01' AND {TS} < {MNOW} GROUP BY 1, 2)
    ON b.sap_system = s AND ts = h),
  base AS (SELECT sap_system AS s, hour(ts) AS h, quantile_cont(n, 0.5)::DOUBLE AS baseline
           FROM f GROUP BY 1, 2),
  r AS (SELECT sap_system, ts, n, baseline, n - baseline AS residual
        FROM f JOIN base ON sap_system = s AND hour(ts) = h),
  q AS (SELECT sap_system AS s, quantile_cont(residual, 0.25) AS q1,
          quantile_cont(residual, 0.75) AS q3 FROM r GROUP BY 1)
SELECT sap_system, ts::VARCHAR AS ts, n AS count, baseline, residual,
  (CASE WHEN residual > q3 + 1.5 * (q3 - q1) THEN 1
    WHEN residual < q1 - 1.5 * (q3 - q1) THEN -1 ELSE 0 END)::INTEGER AS anomaly,
  CASE WHEN q3 > q1 THEN round(residual / (q3 - q1), 4) END AS score
FROM r JOIN q ON sap_system = s""")
def _(t):
    hourly = series.gap_fill(t.raw, "timestamp", 3600, "2024-01-01 00:00:00", t.message_as_of,
                             ["sap_system"])
    return series.anomalies(hourly, "count", by=["sap_system"])


# ---------------------------------------------------------------- filters, projections, sets

@raw_query("flt_1_relative_time", f"""
SELECT docnum, message_type FROM raw
WHERE {TS} BETWEEN {MNOW} - INTERVAL 14 DAY AND {MNOW} - INTERVAL 7 DAY""")
def _(t):
    return rows.between_ages(t.raw, "timestamp", "14 days", "7 days",
                             as_of=t.message_as_of).select("docnum", "message_type")


@raw_query("flt_2_equality_prefix_membership", """
SELECT docnum, message_type, sap_system FROM raw WHERE sap_system = 'PRD'
  AND idoc_type LIKE 'ORDERS%' OR message_type IN ('SHPMNT', 'DESADV') AND sap_system <> 'DEV'""")
def _(t):
    orders = (C("sap_system") == "PRD") & C("idoc_type").startswith("ORDERS")
    moves = C("message_type").isin("SHPMNT", "DESADV") & (C("sap_system") != "DEV")
    return t.raw.filter(orders | moves).select("docnum", "message_type", "sap_system")


@raw_query("flt_3_nested_field", """
SELECT docnum, message_type FROM raw WHERE status = '51'""")
def _(t):
    return t.raw.filter(C("control.status") == "51").select("docnum", "message_type")


@raw_query("flt_4_business_hours", f"SELECT docnum, sap_system FROM raw WHERE {BUSINESS}")
def _(t):
    return t.raw.filter(rows.business_hours(C("timestamp"))).select("docnum", "sap_system")


@raw_query("prj_1_project_extend", f"""
SELECT docnum AS document, upper(sap_system) AS system, {LAT_S} AS latency_seconds, k * 2 AS k2
FROM raw""")
def _(t):
    return (t.raw.withColumns({"latency_seconds": m.latency(), "k2": C("k") * 2,
                               "system": F.upper("sap_system")})
            .withColumnRenamed("docnum", "document")
            .drop("data", "control", "idoc_type", "message_type", "sap_system", "status",
                  "timestamp", "ingestion_time", "k", "sender", "value"))


@raw_query("prj_2_category", """
SELECT docnum, CASE WHEN message_type = 'ORDERS' THEN 'Orders'
  WHEN message_type = 'INVOIC' THEN 'Invoices' WHEN message_type = 'WHSCON'
  THEN 'Warehouse Operations' WHEN message_type = 'DESADV' THEN 'Delivery Advices'
  ELSE 'Shipments' END AS category FROM raw""")
def _(t):
    return t.raw.select("docnum", m.category(C("message_type")).alias("category"))


@raw_query("src_3_stream_columns", f"""
SELECT docnum AS document_number, strftime({TS}, '%Y%m%d') AS created_date,
  status AS document_status, CASE idoc_type WHEN 'ORDERS05' THEN 'Purchase Order'
  WHEN 'WHSCON01' THEN 'Warehouse Confirmation' WHEN 'DESADV01' THEN 'Delivery Note'
  WHEN 'SHPMNT05' THEN 'Shipment' WHEN 'INVOIC02' THEN 'Invoice' ELSE 'Unknown' END AS doc_type
FROM raw""")
def _(t):
    return m.stream_columns(t.raw).select("document_number", "created_date", "document_status",
                                          "doc_type")


@raw_query("src_4_routable", """
SELECT docnum, status, sap_system FROM raw
WHERE status IN ('03', '30', '31') AND sap_system <> 'DEV'""")
def _(t):
    return m.routable(t.raw, test_system="DEV").select("docnum", "status", "sap_system")


@raw_query("snk_5_export", f"""
SELECT strftime({TS}, '%Y-%m-%d %H:%M:%S') AS date, message_type AS type, sap_system AS system,
  docnum AS document, status FROM raw WHERE {last('7 DAY')}
ORDER BY date DESC, document""")
def _(t):
    return m.export_rows(t.raw, as_of=t.message_as_of)


@raw_query("agg_1_count", "SELECT count(*) AS total FROM raw")
def _(t):
    return t.raw.agg(F.count("*").alias("total"))


@raw_query("agg_2_group_count", """
SELECT message_type, sap_system, count(*) AS total FROM raw GROUP BY 1, 2""")
def _(t):
    return m.count_by(t.raw, "message_type", "sap_system").orderBy(
        F.desc("total"), "message_type", "sap_system")


@raw_query("agg_5_distinct_counts", """
SELECT sap_system, count(DISTINCT sender) AS senders, count(DISTINCT k) AS keys
FROM raw GROUP BY 1""")
def _(t):
    return t.raw.groupBy("sap_system").agg(F.count_distinct("sender").alias("senders"),
                                           F.count_distinct("k").alias("keys"))


@raw_query("agg_6_percentiles", f"""
SELECT sap_system, count(*) AS messages, {avg(LAT_S)} AS avg_latency,
  max({LAT_S}) AS max_latency, {quantiles(LAT_S)} FROM raw GROUP BY 1""")
def _(t):
    return m.latency_percentiles(t.raw, ["sap_system"])


@raw_query("agg_8_two_level", f"""
SELECT sap_system, {avg('n')} AS avg_per_hour, max(n) AS max_per_hour FROM (
  SELECT sap_system, {HOUR_BIN}, count(*) AS n FROM raw GROUP BY 1, 2) GROUP BY 1""")
def _(t):
    hourly = m.count_by(t.raw, "sap_system", bin_floor(C("timestamp"), 3600).alias("bin"))
    return hourly.groupBy("sap_system").agg(
        m.ratio(F.sum("total"), F.count("total")).alias("avg_per_hour"),
        F.max("total").alias("max_per_hour"))


@raw_query("agg_9_share_of_total", f"""
SELECT message_type, sap_system, {HOUR}::INTEGER AS hour, count(*) AS row_count,
  {pct('count(*)', '(SELECT count(*) FROM raw)', 4)} AS percentage FROM raw GROUP BY 1, 2, 3""")
def _(t):
    counts = t.raw.withColumn("hour", F.hour("timestamp"))
    shares = reports.share_of_total(counts, "message_type", "sap_system", "hour")
    whole = t.raw.agg(F.count("*")).scalar()
    return shares.withColumn("percentage", m.pct(C("row_count"), whole, 4))


@raw_query("agg_12_distinct", "SELECT DISTINCT message_type, sap_system, status FROM raw")
def _(t):
    return t.raw.select("message_type", "sap_system", "status").distinct()


@raw_query("top_2_take", f"""
SELECT docnum, {text(TS, 'timestamp')} FROM raw ORDER BY raw.{TS}, docnum LIMIT 25""")
def _(t):
    return rows.top_by(t.raw.select("docnum", "timestamp"), 25, "timestamp", "docnum")


@raw_query("top_4_peak_hour", f"""
SELECT {HOUR}::INTEGER AS hour, count(*) AS total FROM raw WHERE {last('7 DAY')}
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def _(t):
    return m.peak_hour(t.raw, as_of=t.message_as_of)


@raw_query("top_5_by_deviation", f"""
SELECT d::VARCHAR AS day, n AS daily_count, {rnd('s', '7', 4)} AS average,
  {pct('n * 7 - s', 's')} AS deviation_percent
FROM (SELECT {TS}::DATE AS d, count(*) AS n FROM raw WHERE {last('7 DAY')} GROUP BY 1),
  (SELECT count(*) AS s FROM raw WHERE {last('7 DAY')})
WHERE abs({pct('n * 7 - s', 's')}) > 0
ORDER BY abs({pct('n * 7 - s', 's')}) DESC, 1""")
def _(t):
    return m.daily_outliers(t.raw, 0, as_of=t.message_as_of)


@raw_query("join_2_aggregate_join", f"""
SELECT sap_system, o.n AS orders, s.n AS shipments, o.f::VARCHAR AS first_order,
  s.f::VARCHAR AS first_shipment
FROM (SELECT sap_system, count(*) AS n, min({TS}) AS f FROM raw
      WHERE message_type = 'ORDERS' GROUP BY 1) o
JOIN (SELECT sap_system, count(*) AS n, min({TS}) AS f FROM raw
      WHERE message_type = 'SHPMNT' GROUP BY 1) s USING (sap_system)""")
def _(t):
    def side(kind, count, first):
        return t.raw.filter(C("message_type") == kind).groupBy("sap_system").agg(
            F.count("*").alias(count), F.min("timestamp").alias(first))

    return side("ORDERS", "orders", "first_order").join(
        side("SHPMNT", "shipments", "first_shipment"), "sap_system")


@raw_query("join_3_period_join", f"""
SELECT sender, c.n AS current, coalesce(p.n, 0) AS previous,
  {pct('c.n - coalesce(p.n, 0)', 'coalesce(p.n, 0)')} AS growth_percent
FROM (SELECT sender, count(*) AS n FROM raw WHERE {last('1 DAY')} GROUP BY 1) c
LEFT JOIN (SELECT sender, count(*) AS n FROM raw
  WHERE {TS} BETWEEN {MNOW} - INTERVAL 2 DAY AND {MNOW} - INTERVAL 1 DAY GROUP BY 1) p
USING (sender)""")
def _(t):
    now = m.count_by(rows.newer_than(t.raw, "timestamp", "1 day", as_of=t.message_as_of),
                     "sender", name="current")
    before = m.count_by(rows.between_ages(t.raw, "timestamp", "2 days", "1 day",
                                          as_of=t.message_as_of), "sender", name="previous")
    return now.join(before, "sender", "left").withColumn(
        "previous", F.coalesce("previous", F.lit(0))).withColumn(
        "growth_percent", m.pct_change(C("current"), C("previous")))


@raw_query("join_9_scalar", """
SELECT docnum, k, (SELECT max(k) FROM raw) - k AS below_max FROM raw""")
def _(t):
    return t.raw.select("docnum", "k", (t.raw.agg(F.max("k")).scalar() - C("k"))
                        .alias("below_max"))


@raw_query("set_1_union", """
SELECT 'late' AS kind, docnum FROM raw WHERE date_diff('second', "timestamp", ingestion_time) > 390
UNION ALL SELECT 'error', docnum FROM raw WHERE status <> '03'""")
def _(t):
    late = t.raw.filter(m.latency() > 390).select(F.lit("late").alias("kind"), "docnum")
    bad = t.raw.filter(m.failed_status()).select(F.lit("error").alias("kind"), "docnum")
    return rows.union_all([late, bad])


@raw_query("set_2_union_by_name", f"""
SELECT sap_system, count(*) AS messages, NULL::BIGINT AS errors, NULL::DOUBLE AS avg_latency
FROM raw GROUP BY 1
UNION ALL SELECT sap_system, NULL, count(*), NULL FROM raw WHERE status <> '03' GROUP BY 1
UNION ALL SELECT sap_system, NULL, NULL, {avg(LAT_S)} FROM raw GROUP BY 1""")
def _(t):
    by = t.raw.groupBy("sap_system")
    return rows.union_all([
        by.agg(F.count("*").alias("messages")),
        t.raw.filter(m.failed_status()).groupBy("sap_system").agg(F.count("*").alias("errors")),
        by.agg(m.average(m.latency()).alias("avg_latency")),
    ], fill_missing=True)
