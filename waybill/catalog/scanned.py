"""Registered queries over rows in order: shipment rules, event sequences, series."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.catalog.base import query
from waybill.operators import decompose, scans, storage
from waybill.plans import messages, shipment_rules, summaries

C = F.col


def tracking(t):
    """Up to eight events a shipment, some of them wrong: a step back, a delivery without date."""
    weight = C("total_weight_kg").cast("bigint")

    def plus(ts, hours):
        return C(ts) + F.expr(f"INTERVAL {hours} HOURS")

    made = [("P", C("planned_ship_date"), F.lit(True)), ("A", C("actual_ship_date"), F.lit(True)),
            ("B", plus("actual_ship_date", 6), F.lit(True)),
            ("E", C("planned_delivery_date"), weight % 3 == 0),
            ("C", C("actual_delivery_date"), F.lit(True)),
            ("B", plus("actual_delivery_date", 5), weight % 11 == 0),
            ("R", plus("actual_delivery_date", 30), weight % 13 == 0),
            ("C", plus("planned_delivery_date", 1),
             (weight % 7 == 0) & C("actual_delivery_date").isNull())]
    events = F.array(*(F.struct(
        F.lit(i).alias("event_number"), F.lit(code).alias("status_code"),
        F.when(cond, at).alias("event_time"),
        F.when(weight % 2 == 0, "DELAY").alias("reason_code"))
        for i, (code, at, cond) in enumerate(made)))
    return t.shipments.select(
        "shipment_number", F.when(weight % 19 != 0, C("tracking_number")).alias("tracking_number"),
        "actual_delivery_date", F.inline(events)).filter("event_time is not null")


EVENTS = """e AS (SELECT shipment_number, unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS n, total_weight_kg AS w,
    planned_ship_date AS p, actual_ship_date AS a, planned_delivery_date AS d,
    actual_delivery_date AS c, tracking_number AS k FROM s_shipments),
  tracked AS (SELECT shipment_number, n, w, c, CASE WHEN w % 19 <> 0 THEN k END AS tracking,
    'PABECBRC'[n + 1] AS code, CASE n WHEN 0 THEN p WHEN 1 THEN a WHEN 2 THEN a + INTERVAL 6 HOUR
      WHEN 3 THEN CASE WHEN w % 3 = 0 THEN d END WHEN 4 THEN c
      WHEN 5 THEN CASE WHEN w % 11 = 0 THEN c + INTERVAL 5 HOUR END
      WHEN 6 THEN CASE WHEN w % 13 = 0 THEN c + INTERVAL 30 HOUR END
      ELSE CASE WHEN w % 7 = 0 AND c IS NULL THEN d + INTERVAL 1 HOUR END END AS tm FROM e)"""


@query("gov_7_shipment_rules", views="s_shipments", sql=f"""
WITH {EVENTS},
  o AS (SELECT *, row_number() OVER (PARTITION BY shipment_number ORDER BY tm, n) AS i
        FROM tracked WHERE tm IS NOT NULL),
  r AS (SELECT o.*, code AS state, true AS ok FROM o WHERE i = 1
        UNION ALL
        SELECT o.*, CASE WHEN fits THEN o.code ELSE r.state END, fits
        FROM r JOIN o ON o.shipment_number = r.shipment_number AND o.i = r.i + 1,
          LATERAL (SELECT CASE r.state WHEN 'R' THEN o.code = 'R' WHEN 'C' THEN o.code IN ('C', 'R')
            WHEN 'E' THEN o.code <> 'P' ELSE o.code IN ('E', 'R')
              OR strpos('PABDC', o.code) >= strpos('PABDC', r.state) END AS fits))
SELECT shipment_number, count(*) AS events, count(*) FILTER (WHERE NOT ok) AS steps_back,
  count(*) FILTER (WHERE (code = 'C' AND c IS NULL) OR (code = 'E' AND w % 2 <> 0)
    OR (code IN ('B', 'D', 'C') AND tracking IS NULL)) AS without_evidence,
  arg_max(state, i) AS state FROM r GROUP BY 1""".replace("WITH e AS", "WITH RECURSIVE e AS"))
def _(t):
    return shipment_rules.broken_rules(tracking(t))


@query("gov_7_dates_and_carriers", views="s_shipments s_carriers", sql="""
SELECT shipment_number, coalesce(actual_delivery_date < actual_ship_date, false)
    AS dates_reversed, carrier_id NOT IN (SELECT carrier_id FROM s_carriers
    WHERE carrier_id <> 'CARRIER-7') AS carrier_unknown
FROM s_shipments WHERE actual_delivery_date < actual_ship_date OR carrier_id NOT IN (
  SELECT carrier_id FROM s_carriers WHERE carrier_id <> 'CARRIER-7')""")
def _(t):
    """One carrier is missing from the master data on purpose."""
    return shipment_rules.date_order(t.shipments, t.carriers.filter("carrier_id <> 'CARRIER-7'"))


@query("win_4_system_sequence", views="raw", sql="""
SELECT sap_system, docnum, row_number() OVER w AS sequence, lag(docnum) OVER w AS previous_docnum,
  date_diff('second', lag("timestamp") OVER w, "timestamp") AS seconds_since
FROM raw WINDOW w AS (PARTITION BY sap_system ORDER BY "timestamp", docnum)""")
def _(t):
    """Few keys, each with a large share of all messages."""
    rows = t.raw.select("sap_system", C("control.docnum").alias("docnum"), "timestamp")
    out = scans.placed(rows, ["sap_system"], ["timestamp", "docnum"], ["docnum", "timestamp"])
    return out.select("sap_system", "docnum", "sequence",
                      C("previous.docnum").alias("previous_docnum"),
                      (F.unix_seconds("timestamp") - F.unix_seconds("previous.timestamp"))
                      .alias("seconds_since"))


LAGS = range(2, 169)


@query("ts_4_decomposed", views="raw", sql="""
WITH span AS (SELECT min(date_trunc('hour', "timestamp")) AS a,
    max(date_trunc('hour', "timestamp")) AS b FROM raw),
  grid AS (SELECT sap_system, unnest(range(0, date_diff('hour', a, b) + 1)) AS i, a
           FROM (SELECT DISTINCT sap_system FROM raw), span),
  x AS (SELECT g.sap_system AS k, i, a, count(r.docnum) AS v FROM grid g LEFT JOIN raw r
        ON r.sap_system = g.sap_system AND date_trunc('hour', r."timestamp") = a + to_hours(i::INT)
        GROUP BY ALL),
  d AS (SELECT k, i, v - lag(v) OVER (PARTITION BY k ORDER BY i) AS d FROM x),
  r AS (SELECT p.k, lag, corr(p.d, q.d) AS r
        FROM d p, (SELECT unnest(range(2, 169)) AS lag) l, d q
        WHERE q.k = p.k AND q.i = p.i - lag GROUP BY ALL),
  f AS (SELECT k, min(lag) FILTER (WHERE r >= 0.9 * m AND m >= 0.3) AS period
        FROM (SELECT *, max(r) OVER (PARTITION BY k) AS m FROM r WHERE NOT isnan(r)) GROUP BY 1),
  t AS (SELECT x.*, period, (SELECT median(y.v::DOUBLE) FROM x y WHERE y.k = x.k
          AND abs(y.i - x.i) <= coalesce(period, 168) // 2) AS trend
        FROM x LEFT JOIN f ON f.k = x.k),
  s AS (SELECT k, coalesce(i % period, 0) AS phase, median(v - trend) AS s FROM t GROUP BY ALL),
  w AS (SELECT t.*, CASE WHEN period IS NULL THEN 0 ELSE s END AS season,
          v - trend - CASE WHEN period IS NULL THEN 0 ELSE s END AS residual
        FROM t JOIN s ON s.k = t.k AND s.phase = coalesce(t.i % period, 0)),
  q AS (SELECT k, quantile_cont(residual, 0.25) AS lo, quantile_cont(residual, 0.75) AS hi
        FROM w GROUP BY 1)
SELECT w.k AS sap_system, (a + to_hours(i::INT))::VARCHAR AS hour, v AS total, period, trend,
  season, residual, residual < lo - 3 * (hi - lo) OR residual > hi + 3 * (hi - lo) AS is_anomaly
FROM w JOIN q ON q.k = w.k""")
def _(t):
    """Messages an hour and system, with hours that have none."""
    hour = F.date_trunc("hour", "timestamp")
    counts = t.raw.groupBy("sap_system", hour.alias("hour")).agg(F.count("*").alias("total"))
    span = t.raw.agg(F.min(hour).alias("first"), F.max(hour).alias("last"))
    grid = t.raw.select("sap_system").distinct().select("sap_system", F.explode(F.sequence(
        span.select("first").scalar(), span.select("last").scalar(),
        F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    series = grid.join(counts, ["sap_system", "hour"], "left").select(
        "sap_system", "hour", F.coalesce("total", F.lit(0)).alias("total"),
        ((F.unix_seconds("hour") - F.unix_seconds(span.select("first").scalar())) / 3600)
        .cast("int").alias("i"))
    return decompose.decompose(series, ["sap_system"], "i", "total", LAGS).drop("i")


PEOPLE = ("operator_id", "equipment_id", "zone")


@query("gld_12_people_by_week", views="s_warehouse", sql="""
SELECT date_trunc('week', movement_timestamp)::DATE::VARCHAR AS week, warehouse_id,
  count(*) AS rows, count(DISTINCT operator_id) AS unique_operator_id,
  count(DISTINCT equipment_id) AS unique_equipment_id, count(DISTINCT zone) AS unique_zone
FROM s_warehouse GROUP BY ALL""")
def _(t):
    """Weeks from the stored sketches of days; so few values are counted exactly."""
    days = storage.kept(summaries.distinct_by_day(t.warehouse, "movement_timestamp",
                                                  ["warehouse_id"], PEOPLE), "sketches")
    week = F.to_date(F.date_trunc("week", "day")).alias("week")
    return summaries.distinct_over(days, week, ["warehouse_id"], PEOPLE)


@query("msg_10_from_summaries", views="raw", sql="""
SELECT message_type, count(*) AS messages, round(quantile_cont(s, 0.5), 4) AS p50,
  round(quantile_cont(s, 0.95), 4) AS p95, round(quantile_cont(s, 0.99), 4) AS p99
FROM (SELECT message_type, date_diff('second', "timestamp", ingestion_time) AS s FROM raw)
GROUP BY 1""")
def _(t):
    """The month's percentiles from stored counts of five minutes each."""
    bins = storage.kept(summaries.counted(t.raw, "timestamp", ["message_type"], messages.latency()),
                        "latencies")
    return summaries.percentiles(bins, ["message_type"])
