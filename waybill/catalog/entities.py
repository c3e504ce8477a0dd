"""Registered small operators over entities, and governance checks that need no writing."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.catalog.base import query
from waybill.catalog.gold import DELAYS, ORDER_DAY, STATUS_COUNTS, cnt
from waybill.catalog.views_sql import MNOW, NOW, avg, money, pct, rnd, total
from waybill.functions import average, pct as percent, ratio
from waybill.operators import governance as gov
from waybill.operators import rows, storage
from waybill.operators.ordered import in_order
from waybill.plans import gold, reports
from waybill.plans.gold import n_if, sum_if

C = F.col


@query("src_5_read_table", sql="""
SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    from waybill.sources.messages import read_table
    nation = read_table(t.spark, f"{t.folder}/nation.parquet")
    region = read_table(t.spark, f"{t.folder}/region.parquet")
    return nation.join(region, C("n_regionkey") == C("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name")


@query("flt_5_in_transit", views="s_shipments", sql="""
SELECT shipment_number, shipment_status FROM s_shipments WHERE shipment_status = 'In Transit'
  OR (actual_ship_date IS NOT NULL AND actual_delivery_date IS NULL)""")
def _(t):
    return gold.in_transit(t.shipments).select("shipment_number", "shipment_status")


@query("flt_6_latest_day", views="s_orders", sql=f"""
SELECT order_number, {ORDER_DAY} AS order_day FROM s_orders
WHERE order_date::DATE = (SELECT max(order_date::DATE) FROM s_orders)""")
def _(t):
    days = t.orders.select("order_number", F.to_date("order_date").alias("order_day"))
    return rows.latest_slice(days, "order_day")


@query("agg_3_bundle", views="s_orders", sql=f"""
SELECT sap_system, currency, count(*) AS n, min(order_date)::VARCHAR AS first_order,
  max(order_date)::VARCHAR AS last_order, {total('total_c')} AS total_value,
  {avg('total_c', cents=2)} AS avg_value, {money('min(total_amount)')} AS min_value,
  {money('max(total_amount)')} AS max_value FROM s_orders GROUP BY 1, 2""")
def _(t):
    return t.orders.groupBy("sap_system", "currency").agg(
        F.count("*").alias("n"), F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"), F.sum("total_amount").alias("total_value"),
        average(C("total_amount")).alias("avg_value"), F.min("total_amount").alias("min_value"),
        F.max("total_amount").alias("max_value"))


@query("agg_4_conditional", views="s_orders", sql=f"""
SELECT sap_system, {STATUS_COUNTS},
  sum(total_c) FILTER (WHERE priority = 'High')::DOUBLE / 100 AS high_value,
  {avg("CASE WHEN order_status = 'Delivered' THEN order_age_hours END")} AS delivered_age
FROM s_orders GROUP BY 1""")
def _(t):
    return t.orders.groupBy("sap_system").agg(
        *[n_if(C("order_status") == s).alias(f"{s.lower()}_orders") for s in
          ("Pending", "Confirmed", "Shipped", "Delivered", "Cancelled")],
        sum_if(C("total_amount"), C("priority") == "High").alias("high_value"),
        average(F.when(C("order_status") == "Delivered", C("order_age_hours")))
        .alias("delivered_age"))


@query("agg_7_sets", views="s_orders", sql="""
SELECT sap_system, string_agg(DISTINCT currency, ',' ORDER BY currency) AS currencies,
  string_agg(DISTINCT order_status, ',' ORDER BY order_status) AS statuses
FROM s_orders GROUP BY 1""")
def _(t):
    def text(c):
        return F.array_join(F.sort_array(F.collect_set(c)), ",")

    return t.orders.groupBy("sap_system").agg(text("currency").alias("currencies"),
                                              text("order_status").alias("statuses"))


@query("agg_10_ratios", views="s_orders", sql=f"""
SELECT priority, {pct(cnt("order_status = 'Delivered'"), 'count(*)')} AS delivered_pct,
  {pct(cnt("sla_status = 'Met'"), cnt("sla_status IN ('Met', 'Missed')"))} AS met_pct,
  {pct(cnt("order_status = 'Confirmed'"), cnt("order_status = 'In Progress'"))} AS undefined_pct
FROM s_orders GROUP BY 1""")
def _(t):
    def n(cond):
        return F.count_if(cond)

    return t.orders.groupBy("priority").agg(
        percent(n(C("order_status") == "Delivered"), F.count("*")).alias("delivered_pct"),
        percent(n(C("sla_status") == "Met"), n(C("sla_status").isin("Met", "Missed")))
        .alias("met_pct"),
        percent(n(C("order_status") == "Confirmed"), n(C("order_status") == "In Progress"))
        .alias("undefined_pct"))


@query("agg_11_weighted_score", views="s_orders", sql=f"""
SELECT sap_system, {rnd("(round(met * 100)::BIGINT * 7 + round(done * 100)::BIGINT * 3)", '10', cents=2)}
  AS score FROM (SELECT sap_system,
  {pct(cnt("sla_status = 'Met'"), 'count(*)')} AS met,
  {pct(cnt("order_status = 'Delivered'"), 'count(*)')} AS done FROM s_orders GROUP BY 1)""")
def _(t):
    rates = t.orders.groupBy("sap_system").agg(
        percent(F.count_if(C("sla_status") == "Met"), F.count("*")).alias("met"),
        percent(F.count_if(C("order_status") == "Delivered"), F.count("*")).alias("done"))
    return rates.select("sap_system", ratio(C("met") * 7 + C("done") * 3, F.lit(10))
                        .alias("score"))


@query("win_1_latest_version", views="s_lines", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
  l_tax, l_returnflag, l_linestatus, l_shipdate::VARCHAR AS l_shipdate FROM s_lines""")
def _(t):
    return t.lines


@query("win_1_first_version", sql="""
SELECT l_orderkey, l_linenumber, min(l_shipdate)::VARCHAR AS l_shipdate
FROM lineitem GROUP BY 1, 2""")
def _(t):
    return rows.dedupe_first(
        t.table("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"),
        ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("win_2_share_of_total", views="s_shipments", sql=f"""
SELECT carrier_id, shipment_status, count(*) AS row_count,
  {pct('count(*)', '(SELECT count(*) FROM s_shipments)')} AS percentage
FROM s_shipments GROUP BY 1, 2""")
def _(t):
    return reports.share_of_total(t.shipments, "carrier_id", "shipment_status")


@query("win_4_event_sequence", sql="""
SELECT event_id, user_id, row_number() OVER w AS sequence,
  lag(event_type) OVER w AS previous_type,
  date_diff('second', lag(ts) OVER w, ts) AS dwell_seconds
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(t):
    from waybill.functions import diff_boundary
    ordered = in_order(t.table("events"), ["user_id"], ["ts", "event_id"], ["event_type"])
    return ordered.select("event_id", "user_id", "sequence",
                          C("previous.event_type").alias("previous_type"),
                          diff_boundary("second", C("ts"), C("previous.ts"))
                          .alias("dwell_seconds"))


@query("top_1_top_n", views="s_orders", sql="""
SELECT order_number, total_amount::DOUBLE AS total_amount FROM s_orders
ORDER BY s_orders.total_amount DESC, order_number LIMIT 20""")
def _(t):
    return rows.top_by(t.orders.select("order_number", "total_amount"), 20,
                       F.desc("total_amount"), "order_number")


@query("top_3_ranked_sort", views="s_shipments", sql=f"""
WITH d AS ({DELAYS})
SELECT priority, delay_status, shipment_number, shipment_value FROM d
ORDER BY priority_rank, shipment_value DESC, shipment_number""")
def _(t):
    delays = gold.transit_delays(t.shipments, as_of=t.as_of)
    return delays.orderBy("priority_rank", F.desc("shipment_value"), "shipment_number").select(
        "priority", "delay_status", "shipment_number", "shipment_value")


@query("set_3_union_count", views="s_orders s_shipments s_warehouse s_invoices", sql="""
SELECT (SELECT count(*) FROM s_orders) + (SELECT count(*) FROM s_shipments)
  + (SELECT count(*) FROM s_warehouse) + (SELECT count(*) FROM s_invoices) AS total_records""")
def _(t):
    parts = [df.agg(F.count("*").alias("n")) for df in (t.orders, t.shipments, t.warehouse,
                                                        t.invoices)]
    return rows.union_all(parts).agg(F.sum("n").alias("total_records"))


@query("snk_4_quarantine", sql=f"""
SELECT l_orderkey, l_linenumber, 'ships before its order' AS error_reason,
  {NOW}::VARCHAR AS quarantined_at FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_shipdate < o_orderdate""")
def _(t):
    joined = t.table("lineitem").join(t.table("orders"), C("l_orderkey") == C("o_orderkey"))
    _, bad = storage.split(joined, C("l_shipdate") < C("o_orderdate"), "ships before its order",
                           as_of=t.as_of)
    return bad.select("l_orderkey", "l_linenumber", "error_reason", "quarantined_at")


# ---------------------------------------------------------------- governance

@query("gov_1_expired", views="s_orders", sql=f"""
SELECT {ORDER_DAY} AS order_day, count(*) AS orders FROM s_orders
WHERE order_date::DATE < {NOW}::DATE - 365 GROUP BY 1""")
def _(t):
    daily = t.orders.groupBy(F.to_date("order_date").alias("order_day")).agg(
        F.count("*").alias("orders"))
    return daily.filter(gov.expired(daily, "order_day", gov.RETENTION_DAYS["silver"],
                                    as_of=t.as_of))


SUBJECTS = "customer_id IN (SELECT customer_id FROM s_orders WHERE total_amount > 490000)"


def subjects(t):
    return t.orders.filter(C("total_amount") > 490000).select("customer_id").distinct()


@query("gov_2_erasure", views="s_orders", sql=f"""
SELECT order_number, CASE WHEN {SUBJECTS} THEN 'ANONYMIZED' ELSE customer_name END
  AS customer_name, CASE WHEN {SUBJECTS} THEN sha256(customer_id) ELSE customer_id END
  AS customer_id FROM s_orders""")
def _(t):
    return gov.anonymised(t.orders, subjects(t), "customer_id", ["customer_name"]).select(
        "order_number", "customer_name", "customer_id")


@query("gov_2_erasure_log", views="s_orders", sql=f"""
SELECT sha256(customer_id) AS subject_hash, table_name, action, {NOW}::VARCHAR AS erased_at
FROM (SELECT DISTINCT customer_id FROM s_orders WHERE total_amount > 490000),
  (VALUES ('orders', 'anonymized'), ('shipments', 'anonymized'), ('invoices', 'kept'))
  AS v(table_name, action)""")
def _(t):
    return gov.erasure_log(subjects(t), "customer_id", ["orders", "shipments"], ["invoices"],
                           as_of=t.as_of)


@query("gov_3_subject_rows", views="s_orders s_shipments s_invoices", sql="""
SELECT 'orders' AS table_name, count(*) AS records FROM s_orders WHERE customer_id = '7'
UNION ALL SELECT 'shipments', count(*) FROM s_shipments WHERE customer_id = '7'
UNION ALL SELECT 'invoices', count(*) FROM s_invoices WHERE customer_id = '7'""")
def _(t):
    found = gov.subject_rows({"orders": t.orders, "shipments": t.shipments,
                              "invoices": t.invoices}, "7")
    return found.groupBy("table_name").agg(F.count("record").alias("records"))


@query("gov_4_immutable", views="s_invoices", sql=f"""
SELECT invoice_number, 'immutable record changed' AS reject_reason FROM s_invoices
WHERE invoice_date::DATE < {NOW}::DATE - 30 AND total_c > 40000000""")
def _(t):
    changed = t.invoices.withColumn("total_amount", F.when(
        C("total_amount") > 400000, C("total_amount") + 1).otherwise(C("total_amount"))
        .cast("decimal(18,2)"))
    _, bad = gov.split_immutable(changed, t.invoices, "invoice_number", "invoice_date",
                                 ["total_amount"], as_of=t.as_of)
    return bad.select("invoice_number", "reject_reason")


@query("gov_5_classify", sql=f"""
WITH v AS (SELECT 'text' AS column_name, text AS value FROM documents UNION ALL
    SELECT 'source', source FROM documents UNION ALL SELECT 'lang', lang FROM documents),
  p AS (SELECT * FROM (VALUES ('EMAIL', '{gov.PATTERNS["EMAIL"]}'),
    ('PHONE_NUMBER', '{gov.PATTERNS["PHONE_NUMBER"]}')) AS p(classification, pattern)),
  m AS (SELECT column_name, classification, count(value) AS n,
    {cnt('regexp_matches(value, pattern)')} AS matches FROM v, p GROUP BY 1, 2)
SELECT column_name, classification, matches, {pct('matches', 'n')} AS match_pct,
  coalesce({pct('matches', 'n')} >= 80, false) AS classified FROM m""")
def _(t):
    return gov.classify(t.table("documents"), ["text", "source", "lang"])


@query("gov_5_texts_with_email", sql=f"""
SELECT doc_id FROM documents WHERE regexp_matches(text, '{gov.CONTAINS_EMAIL}')""")
def _(t):
    return t.table("documents").filter(C("text").rlike(gov.CONTAINS_EMAIL)).select("doc_id")


@query("gov_7_lifecycle", sql="""
WITH s AS (SELECT user_id, event_id, ts, CASE event_type WHEN 'signup' THEN 'Pending'
    WHEN 'view' THEN 'Confirmed' WHEN 'click' THEN 'Shipped' WHEN 'purchase' THEN 'Delivered'
    ELSE 'Cancelled' END AS status FROM events),
  r AS (SELECT *, CASE status WHEN 'Pending' THEN 1 WHEN 'Confirmed' THEN 2 WHEN 'Shipped' THEN 4
    WHEN 'Delivered' THEN 5 END AS rank FROM s),
  l AS (SELECT *, lag(status) OVER w AS previous_status, lag(rank) OVER w AS before FROM r
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, previous_status, status,
  CASE WHEN status = 'Cancelled' AND previous_status IN ('Shipped', 'Delivered')
    THEN 'cancelled after shipping' WHEN previous_status = 'Cancelled' AND status <> 'Cancelled'
    THEN 'left Cancelled' WHEN rank < before THEN 'moved backwards' END AS violation
FROM l WHERE violation IS NOT NULL""")
def _(t):
    kind = C("event_type")
    status = (F.when(kind == "signup", "Pending").when(kind == "view", "Confirmed")
              .when(kind == "click", "Shipped").when(kind == "purchase", "Delivered")
              .otherwise("Cancelled"))
    history = t.table("events").withColumn("status", status)
    return gov.lifecycle_violations(history, "user_id", "status", "ts", "event_id").select(
        "event_id", "previous_status", "status", "violation")


def access_log(t):
    """The event table as an access log: partner, response time, response code."""
    kind, key = C("event_type"), C("event_id")
    code = F.when((kind == "error") & (key % 3 == 0), 500).when(kind == "error", 404).otherwise(200)
    return t.table("events").select(
        key.alias("request_id"), C("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("P"), (C("user_id") % 10).cast("string")).alias("partner"),
        C("user_id").cast("string").alias("user"), (key % 997).alias("response_ms"),
        code.alias("response_code"))


LOG = """log AS (SELECT event_id AS request_id, ts, 'P' || (user_id % 10) AS partner,
  event_id % 997 AS response_ms, CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 500
    WHEN event_type = 'error' THEN 404 ELSE 200 END AS response_code FROM events)"""
BIN = "time_bucket(INTERVAL 5 MINUTE, ts)::VARCHAR AS bin"


@query("gov_9_requests", sql=f"""
WITH {LOG} SELECT {BIN}, partner, count(*) AS request_count FROM log GROUP BY 1, 2""")
def _(t):
    return gov.requests_per_partner(access_log(t))


@query("gov_9_response_times", sql=f"""
WITH {LOG} SELECT {BIN}, count(*) AS requests,
  round(quantile_cont(response_ms, 0.5), 4)::DOUBLE AS p50,
  round(quantile_cont(response_ms, 0.95), 4)::DOUBLE AS p95,
  round(quantile_cont(response_ms, 0.99), 4)::DOUBLE AS p99 FROM log GROUP BY 1""")
def _(t):
    return gov.response_times(access_log(t))


@query("gov_9_errors", sql=f"""
WITH {LOG} SELECT {BIN}, response_code, count(*) AS error_count FROM log
WHERE response_code >= 400 GROUP BY 1, 2""")
def _(t):
    return gov.errors_by_code(access_log(t))


@query("gov_9_slowest", sql=f"""
WITH {LOG} SELECT request_id, partner, response_ms, response_code FROM log
ORDER BY response_ms DESC, request_id LIMIT 20""")
def _(t):
    return gov.slowest(access_log(t)).select("request_id", "partner", "response_ms",
                                             "response_code")


@query("gov_9_availability", sql=f"""
WITH {LOG} SELECT count(*) AS total_requests, {cnt('response_code < 400')} AS successful_requests,
  {pct(cnt('response_code < 400'), 'count(*)')} AS availability,
  {avg('response_ms')} AS avg_response_ms, 99.9::DOUBLE AS sla_target,
  CASE WHEN {cnt('response_code < 400')} * 100 >= count(*) * 99.9 THEN 'Yes' ELSE 'No' END
    AS sla_met FROM log WHERE ts > {MNOW} - INTERVAL 30 DAY""")
def _(t):
    return gov.availability(access_log(t), as_of=t.message_as_of)


@query("gov_10_no_partner", sql=f"""
SELECT event_id AS request_id, 'INVALID_ACCESS' AS audit_type, {MNOW}::VARCHAR AS audited_at
FROM events WHERE event_type = 'error'""")
def _(t):
    from waybill.operators.security import access_without_partner
    log = t.table("events").select(
        C("event_id").alias("request_id"),
        F.when(C("event_type") != "error", C("user_id").cast("string")).alias("partner"))
    return access_without_partner(log, "partner", as_of=t.message_as_of).drop("partner")




RUNS = """runs AS (SELECT sap_system AS rule_id, d::TIMESTAMP AS checked_at,
  CASE WHEN count(*) FILTER (WHERE event_type = 'error') * 100 > count(*) * 20 THEN 'Fail'
    ELSE 'Pass' END AS status
  FROM (SELECT CASE user_id % 3 WHEN 0 THEN 'PRD' WHEN 1 THEN 'QAS' ELSE 'DEV' END AS sap_system,
    event_type, ts::DATE AS d FROM events) GROUP BY 1, 2)"""


def _scored(cond: str) -> str:
    return pct(cnt(f"status = 'Pass' AND {cond}"), cnt(cond))


WEEK = f"checked_at > {MNOW} - INTERVAL 7 DAY"
WEEK_BEFORE = f"checked_at BETWEEN {MNOW} - INTERVAL 14 DAY AND {MNOW} - INTERVAL 7 DAY"


@query("gov_8_weekly_report", sql=f"""
WITH {RUNS}, s AS (SELECT {_scored(WEEK)} AS now, {_scored(WEEK_BEFORE)} AS before FROM runs),
  n AS (SELECT rule_id, max_by(status, checked_at) AS last,
    bool_or({WEEK_BEFORE} AND status = 'Fail') AS failed FROM runs
    WHERE checked_at > {MNOW} - INTERVAL 14 DAY GROUP BY 1),
  a AS (SELECT * FROM events WHERE ts > {MNOW} - INTERVAL 7 DAY)
SELECT CAST({MNOW} AS DATE)::VARCHAR AS report_date, now AS quality_score,
  (round(now * 100) - round(before * 100)) / 100 AS score_change,
  (SELECT {cnt("last = 'Fail'")} FROM n) AS open_issues,
  (SELECT {cnt("last = 'Pass' AND failed")} FROM n) AS resolved_issues,
  (SELECT count(*) FROM a) AS api_calls, (SELECT count(DISTINCT user_id) FROM a) AS unique_users,
  (SELECT {cnt("event_type = 'error'")} FROM a) AS access_violations FROM s""")
def _(t):
    bad = F.count_if(C("message_type") == "DESADV")
    results = t.raw.groupBy(C("sap_system").alias("rule_id"),
                            F.to_date("timestamp").cast("timestamp").alias("checked_at")).agg(
        F.when(bad * 100 > F.count("*") * 20, "Fail").otherwise("Pass").alias("status"))
    access = t.raw.select(C("timestamp").alias("ts"), C("sender").alias("user"),
                          F.when(C("message_type") != "DESADV", C("sap_system")).alias("partner"))
    return gov.weekly_report(results, access, as_of=t.message_as_of)


@query("gov_8_top_consumers", views="raw", sql=f"""
SELECT sender AS "user", count(*) AS calls FROM raw WHERE "timestamp" > {MNOW} - INTERVAL 7 DAY
GROUP BY 1 ORDER BY calls DESC, sender LIMIT 10""")
def _(t):
    access = t.raw.select(C("timestamp").alias("ts"), C("sender").alias("user"))
    return gov.top_consumers(access, as_of=t.message_as_of)


SECONDS = "(event_id % 7200) * 60"


@query("gov_8_compliance", views="s_invoices s_orders", sql=f"""
WITH r AS (SELECT ts AS asked, {SECONDS} AS s, event_id % 5 <> 0 AS met FROM events
    WHERE event_type = 'signup' AND ts > {MNOW} - INTERVAL 7 DAY AND ts <= {MNOW}),
  p AS (SELECT DISTINCT invoice_date::DATE AS day FROM s_invoices)
SELECT CAST({MNOW} AS DATE)::VARCHAR AS report_date, (SELECT count(*) FROM r) AS subject_requests,
  (SELECT {cnt('met')} FROM r) AS fulfilled,
  (SELECT {rnd('sum(CASE WHEN met THEN s END)', 'count(*) FILTER (WHERE met) * 3600')} FROM r)
    AS avg_hours,
  (SELECT {pct(cnt(f"day >= CAST({MNOW} AS DATE) - 10000"), 'count(*)')} FROM p)
    AS retention_compliance,
  (SELECT {pct(cnt('found'), 'count(*)')} FROM (SELECT column_name, bool_or(share >= 80) AS found
     FROM (SELECT column_name, pattern, {pct(cnt('regexp_matches(value, pattern)'), 'count(*)')}
             AS share
           FROM (SELECT 'order_number' AS column_name, order_number AS value FROM s_orders
                 UNION ALL SELECT 'customer_name', customer_name FROM s_orders
                 UNION ALL SELECT 'order_status', order_status FROM s_orders),
             (VALUES ('{gov.PATTERNS["EMAIL"]}'), ('{gov.PATTERNS["PHONE_NUMBER"]}')) AS p(pattern)
           GROUP BY ALL) GROUP BY 1)) AS classification_coverage""")
def _(t):
    """Sign-ups stand for requests, days of invoices for partitions kept ten thousand days."""
    events = t.table("events").filter("event_type = 'signup'")
    hours = F.timestamp_seconds(F.unix_seconds("ts") + (C("event_id") % 7200) * 60)
    asked = events.select(C("ts").cast("timestamp").alias("requested_at"),
                          F.when(C("event_id") % 5 != 0, hours).alias("fulfilled_at"))
    parts = t.invoices.select(F.to_date("invoice_date").alias("day")).distinct().withColumn(
        "keep_days", F.lit(10000))
    found = gov.classify(t.orders, ["order_number", "customer_name", "order_status"])
    columns = found.groupBy("column_name").agg(F.max(F.when(C("classified"), C("classification")))
                                               .alias("classification"))
    return gov.weekly_compliance(asked, parts, columns, as_of=t.message_as_of)
