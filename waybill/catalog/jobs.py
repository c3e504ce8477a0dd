"""Registered jobs that write: sinks, table maintenance, streams.

Each job works in a new folder under the cluster's checkpoint folder and returns what it left in
its table, so the result shows that the write did what it should.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from waybill.catalog.base import query, stored
from waybill.catalog.gold import DAY, ORDER_DAY, cnt
from waybill.catalog.views_sql import MNOW, NOW, avg, money, pct, total
from waybill.operators import extract, governance as gov, quality, refresh, storage
from waybill.operators.rows import union_all
from waybill.operators.subject_index import SubjectIndex
from waybill.plans import gold
from waybill.session import checkpoint_dir
from waybill.sources import ledger
from waybill.sources import messages as source
from waybill.sources.driver_messages import Messages
from waybill.streaming import alerts, jobs

C = F.col
CUT = "2000-01-01"


def folder(t, name: str) -> str:
    return f"{checkpoint_dir(t.spark)}/waybill/{name}-{uuid.uuid4().hex}"


def before(t, df, column: str = "order_date"):
    return df.filter(C(column) < F.lit(CUT).cast("timestamp"))


def small_orders(t):
    return t.orders.select("order_number", "customer_id", "sap_system", "order_status",
                           "total_amount", "order_date",
                           F.to_date("order_date").alias("order_day"))


SMALL = f"""SELECT order_number, customer_id, sap_system, order_status,
  {money('total_amount')} AS total_amount, order_date::VARCHAR AS order_date,
  {ORDER_DAY} AS order_day FROM s_orders"""


@query("snk_1_create_or_replace", views="s_orders", sql=SMALL)
def _(t):
    path = folder(t, "orders")
    by_month = small_orders(t).withColumn("order_month", F.date_format("order_date", "yyyy-MM"))
    storage.create_or_replace(before(t, by_month), path, "order_month")
    storage.create_or_replace(by_month, path, "order_month")
    return t.spark.read.parquet(path).drop("order_month")


@query("snk_2_snapshot", views="s_shipments", sql=f"""
SELECT carrier_id, destination_country, count(*) AS active_shipments,
  {cnt(f'planned_delivery_date::DATE = {NOW}::DATE')} AS arriving_today,
  {cnt(f'planned_delivery_date::DATE < {NOW}::DATE')} AS delayed_shipments,
  {avg("date_diff('day', actual_ship_date, planned_delivery_date)")} AS avg_planned_transit_days
FROM s_shipments WHERE actual_ship_date IS NOT NULL AND actual_delivery_date IS NULL
GROUP BY ALL""")
def _(t):
    path = folder(t, "transit")
    storage.snapshot(gold.transit_by_carrier(t.shipments, as_of="1999-01-01 00:00:00"), path)
    storage.snapshot(gold.transit_by_carrier(t.shipments, as_of=t.as_of), path)
    return t.spark.read.parquet(path)


def _versions(t):
    """Orders by month, as first stored and as later updated: half the values change."""
    month = F.date_format("order_date", "yyyy-MM")
    stored = before(t, small_orders(t)).withColumns({
        "order_status": F.lit("Pending"), "order_month": month})
    updates = small_orders(t).filter(C("order_status") != "Cancelled").withColumn(
        "order_month", month)
    return stored, updates


@query("mnt_1_upsert", views="s_orders", sql=f"""
SELECT order_number, customer_id, sap_system,
  CASE WHEN order_status = 'Cancelled' THEN 'Pending' ELSE order_status END AS order_status,
  {money('total_amount')} AS total_amount, order_date::VARCHAR AS order_date,
  {ORDER_DAY} AS order_day FROM s_orders
WHERE order_status <> 'Cancelled' OR order_date < TIMESTAMP '{CUT}'""")
def _(t):
    stored, updates = _versions(t)
    path = folder(t, "upsert")
    storage.upsert(stored, path, ["order_number"], "order_month")
    storage.upsert(updates, path, ["order_number"], "order_month")
    return t.spark.read.parquet(path).drop("order_month")


@query("mnt_1_moved_keys", views="s_orders", sql=f"""
SELECT order_number, order_status, CASE WHEN order_status = 'Cancelled'
  THEN strftime(order_date, '%Y-%m') ELSE strftime(order_date + INTERVAL 45 DAY, '%Y-%m') END
  AS order_month FROM s_orders""")
def _(t):
    """Two batches move two thirds of the orders to later months, one late batch comes twice."""
    month = F.date_format("order_date", "yyyy-MM")
    later = F.date_format(C("order_date") + F.expr("INTERVAL 45 DAYS"), "yyyy-MM")
    orders = t.orders.select("order_number", "order_status", "order_date")
    path = folder(t, "moved")
    storage.upsert(orders.select("order_number", "order_status", month.alias("order_month")), path,
                   ["order_number"], "order_month")
    for status in ("Shipped", "Delivered", "Pending", "Shipped"):
        some = orders.filter(C("order_status") == status)
        storage.upsert(some.select("order_number", "order_status", later.alias("order_month")),
                       path, ["order_number"], "order_month")
    rest = orders.filter(~C("order_status").isin("Shipped", "Delivered", "Pending", "Cancelled"))
    storage.upsert(rest.select("order_number", "order_status", later.alias("order_month")), path,
                   ["order_number"], "order_month")
    return t.spark.read.parquet(path).withColumn("order_month", C("order_month").cast("string"))


@query("snk_3_gold_merge", views="s_orders", sql=f"""
SELECT strftime(order_date, '%Y-%m') AS order_month, sap_system, count(*) AS total_orders,
  {total('total_c')} AS total_revenue FROM s_orders GROUP BY 1, 2""")
def _(t):
    def monthly(df):
        return df.groupBy(F.date_format("order_date", "yyyy-MM").alias("order_month"),
                          "sap_system").agg(F.count("*").alias("total_orders"),
                                            F.sum("total_amount").alias("total_revenue"))

    path = folder(t, "merge")
    storage.upsert(monthly(before(t, t.orders)), path, ["order_month", "sap_system"],
                   "order_month")
    storage.upsert(monthly(t.order_facts), path, ["order_month", "sap_system"], "order_month")
    return t.spark.read.parquet(path).withColumn("order_month", C("order_month").cast("string"))


@query("mnt_2_compact", views="s_orders", sql=SMALL)
def _(t):
    path = folder(t, "compact")
    storage.append(small_orders(t).filter("customer_id < '5'"), path)
    storage.append(small_orders(t).filter("customer_id >= '5'"), path)
    storage.compact(t.spark, path, ["customer_id", "order_date"])
    return t.spark.read.parquet(path)


@query("mnt_2_interleaved", views="s_orders", sql=SMALL)
def _(t):
    path = folder(t, "interleaved")
    storage.append(small_orders(t), path)
    storage.compact(t.spark, path, ["customer_id", "order_date", "total_amount"], interleave=True)
    return t.spark.read.parquet(path)


# what the refreshed daily tables read
REFRESHED_COLUMNS = {
    "order_facts": ("order_number", "customer_id", "sap_system", "order_date",
                    "requested_delivery_date", "promised_delivery_date", "actual_ship_date",
                    "actual_delivery_date", "order_status", "total_amount"),
    "shipments": ("shipment_number", "order_number", "customer_id", "sap_system",
                  "origin_country", "destination_country", "carrier_name", "planned_ship_date",
                  "actual_ship_date", "planned_delivery_date", "actual_delivery_date",
                  "shipment_status", "shipment_value"),
    "warehouse": ("movement_timestamp", "warehouse_id", "movement_type", "sap_system", "quantity",
                  "material_id", "operator_id", "location_code", "processing_time_minutes",
                  "exception_flag", "exception_type"),
    "invoices": ("invoice_date", "customer_id", "sap_system", "invoice_number", "total_amount",
                 "amount_paid", "amount_due", "payment_status", "aging_bucket", "payment_date")}


@query("mnt_3_refresh_all", views="g_orders s_shipments s_warehouse s_invoices", sql="""
SELECT 'orders' AS table_name, count(*) AS row_count FROM (SELECT DISTINCT order_date::DATE,
  sap_system, sla_status FROM g_orders)
UNION ALL SELECT 'sla', count(*) FROM g_orders
UNION ALL SELECT 'transit', count(*) FROM s_shipments
  WHERE actual_ship_date IS NOT NULL AND actual_delivery_date IS NULL
UNION ALL SELECT 'warehouse', count(*) FROM (SELECT DISTINCT movement_timestamp::DATE,
  warehouse_id, movement_type, sap_system FROM s_warehouse)
UNION ALL SELECT 'revenue', count(*) FROM (SELECT DISTINCT invoice_date::DATE, customer_id,
  sap_system FROM s_invoices)""")
def _(t):
    root = folder(t, "gold")
    t = stored(t, REFRESHED_COLUMNS)  # silver is derived once, whatever reads it
    frames = {
        "orders": lambda: gold.orders_by_sla(t.gold_order_facts),
        "sla": lambda: gold.sla_per_order(t.gold_order_facts, t.shipments, as_of=t.as_of),
        "transit": lambda: gold.transit_delays(t.shipments, as_of=t.as_of),
        "warehouse": lambda: gold.warehouse_productivity(t.warehouse),
        "revenue": lambda: gold.revenue_recognition(t.invoices)}
    report = storage.run_steps({name: (lambda n=name, make=make: storage.create_or_replace(
        make(), f"{root}/{n}")) for name, make in frames.items()})
    failed = [r for r in report if r["status"] != "Succeeded"]
    if failed:
        raise RuntimeError(f"refresh failed: {failed}")
    return union_all([t.spark.read.parquet(f"{root}/{n}").agg(
        F.lit(n).alias("table_name"), F.count("*").alias("row_count")) for n in frames])


def _quarter(day):
    return day.replace(month=(day.month - 1) // 3 * 3 + 1)


def _months_of(quarter):
    return [quarter.replace(month=quarter.month + k) for k in range(3)]


def sales_graph(day: str = "month"):
    """Months of orders and of invoices, both by month and system, and quarters of these."""
    def sums(count, amount):
        return lambda df: df.groupBy("month", "sap_system").agg(
            F.count("*").alias(count), F.sum("total_amount").alias(amount))

    def sales(orders, bills):
        return orders.join(bills, ["month", "sap_system"], "full").select(
            "month", "sap_system", *(F.coalesce(c, F.lit(0)).alias(c) for c in
                                     ("orders", "ordered", "invoices", "invoiced")))

    def quarters(sales):
        return sales.groupBy(F.trunc("month", "quarter").alias("quarter"), "sap_system").agg(
            *(F.sum(c).alias(c) for c in ("orders", "ordered", "invoices", "invoiced")))

    return [refresh.Daily("order_months", ("orders",), sums("orders", "ordered"), day),
            refresh.Daily("invoice_months", ("invoices",), sums("invoices", "invoiced"), day),
            refresh.Daily("sales", ("order_months", "invoice_months"), sales, day),
            refresh.Daily("quarters", ("sales",), quarters, "quarter",
                          affects=lambda d: [_quarter(d)], needs=_months_of)]


SALES = f"""SELECT month, sap_system, sum(orders)::BIGINT AS orders, sum(ordered) AS ordered,
  sum(invoices)::BIGINT AS invoices, sum(invoiced) AS invoiced FROM (
  SELECT date_trunc('month', order_date) AS month, sap_system, count(*) AS orders,
    sum(total_c) AS ordered, 0 AS invoices, 0 AS invoiced FROM s_orders GROUP BY ALL
  UNION ALL SELECT date_trunc('month', invoice_date), sap_system, 0, 0, count(*), sum(total_c)
  FROM s_invoices GROUP BY ALL) GROUP BY ALL"""
SALES_CELLS = """orders, ordered::DOUBLE / 100 AS ordered, invoices,
  invoiced::DOUBLE / 100 AS invoiced"""


@query("mnt_3_change_sets", views="s_orders s_invoices", sql=f"""
WITH m AS ({SALES}), q AS (SELECT date_trunc('quarter', month) AS month, sap_system,
  sum(orders)::BIGINT AS orders, sum(ordered) AS ordered, sum(invoices)::BIGINT AS invoices,
  sum(invoiced) AS invoiced FROM m GROUP BY ALL)
SELECT 'sales' AS table_name, month::DATE::VARCHAR AS day, sap_system, {SALES_CELLS} FROM m
UNION ALL SELECT 'quarters', month::DATE::VARCHAR, sap_system, {SALES_CELLS} FROM q""")
def _(t):
    """Three versions of silver: old orders, all orders and old invoices, late invoices."""
    root = folder(t, "sales")
    log = refresh.Changes(t.spark, root)

    def rows(df, key, ts):
        return df.select(key, "sap_system", "total_amount", ts,
                         F.trunc(ts, "month").alias("month"))

    orders = rows(t.order_facts, "order_number", "order_date")
    bills = rows(t.invoices, "invoice_number", "invoice_date")
    late = C("invoice_date") >= F.lit("2001-01-01").cast("timestamp")
    versions = [{"orders": before(t, orders), "invoices": bills.limit(0)},
                {"orders": orders.filter(~(C("order_date") < F.lit(CUT).cast("timestamp"))),
                 "invoices": bills.filter(~late)},
                {"invoices": bills.filter(late)}]
    for version, changed in enumerate(versions, 1):
        for name, df in changed.items():
            path = f"{root}/{name}"
            log.declare(name, df.schema)
            key = "order_number" if name == "orders" else "invoice_number"
            log.record(name, storage.upsert(df, path, [key], "month", moves=False), version)
        failed = {k: v for k, v in refresh.refresh(
            t.spark, root, sales_graph(), {"orders": "month", "invoices": "month"},
            version).items() if isinstance(v, str)}
        if failed:
            raise RuntimeError(f"refresh failed: {failed}")
    return union_all([storage.table(t.spark, f"{root}/{name}", day).select(
        F.lit(name).alias("table_name"), C(day).alias("day"), "sap_system", "orders",
        C("ordered").cast("double"), "invoices", C("invoiced").cast("double"))
        for name, day in (("sales", "month"), ("quarters", "quarter"))])


def _daily(df):
    return df.groupBy(F.to_date("order_date").alias("order_day"), "sap_system").agg(
        F.count("*").alias("total_orders"), F.sum("total_amount").alias("total_revenue"))


@query("mnt_4_backfill", views="s_orders", sql=f"""
SELECT {ORDER_DAY} AS order_day, sap_system, count(*) AS total_orders,
  {total('total_c')} AS total_revenue FROM s_orders
WHERE order_date::DATE >= {NOW}::DATE - 60 GROUP BY ALL""")
def _(t):
    path = folder(t, "backfill")
    storage.backfill(_daily, t.orders, path, "order_date", "order_day", 60, as_of=t.as_of)
    storage.backfill(_daily, t.orders, path, "order_date", "order_day", 10, as_of=t.as_of)
    return t.spark.read.parquet(path)


@query("src_6_incremental", views="raw", sql=f"""
SELECT docnum, message_type, "timestamp"::VARCHAR AS timestamp FROM raw
WHERE "timestamp" > (SELECT max("timestamp") FROM raw WHERE "timestamp" <= {MNOW} - INTERVAL 7 DAY)
""")
def _(t):
    path = folder(t, "incremental")
    rows = t.raw.select("docnum", "message_type", "timestamp")
    week_ago = F.lit(t.message_as_of).cast("timestamp") - F.expr("INTERVAL 7 DAYS")
    storage.append(rows.filter(C("timestamp") <= week_ago), path)
    return source.newer_rows(rows, t.spark.read.parquet(path))


@query("snk_6_history", views="raw", sql=f"""
SELECT 'BRZ-002' AS rule_id, 'Pass' AS status, d AS checked_at FROM
  (VALUES ('2024-01-30 00:00:00'), ('2024-01-31 00:00:00')) v(d)
UNION ALL SELECT 'BRZ-004', CASE WHEN {cnt("date_diff('second', \"timestamp\", ingestion_time) > 30")}
  * 100 > count(*) * 5 THEN 'Fail' ELSE 'Pass' END, any_value(d)
FROM raw, (VALUES ('2024-01-30 00:00:00'), ('2024-01-31 00:00:00')) v(d) GROUP BY d""")
def _(t):
    path = folder(t, "history")
    rules = [r for r in quality.MESSAGE_RULES if r.id in ("BRZ-002", "BRZ-004")]
    for day in ("2024-01-30 00:00:00", "2024-01-31 00:00:00"):
        results = quality.run_rules({"raw": t.raw}, rules, as_of=day)
        storage.append_results(results, path, as_of=day)
    return t.spark.read.parquet(path).select("rule_id", "status", "checked_at")


@query("gov_1_purge", views="s_orders", sql=f"""
SELECT strftime(order_date, '%Y') AS order_year, count(*) AS orders FROM s_orders
WHERE date_trunc('month', order_date)::DATE >= {NOW}::DATE - 365 GROUP BY 1""")
def _(t):
    path = folder(t, "purge")
    monthly = small_orders(t).withColumn("month_day", F.trunc("order_date", "month"))
    storage.create_or_replace(monthly, path, "month_day")
    gov.purge(t.spark, path, "month_day", 365, as_of=t.as_of)
    return t.spark.read.parquet(path).groupBy(
        F.date_format("order_date", "yyyy").alias("order_year")).agg(F.count("*").alias("orders"))


@query("gov_1_purge_timestamps", views="s_orders", sql=f"""
SELECT strftime(order_date, '%Y') AS order_year, count(*) AS orders FROM s_orders
WHERE date_trunc('month', order_date)::DATE >= {NOW}::DATE - 365 GROUP BY 1""")
def _(t):
    path = folder(t, "purge-times")
    monthly = small_orders(t).withColumn("month_time", F.date_trunc("month", "order_date"))
    storage.create_or_replace(monthly, path, "month_time")
    gov.purge(t.spark, path, "month_time", 365, as_of=t.as_of)
    return t.spark.read.parquet(path).groupBy(
        F.date_format("order_date", "yyyy").alias("order_year")).agg(F.count("*").alias("orders"))


@query("mnt_5_upsert_text_partition", views="s_orders", sql="""
SELECT order_number, sap_system || ':' || order_status AS state FROM s_orders""")
def _(t):
    """Every order moves out of a partition whose name has a colon, which must vanish."""
    path = folder(t, "states")
    now = t.order_facts.select("order_number", F.concat_ws(":", "sap_system", "order_status")
                               .alias("state"))
    first = t.order_facts.select("order_number", F.concat("sap_system", F.lit(":New"))
                                 .alias("state"))
    storage.upsert(first, path, ["order_number"], "state")
    storage.upsert(now, path, ["order_number"], "state")
    return t.spark.read.parquet(path).select("order_number", "state")


OFFSETS = """SELECT event_id % 4 AS partition, event_id // 4 AS o FROM events
  WHERE event_id % 997 > 2 GROUP BY ALL"""


@query("src_2_ledger", sql=f"""
WITH m AS ({OFFSETS}), r AS (SELECT *, o - row_number() OVER (PARTITION BY partition ORDER BY o) AS run
    FROM m), i AS (SELECT partition, min(o) AS first, max(o) AS last FROM r GROUP BY partition, run)
SELECT partition::INTEGER AS partition, first, last, last - first + 1 AS messages,
  coalesce(first - lag(last) OVER (PARTITION BY partition ORDER BY first) - 1, 0) AS gap_before
FROM i""")
def _(t):
    """Three loads: the first half, all but some (again the half), and the same once more."""
    path = folder(t, "ledger")
    events = t.table("events")
    sent = events.filter("event_id % 997 > 2").select(
        (C("event_id") % 4).cast("int").alias("partition"),
        F.floor(C("event_id") / 4).cast("bigint").alias("offset"), "event_type")
    middle = events.agg((F.max("event_id") / 8).alias("m")).scalar()
    day = dt.date(2024, 1, 31)
    for batch, rows in enumerate((sent.filter(C("offset") < middle), sent, sent)):
        added = ledger.load(rows, f"{path}/ledger", f"{path}/bronze", batch, day)
    if added or ledger.overlaps(ledger.read(t.spark, f"{path}/ledger")).count():
        raise RuntimeError("messages were loaded twice")
    return ledger.report(ledger.read(t.spark, f"{path}/ledger"))


GONE = "(SELECT customer_id FROM s_orders WHERE total_amount > 490000)"


def erased(table: str, key: str) -> str:
    return f"""SELECT '{table}' AS table_name, {key} AS record, CASE WHEN customer_id IN {GONE}
  THEN 'ANONYMIZED' ELSE customer_name END AS customer_name, CASE WHEN customer_id IN {GONE}
  THEN sha256(customer_id) ELSE customer_id END AS customer_id FROM s_{table}"""


def subject_tables(t, path):
    """Orders, shipments and invoices stored by month, each with its index of customers."""
    frames = {"orders": (t.orders, "order_number", "order_date"),
              "shipments": (t.shipments, "shipment_number", "planned_ship_date"),
              "invoices": (t.invoices.withColumn("customer_name", F.lit("-")), "invoice_number",
                           "invoice_date")}
    out = {}
    for name, (df, key, ts) in frames.items():
        storage.append(df.select(C(key).alias("record"), "customer_id", "customer_name",
                                 F.date_format(ts, "yyyy-MM").alias("month")),
                       f"{path}/{name}", "month")
        out[name] = SubjectIndex(t.spark, f"{path}/{name}", "month", "customer_id")
        out[name].refresh()
    return out


@query("gov_2_erased_tables", views="s_orders s_shipments s_invoices", sql=f"""
{erased('orders', 'order_number')} UNION ALL {erased('shipments', 'shipment_number')}
UNION ALL SELECT 'invoices', invoice_number, '-', customer_id FROM s_invoices
UNION ALL SELECT 'log', table_name || ' ' || action, NULL, sha256(customer_id)
FROM (SELECT DISTINCT customer_id FROM s_orders WHERE total_amount > 490000),
  (VALUES ('orders', 'anonymized'), ('shipments', 'anonymized'), ('invoices', 'kept'))
  AS v(table_name, action)""")
def _(t):
    """Erased in the stored orders and shipments, kept in the invoices, and read back."""
    path = folder(t, "erased")
    tables = subject_tables(t, path)
    gone = t.orders.filter(C("total_amount") > 490000).select("customer_id")
    masked = {n: tables[n] for n in ("orders", "shipments")}
    gov.erase_everywhere(t.spark, masked, gone, {n: ["customer_name"] for n in masked},
                         ["invoices"], f"{path}/log", as_of=t.as_of)
    log = t.spark.read.parquet(f"{path}/log").select(
        F.lit("log").alias("table_name"), F.concat_ws(" ", "table_name", "action").alias("record"),
        F.lit(None).cast("string").alias("customer_name"), C("subject_hash").alias("customer_id"))
    return union_all([t.spark.read.parquet(f"{path}/{n}").select(
        F.lit(n).alias("table_name"), "record", "customer_name", "customer_id")
        for n in tables] + [log])


@query("gov_3_exported", views="s_orders s_shipments s_invoices", sql="""
SELECT 'orders' AS table_name, order_number AS record, customer_id FROM s_orders
  WHERE customer_id IN ('7', '11')
UNION ALL SELECT 'shipments', shipment_number, customer_id FROM s_shipments
  WHERE customer_id IN ('7', '11')
UNION ALL SELECT 'invoices', invoice_number, customer_id FROM s_invoices
  WHERE customer_id IN ('7', '11')""")
def _(t):
    """Two customers' rows, written as files and read back from them."""
    path = folder(t, "export")
    two = t.orders.select("customer_id").distinct().filter("customer_id in ('7', '11')")
    tables = subject_tables(t, path)
    gov.export_indexed(tables, two, f"{path}/files")
    schema = "record string, customer_id string"
    return union_all([t.spark.read.schema(schema).json(f"{path}/files/{n}").select(
        F.lit(n).alias("table_name"), "record", "customer_id") for n in tables])


@query("gov_2_rectified", views="s_orders", sql="""
SELECT order_number AS record, customer_id, CASE WHEN customer_id LIKE '%3'
  THEN 'Name ' || customer_id ELSE customer_name END AS customer_name FROM s_orders""")
def _(t):
    path = folder(t, "rectified")
    storage.append(t.orders.select(C("order_number").alias("record"), "customer_id",
                                   "customer_name", F.date_format("order_date", "yyyy-MM")
                                   .alias("month")), f"{path}/orders", "month")
    index = SubjectIndex(t.spark, f"{path}/orders", "month", "customer_id")
    index.refresh()
    new = t.orders.select("customer_id").distinct().filter("customer_id like '%3'").withColumn(
        "customer_name", F.concat_ws(" ", F.lit("Name"), "customer_id"))
    gov.rectify(t.spark, f"{path}/orders", "month", new, "customer_id", ["customer_name"], index)
    return t.spark.read.parquet(f"{path}/orders").select("record", "customer_id", "customer_name")


@query("snk_4_quarantined", views="raw", sql="""
SELECT docnum, message_type, 'unknown status' AS error_reason,
  '2024-01-31 00:00:00' AS quarantined_at FROM raw WHERE status <> '03' OR status IS NULL""")
def _(t):
    """Rows with a bad status go to the quarantine table, and are read back from it."""
    path = folder(t, "quarantine")
    rows = t.raw.select("docnum", "message_type", "status")
    good = storage.quarantine(rows, C("status") != "03", "unknown status", f"{path}/bad",
                              as_of=t.message_as_of)
    storage.append(good, f"{path}/good")
    if t.spark.read.parquet(f"{path}/good").filter("status is null or status <> '03'").count():
        raise RuntimeError("bad rows were let through")
    return t.spark.read.parquet(f"{path}/bad").select("docnum", "message_type", "error_reason",
                                                      "quarantined_at")


@query("gov_6_lineage", views="s_orders", sql=f"""
SELECT 'orders' AS source, 'orders_daily' AS target, 'daily summary' AS process,
  (SELECT count(*) FROM (SELECT DISTINCT order_date::DATE, sap_system FROM s_orders))
    AS row_count, {NOW}::VARCHAR AS run_at""")
def _(t):
    path = folder(t, "lineage")
    storage.create_or_replace(_daily(t.order_facts), f"{path}/gold")
    row = gov.lineage_row(t.spark, "orders", "orders_daily", "daily summary",
                          t.spark.read.parquet(f"{path}/gold"), as_of=t.as_of)
    storage.append(row, f"{path}/log")
    return t.spark.read.parquet(f"{path}/log")


# ---------------------------------------------------------------- streams

def finish(started) -> None:
    started.awaitTermination()
    error = started.exception()
    if error is not None:
        raise RuntimeError(str(error))


def drain(t, df, name: str):
    """Runs a stream over everything there is, into a table, and reads that."""
    path = folder(t, name)
    finish(df.writeStream.format("parquet").option("path", f"{path}/table")
           .option("checkpointLocation", f"{path}/checkpoint").outputMode("append")
           .trigger(availableNow=True).start())
    return t.spark.read.parquet(f"{path}/table")


@query("src_1_bronze_stream", views="raw", sql="""
SELECT docnum, message_type, sap_system, status, "timestamp"::VARCHAR AS timestamp,
  '2024-01-31 00:00:00' AS ingestion_time, "timestamp"::DATE::VARCHAR AS ingest_day FROM raw""")
def _(t):
    path = folder(t, "bronze")
    envelope = t.raw.select(
        "idoc_type", "message_type", "sap_system",
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "control",
        F.struct("k").alias("data"))
    envelope.write.json(f"{path}/in")
    finish(source.land(source.stream_files(t.spark, f"{path}/in"), f"{path}/table",
                       f"{path}/checkpoint", ingested_at="2024-01-31 00:00:00"))
    return t.spark.read.parquet(f"{path}/table").select(
        "docnum", "message_type", "sap_system", "status", "timestamp", "ingestion_time",
        "ingest_day")


def bronze_stream(t, frames, path: str):
    """Messages as a table and the stream that reads it. JSON text is most of the job's data: it
    is packed well, and the shuffle files of its making go once it is written."""
    messages = union_all(frames)
    with storage.freed_shuffles(t.spark):
        messages.write.option("compression", "zstd").parquet(path)
    return t.spark.readStream.schema(messages.schema).parquet(path)


SILVER_SQL = f"""
SELECT 'orders' AS table_name, count(*) AS row_count, {total('total_c')} AS amount FROM s_orders
UNION ALL SELECT 'invoices', count(*), {total('total_c')} FROM s_invoices"""


@query("str_1_silver_routes", views="s_orders s_invoices", sql=SILVER_SQL)
def _(t):
    path = folder(t, "silver")
    made = Messages(t)
    stream = bronze_stream(t, [made.orders, made.invoices], f"{path}/bronze")

    def yearly(extracted, ts):
        return extracted.withColumn("year_start", F.trunc(ts, "year"))

    routes = {
        ("ORDERS",): jobs.Route(lambda r: yearly(extract.extract_orders(r, as_of=t.as_of),
                                                "order_date"),
                                f"{path}/orders", ("order_number", "sap_system"),
                                "message_timestamp", "year_start"),
        ("INVOIC",): jobs.Route(lambda r: yearly(extract.extract_invoices(r, as_of=t.as_of),
                                                "invoice_date"),
                                f"{path}/invoices", ("invoice_number", "sap_system"),
                                "message_timestamp", "year_start"),
    }
    # the second run meets only rows that are stored already
    for run in ("first", "again"):
        finish(jobs.to_silver(stream, routes, f"{path}/checkpoint-{run}", as_of=t.as_of))
    return union_all([t.spark.read.parquet(f"{path}/{n}").agg(
        F.lit(n).alias("table_name"), F.count("*").alias("row_count"),
        F.sum("total_amount").alias("amount")) for n in ("orders", "invoices")])


@query("str_1_logistics_routes", views="s_shipments s_warehouse", sql="""
SELECT 'shipments' AS table_name, count(*) AS row_count, sum(total_weight_kg)::DOUBLE AS amount
FROM s_shipments
UNION ALL SELECT 'deliveries', count(*), sum(total_weight_kg)::DOUBLE FROM s_shipments
WHERE actual_delivery_date IS NOT NULL
UNION ALL SELECT 'movements', count(*), sum(weight_kg)::DOUBLE FROM s_warehouse""")
def _(t):
    """Shipment, delivery and warehouse messages of one stream into their silver tables."""
    path = folder(t, "logistics")
    made = Messages(t)
    stream = bronze_stream(t, [made.shipments, made.deliveries, made.movements], f"{path}/bronze")

    def route(kind, extractor, name, key, ts):
        return {(kind,): jobs.Route(
            lambda r: extractor(r).withColumn("year_start", F.trunc(ts, "year")), f"{path}/{name}",
            (key, "sap_system"), "message_timestamp", "year_start", moves=False)}

    routes = (route("SHPMNT", extract.extract_shipments, "shipments", "shipment_number",
                    "planned_ship_date")
              | route("DESADV", extract.extract_deliveries, "deliveries", "delivery_number",
                      "delivery_date")
              | route("WHSCON", extract.extract_warehouse_header, "movements",
                      "confirmation_number", "movement_timestamp"))
    finish(jobs.to_silver(stream, routes, f"{path}/checkpoint", as_of=t.as_of))
    weight = {"shipments": "total_weight_kg", "deliveries": "total_weight_kg",
              "movements": "weight_kg"}
    return union_all([t.spark.read.parquet(f"{path}/{n}").agg(
        F.lit(n).alias("table_name"), F.count("*").alias("row_count"),
        F.sum(w).cast("double").alias("amount")) for n, w in weight.items()])


@query("str_2_deduplicated", views="raw", sql="SELECT docnum, sap_system FROM raw")
def _(t):
    twice = t.raw_stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return drain(t, jobs.deduplicated(twice).select("docnum", "sap_system"), "dedupe")


@query("str_3_gold_refresh", views="raw", sql=f"""
SELECT {DAY.format('"timestamp"')} AS day, message_type, count(*) AS messages FROM raw
GROUP BY ALL""")
def _(t):
    path = folder(t, "refresh")
    t.raw.select("timestamp", "message_type").write.parquet(f"{path}/silver")

    def daily(df):
        return df.groupBy(F.to_date("timestamp").alias("day"), "message_type").agg(
            F.count("*").alias("messages"))

    stream = t.raw_stream.select("timestamp")
    finish(jobs.refresh_gold(stream, f"{path}/silver", daily, f"{path}/gold", "timestamp", "day",
                             f"{path}/checkpoint"))
    return t.spark.read.parquet(f"{path}/gold")


@query("str_4_tumbling", views="raw", sql="""
SELECT w::VARCHAR AS window_start, (w + INTERVAL 5 MINUTE)::VARCHAR AS window_end, message_type,
  count(*) AS messages
FROM (SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") AS w, message_type FROM raw)
WHERE w + INTERVAL 5 MINUTE <= (SELECT date_trunc('millisecond', max("timestamp"))
  - INTERVAL 10 MINUTE FROM raw) GROUP BY 1, 2, 3""")
def _(t):
    return drain(t, jobs.tumbling_counts(t.raw_stream), "tumbling")


LAG = "date_diff('second', \"timestamp\", ingestion_time)"


@query("str_5_late_report", views="raw", sql=f"""
SELECT message_type, count(*) AS messages, max({LAG}) AS max_latency,
  {pct(cnt(f'{LAG} > 30'), 'count(*)')} AS late_30s_pct,
  {pct(cnt(f'{LAG} > 300'), 'count(*)')} AS late_300s_pct FROM raw GROUP BY 1""")
def _(t):
    return jobs.late_report(t.raw)


@query("str_6_silences", views="raw", sql="""
WITH mark AS (SELECT date_trunc('millisecond', max("timestamp")) - INTERVAL 1 MINUTE AS w FROM raw),
  l AS (SELECT sap_system, "timestamp" AS t, lead("timestamp") OVER (
          PARTITION BY sap_system ORDER BY "timestamp") AS next FROM raw)
SELECT sap_system, t::VARCHAR AS silent_from FROM l, mark
WHERE (next IS NULL OR next - t >= INTERVAL 10 MINUTE + INTERVAL 1 MILLISECOND)
  AND t + INTERVAL 10 MINUTE + INTERVAL 1 MILLISECOND <= w""")
def _(t):
    return drain(t, jobs.silences(t.raw_stream), "silences")


@query("str_7_enriched", sql="""
SELECT event_id, user_id, c_name AS customer_name, c_mktsegment AS segment
FROM events LEFT JOIN customer ON user_id = c_custkey""")
def _(t):
    names = t.table("customer").select(C("c_custkey").alias("user_id"),
                                       C("c_name").alias("customer_name"),
                                       C("c_mktsegment").alias("segment"))
    stream = t.stream("events").select("event_id", "user_id")
    return drain(t, jobs.enriched(stream, names, "user_id"), "enriched")


@query("str_8_alerts", views="raw", sql=f"""
WITH n AS (SELECT max("timestamp") AS t FROM raw),
  h AS (SELECT raw.* FROM raw, n WHERE "timestamp" > t - INTERVAL 1 HOUR)
SELECT 'P95 Latency' AS type, 'High Latency' AS alert,
  round(quantile_cont({LAG}, 0.95), 4)::DOUBLE AS value, 120::DOUBLE AS threshold FROM h
HAVING quantile_cont({LAG}, 0.95) > 120
UNION ALL SELECT 'Error Rate', 'High Error Rate', {pct(cnt("status <> '03'"), 'count(*)')}, 5
FROM h HAVING {pct(cnt("status <> '03'"), 'count(*)')} > 5
UNION ALL SELECT 'Volume', 'Volume Spike', count(*)::DOUBLE,
  (SELECT round({avg('c', 4)} * 3, 4) FROM (SELECT count(*) AS c FROM raw, n
   WHERE "timestamp" > t - INTERVAL 7 DAY GROUP BY date_trunc('hour', "timestamp")))
FROM h HAVING count(*) > (SELECT {avg('c', 4)} * 3 FROM (SELECT count(*) AS c FROM raw, n
   WHERE "timestamp" > t - INTERVAL 7 DAY GROUP BY date_trunc('hour', "timestamp")))""")
def _(t):
    path = folder(t, "alerts")
    finish(alerts.alert_stream(t.raw_stream, f"{path}/state", f"{path}/alerts",
                               f"{path}/checkpoint"))
    schema = "type string, alert string, value double, threshold double"
    return t.spark.read.schema(schema).parquet(f"{path}/alerts").select(
        "type", "alert", "value", "threshold")


LAST = """SELECT sap_system, max("timestamp") AS t FROM raw GROUP BY 1"""
MINUTES = "(date_diff('minute', l.t, w.t))::DOUBLE"


@query("str_8_silence", views="raw", sql=f"""
WITH w AS (SELECT max("timestamp") + INTERVAL 11 MINUTE AS t FROM raw), l AS ({LAST})
SELECT sap_system, {MINUTES} AS value, w.t::VARCHAR AS alerted_at FROM l, w WHERE {MINUTES} > 10
UNION ALL SELECT NULL, {MINUTES}, w.t::VARCHAR FROM (SELECT max(t) AS t FROM l) l, w
WHERE {MINUTES} > 10""")
def _(t):
    """Eleven minutes after the last message the clock goes on; every silence is raised once."""
    path = folder(t, "silence")
    newest = t.raw.agg(F.max("timestamp").alias("t"))
    for k, minutes in enumerate((11, 12, 40)):  # three heartbeats, in three batches
        newest.select((C("t") + F.expr(f"INTERVAL {minutes} MINUTES")).alias("timestamp")).write.mode(
            "append").parquet(f"{path}/beats")
        beats = t.spark.readStream.schema("timestamp timestamp").parquet(f"{path}/beats")
        finish(alerts.alert_stream(t.raw_stream, f"{path}/state", f"{path}/alerts",
                                   f"{path}/checkpoint", beats=beats, each_system=True))
    schema = "type string, sap_system string, value double, alerted_at timestamp"
    return t.spark.read.schema(schema).parquet(f"{path}/alerts").filter(
        "type = 'Silence'").select("sap_system", "value", "alerted_at")


@query("str_9_latest_state", views="s_shipments", sql="""
SELECT shipment_number, CASE WHEN planned_delivery_date >= planned_ship_date THEN
  CASE shipment_status WHEN 'Delivered' THEN 'B' WHEN 'In Transit' THEN 'A' ELSE 'C' END
  ELSE 'P' END AS status_code,
  greatest(planned_ship_date, planned_delivery_date)::VARCHAR AS event_time FROM s_shipments""")
def _(t):
    path = folder(t, "state")
    Messages(t).shipments.write.parquet(f"{path}/bronze")
    stream = t.spark.readStream.schema(Messages(t).shipments.schema).parquet(f"{path}/bronze")
    events = extract.extract_tracking_events(stream)
    finish(jobs.latest_state(events, f"{path}/state", f"{path}/checkpoint", buckets=8))
    return t.spark.read.parquet(f"{path}/state").select(
        "shipment_number", "status_code", "event_time")


