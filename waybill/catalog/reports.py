"""Registered reports over the daily tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.catalog.base import query
from waybill.catalog.gold import (
    DELAYS, ORDER_DAY, PER_ORDER, RECOGNITION, WH_DAILY, avg_h, BY_SLA, cnt,
)
from waybill.catalog.views_sql import NOW, avg, pct, total
from waybill.plans import gold, reports

DAILY = (f"daily AS (SELECT {ORDER_DAY} AS order_day, sap_system, sla_status, {BY_SLA}, "
         "sum(total_c)::BIGINT AS rev_c FROM g_orders GROUP BY ALL)")


def amount(cents: str) -> str:
    return f"(sum({cents})::DOUBLE / 100)"


def back(column: str, days: int) -> str:
    return f"{column}::DATE >= CAST({NOW} AS DATE) - {days}"


@query("rpt_1_orders_summary", views="g_orders", sql=f"""
WITH {DAILY}
SELECT count(DISTINCT order_day) AS total_days, count(DISTINCT sap_system) AS total_systems,
  count(*) AS total_rows, sum(total_orders)::BIGINT AS total_orders_all_time,
  {amount('rev_c')} AS total_revenue_all_time,
  {avg_h('sla_compliance_pct')} AS avg_sla_compliance_pct,
  {avg_h('delivery_rate_pct')} AS avg_delivery_rate_pct, min(order_day) AS earliest_day,
  max(order_day) AS latest_day FROM daily""")
def _(t):
    return reports.orders_summary(gold.orders_by_sla(t.gold_order_facts))


@query("rpt_1_latest_day", views="g_orders", sql=f"""
WITH {DAILY}
SELECT * EXCLUDE (rev_c) FROM daily WHERE order_day = (SELECT max(order_day) FROM daily)""")
def _(t):
    return reports.latest_day(gold.orders_by_sla(t.gold_order_facts)).orderBy("sap_system", "sla_status")


@query("rpt_2_sla_class_share", views="g_orders s_shipments", sql=f"""
WITH per_order AS ({PER_ORDER})
SELECT sla_compliance, count(*) AS order_count, {avg('processing_days')} AS avg_processing_days,
  {avg('sla_variance_hours')} AS avg_variance_hours, {cnt('is_critical')} AS critical_count,
  {avg('round(total_amount * 100)::BIGINT', cents=2)} AS avg_order_value,
  {pct('count(*)', '(SELECT count(*) FROM per_order)')} AS percentage
FROM per_order GROUP BY sla_compliance""")
def _(t):
    return reports.sla_class_report(gold.sla_per_order(t.gold_order_facts, t.shipments, as_of=t.as_of))


@query("rpt_3_transit_summary", views="s_shipments", sql=f"""
WITH delays AS ({DELAYS})
SELECT delay_status, priority, count(*) AS shipment_count,
  {avg('days_in_transit', 1)} AS avg_days_in_transit, {avg('days_delayed', 1)} AS avg_days_delayed,
  {amount('round(shipment_value * 100)::BIGINT')} AS total_value,
  count(DISTINCT carrier_name) AS carrier_count FROM delays GROUP BY delay_status, priority""")
def _(t):
    return reports.transit_report(gold.transit_delays(t.shipments, as_of=t.as_of))


@query("rpt_3_most_delayed", views="s_shipments", sql=f"""
WITH delays AS ({DELAYS})
SELECT shipment_number, order_number, carrier_name, days_in_transit, days_delayed, delay_status,
  priority, shipment_value, planned_delivery_date
FROM delays WHERE delay_status = 'Delayed'
ORDER BY days_delayed DESC, shipment_value DESC, shipment_number LIMIT 10""")
def _(t):
    return reports.most_delayed(gold.transit_delays(t.shipments, as_of=t.as_of))


@query("rpt_4_warehouse_summary", views="s_warehouse", sql=f"""
WITH daily AS ({WH_DAILY})
SELECT count(DISTINCT movement_day) AS total_days,
  count(DISTINCT warehouse_id) AS total_warehouses,
  count(DISTINCT movement_type) AS movement_types,
  sum(total_movements)::BIGINT AS total_movements_all_time,
  {avg_h('quantity_per_hour')} AS avg_productivity,
  {avg_h('exception_rate_pct')} AS avg_exception_rate,
  {cnt("performance_status = 'Below Target'")} AS below_target_days,
  max(movement_day) AS latest_day FROM daily""")
def _(t):
    return reports.warehouse_summary(gold.warehouse_productivity(t.warehouse))


@query("rpt_4_warehouse_performance", views="s_warehouse", sql=f"""
WITH daily AS ({WH_DAILY})
SELECT warehouse_id, movement_type, performance_status, count(*) AS total_days,
  {avg_h('quantity_per_hour')} AS avg_productivity,
  {avg_h('exception_rate_pct')} AS avg_exception_rate
FROM daily WHERE {back('movement_day', 30)} GROUP BY ALL""")
def _(t):
    daily = gold.warehouse_productivity(t.warehouse)
    return reports.warehouse_performance(daily, as_of=t.as_of)


@query("rpt_4_warehouse_ranking", views="s_warehouse", sql=f"""
WITH daily AS ({WH_DAILY})
SELECT warehouse_id, count(*) AS total_days, {avg_h('quantity_per_hour')} AS avg_productivity,
  {avg_h('exception_rate_pct')} AS avg_exception_rate
FROM daily WHERE {back('movement_day', 30)} GROUP BY ALL""")
def _(t):
    daily = gold.warehouse_productivity(t.warehouse)
    return reports.warehouse_performance(daily, by_type=False, as_of=t.as_of).orderBy(
        F.desc("avg_productivity"), "warehouse_id")


CENTS = "round({0} * 100)::BIGINT"


def dsum(column: str) -> str:
    return amount(CENTS.format(column))


@query("rpt_5_revenue_summary", views="s_invoices", sql=f"""
WITH daily AS ({RECOGNITION})
SELECT count(DISTINCT invoice_day) AS total_days, count(DISTINCT customer_id) AS total_customers,
  sum(total_invoices)::BIGINT AS total_invoices_all_time,
  {dsum('total_revenue')} AS total_revenue_all_time, {dsum('total_paid')} AS total_collected,
  {dsum('total_due')} AS total_outstanding,
  {avg_h('collection_efficiency_pct')} AS avg_collection_efficiency,
  {avg('round(avg_days_to_payment * 100)::BIGINT', 1, cents=2)} AS avg_dso,
  {cnt("collection_risk = 'High'")} AS high_risk_customers, max(invoice_day) AS latest_day
FROM daily""")
def _(t):
    return reports.revenue_summary(gold.revenue_recognition(t.invoices))


P90 = pct("sum(round(aging_90_plus * 100)::BIGINT)", "sum(round(total_outstanding * 100)::BIGINT)")


@query("rpt_5_aging", views="s_invoices", sql=f"""
WITH daily AS ({RECOGNITION})
SELECT {dsum('aging_current')} AS aging_current_outstanding,
  {dsum('aging_1_30')} AS aging_1_30_outstanding, {dsum('aging_31_60')} AS aging_31_60_outstanding,
  {dsum('aging_61_90')} AS aging_61_90_outstanding,
  {dsum('aging_90_plus')} AS aging_90_plus_outstanding,
  {dsum('total_outstanding')} AS total_outstanding, {P90} AS pct_90_plus
FROM daily WHERE {back('invoice_day', 30)}""")
def _(t):
    return reports.aging_report(gold.revenue_recognition(t.invoices), as_of=t.as_of)


@query("rpt_5_top_customers", views="s_invoices", sql=f"""
WITH daily AS ({RECOGNITION})
SELECT customer_id, {dsum('total_revenue')} AS total_revenue, {dsum('total_paid')} AS total_collected,
  {dsum('total_due')} AS total_outstanding, {dsum('aging_90_plus')} AS at_risk_amount,
  {avg_h('collection_efficiency_pct')} AS avg_collection_efficiency,
  {avg('round(avg_days_to_payment * 100)::BIGINT', 1, cents=2)} AS avg_dso,
  CASE WHEN bool_or(collection_risk = 'High') THEN 'High'
    WHEN bool_or(collection_risk = 'Medium') THEN 'Medium' ELSE 'Low' END AS risk_level,
  count(DISTINCT invoice_day) AS invoice_days
FROM daily WHERE {back('invoice_day', 90)} GROUP BY customer_id
ORDER BY 2 DESC, customer_id LIMIT 20""")
def _(t):
    return reports.top_customers(gold.revenue_recognition(t.invoices), as_of=t.as_of)


@query("rpt_5_high_risk", views="s_invoices", sql=f"""
WITH daily AS ({RECOGNITION})
SELECT customer_id, collection_risk, {dsum('aging_90_plus')} AS aging_90_plus,
  {dsum('total_outstanding')} AS total_outstanding, {P90} AS pct_90_plus,
  count(DISTINCT invoice_day) AS invoice_days
FROM daily WHERE {back('invoice_day', 365)} AND aging_90_plus > 0
GROUP BY customer_id, collection_risk
ORDER BY 3 DESC, customer_id, collection_risk LIMIT 10""")
def _(t):
    return reports.high_risk_customers(gold.revenue_recognition(t.invoices), days=365,
                                       as_of=t.as_of)


@query("rpt_6_silver_summary", views="s_orders", sql=f"""
SELECT count(*) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
  count(DISTINCT sap_system) AS sap_systems, {total('total_c')} AS total_revenue,
  {avg('total_c', cents=2)} AS avg_order_value, min(order_date)::VARCHAR AS earliest_order,
  max(order_date)::VARCHAR AS latest_order,
  {cnt("order_status = 'Delivered'")} AS delivered_orders,
  {cnt("sla_status = 'Good'")} AS sla_good, {cnt("sla_status = 'At Risk'")} AS sla_at_risk,
  {cnt("sla_status = 'Breached'")} AS sla_breached FROM s_orders""")
def _(t):
    return reports.silver_summary(t.orders)


@query("rpt_6_status_share", views="s_orders", sql=f"""
SELECT order_status, count(*) AS row_count,
  {pct('count(*)', '(SELECT count(*) FROM s_orders)')} AS percentage
FROM s_orders GROUP BY order_status""")
def _(t):
    return reports.share_of_total(t.orders, "order_status").orderBy(
        F.desc("row_count"), "order_status")


@query("rpt_6_sla_share", views="s_orders", sql=f"""
SELECT sla_status, count(*) AS row_count,
  {pct('count(*)', '(SELECT count(*) FROM s_orders)')} AS percentage
FROM s_orders GROUP BY sla_status""")
def _(t):
    return reports.share_of_total(t.orders, "sla_status").orderBy("sla_status")


@query("rpt_7_latest_day", views="g_orders", sql=f"""
WITH {DAILY}
SELECT order_day, sap_system, sum(total_orders)::BIGINT AS orders, {amount('rev_c')} AS revenue,
  {avg_h('sla_compliance_pct')} AS sla_pct, {avg_h('delivery_rate_pct')} AS delivery_pct
FROM daily WHERE order_day = (SELECT max(order_day) FROM daily) GROUP BY ALL""")
def _(t):
    return reports.latest_day_by_system(gold.orders_by_sla(t.gold_order_facts))


@query("rpt_7_sla_distribution", views="g_orders", sql=f"""
WITH {DAILY}
SELECT sla_status, sum(total_orders)::BIGINT AS total_orders, {amount('rev_c')} AS total_revenue,
  {avg_h('sla_compliance_pct')} AS avg_compliance_pct FROM daily GROUP BY sla_status""")
def _(t):
    return reports.sla_distribution(gold.orders_by_sla(t.gold_order_facts))


@query("rpt_7_trend", views="g_orders", sql=f"""
WITH {DAILY}
SELECT order_day, sum(total_orders)::BIGINT AS orders, {amount('rev_c')} AS revenue,
  {avg_h('sla_compliance_pct')} AS sla_compliance
FROM daily WHERE {back('order_day', 7)} GROUP BY order_day""")
def _(t):
    return reports.recent_trend(gold.orders_by_sla(t.gold_order_facts), as_of=t.as_of)


