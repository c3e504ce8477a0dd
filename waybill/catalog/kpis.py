"""Registered business KPIs: each over the whole period, and per group."""

from __future__ import annotations

from waybill.catalog.base import query
from waybill.catalog.gold import cnt
from waybill.catalog.views_sql import NOW, avg, pct, rnd, total
from waybill.plans.kpis import executive_tiles, kpi

DELIVERED = "actual_delivery_date IS NOT NULL"
# metric -> (query stem, SQL view, SQL time column, SQL value, grouping shown)
SPECS = {
    "SLA_COMPLIANCE": ("kpi_1_sla_compliance", "s_orders", "order_date",
                       pct(cnt("sla_status IN ('Met', 'Good')"), "count(*)"), "MONTH"),
    "ON_TIME_DELIVERY_RATE": ("kpi_2_on_time_delivery", "s_shipments", "actual_ship_date",
                              pct(cnt(f"{DELIVERED} AND is_on_time"), cnt(DELIVERED)), "CARRIER"),
    "WAREHOUSE_EFFICIENCY": ("kpi_3_warehouse_efficiency", "s_warehouse", "movement_timestamp",
                             rnd("count(*) * 60", "sum(processing_time_minutes)"), "WAREHOUSE"),
    "DAYS_SALES_OUTSTANDING": ("kpi_4_dso", "s_invoices", "invoice_date",
                               rnd("sum(due_c) * 30", "sum(total_c)"), "MONTH"),
    "ORDER_FULFILLMENT_RATE": ("kpi_5_fulfilment", "s_orders", "order_date",
                               pct(cnt("order_status = 'Delivered'"), "count(*)"), "CUSTOMER"),
    "AVG_DELIVERY_DELAY": ("kpi_6_delivery_delay", "s_shipments", "actual_ship_date",
                           avg("delivery_delay_hours"), "CARRIER"),
    "AVG_INVOICE_AGING": ("kpi_7_invoice_aging", "s_invoices", "invoice_date",
                          avg(f"date_diff('day', invoice_date, {NOW})"), "CUSTOMER"),
    "AVG_TRANSIT_TIME": ("kpi_8_transit_time", "s_shipments", "actual_ship_date",
                         avg("transit_time_hours"), "WEEK"),
    "TOTAL_SHIPMENTS": ("kpi_9_total_shipments", "s_shipments", "planned_ship_date",
                        "count(*)", "DAY"),
    "TOTAL_ORDERS": ("kpi_10_total_orders", "s_orders", "order_date", "count(*)", "WEEK"),
    "TOTAL_REVENUE": ("kpi_11_total_revenue", "s_invoices", "invoice_date", total("total_c"),
                      "MONTH"),
}
GROUP_SQL = {
    "DAY": "CAST({0} AS DATE)::VARCHAR",
    "WEEK": "(CAST({0} AS DATE) - dayofweek({0})::INTEGER)::VARCHAR",
    "MONTH": "CAST(date_trunc('month', {0}) AS DATE)::VARCHAR",
    "WAREHOUSE": "warehouse_id", "CARRIER": "carrier_id", "CUSTOMER": "customer_id",
}


def _register(metric: str) -> None:
    stem, view, time, value, group = SPECS[metric]

    @query(stem, views=view, sql=f"SELECT '{metric}' AS metric, {value} AS value FROM {view}")
    def _whole(t):
        return kpi(t, metric, as_of=t.as_of)

    @query(f"{stem}_by_{group.lower()}", views=view, sql=f"""
        SELECT {GROUP_SQL[group].format(time)} AS group_key, '{metric}' AS metric,
        {value} AS value FROM {view} GROUP BY 1""")
    def _grouped(t):
        return kpi(t, metric, group_by=group, as_of=t.as_of)


for _metric in SPECS:
    _register(_metric)

TODAY = "CAST({0} AS DATE) = CAST(" + NOW + " AS DATE)"


def _cell(metric: str) -> str:
    _, view, time, value, _ = SPECS[metric]
    return f"(SELECT {value} FROM {view} WHERE {TODAY.format(time)})"


@query("kpi_12_executive_tiles", views="s_orders s_shipments s_warehouse s_invoices", sql=f"""
SELECT {_cell('SLA_COMPLIANCE')} AS sla_compliance_pct,
  {_cell('ON_TIME_DELIVERY_RATE')} AS on_time_delivery_pct,
  {_cell('WAREHOUSE_EFFICIENCY')} AS warehouse_productivity,
  {_cell('TOTAL_REVENUE')} AS revenue, {_cell('TOTAL_ORDERS')} AS total_orders""")
def _(t):
    return executive_tiles(t, as_of=t.as_of)
