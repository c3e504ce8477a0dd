"""Business KPIs: one definition per metric, any period, any grouping."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions import as_ts, average, month_start, pct, ratio, week_start

C = F.col


@dataclass(frozen=True)
class Metric:
    table: str
    time: str
    value: Callable[[Column, int], Column]


def _on_time(_now, _days):
    done = C("actual_delivery_date").isNotNull()
    return pct(F.count_if(done & C("is_on_time")), F.count_if(done))


METRICS: dict[str, Metric] = {
    "SLA_COMPLIANCE": Metric("order_facts", "order_date", lambda now, d: pct(
        F.count_if(C("sla_status").isin("Met", "Good")), F.count("*"))),
    "ON_TIME_DELIVERY_RATE": Metric("shipments", "actual_ship_date", _on_time),
    "WAREHOUSE_EFFICIENCY": Metric("warehouse", "movement_timestamp", lambda now, d: ratio(
        F.count("*") * 60, F.sum("processing_time_minutes"))),
    "DAYS_SALES_OUTSTANDING": Metric("invoices", "invoice_date", lambda now, d: ratio(
        F.sum("amount_due"), F.sum("total_amount"), factor=d)),
    "ORDER_FULFILLMENT_RATE": Metric("order_facts", "order_date", lambda now, d: pct(
        F.count_if(C("order_status") == "Delivered"), F.count("*"))),
    "AVG_DELIVERY_DELAY": Metric("shipments", "actual_ship_date",
                                 lambda now, d: average(C("delivery_delay_hours"))),
    "AVG_INVOICE_AGING": Metric("invoices", "invoice_date",
                                lambda now, d: average(F.datediff(now, "invoice_date"))),
    "AVG_TRANSIT_TIME": Metric("shipments", "actual_ship_date",
                               lambda now, d: average(C("transit_time_hours"))),
    "TOTAL_SHIPMENTS": Metric("shipments", "planned_ship_date", lambda now, d: F.count("*")),
    "TOTAL_ORDERS": Metric("order_facts", "order_date", lambda now, d: F.count("*")),
    "TOTAL_REVENUE": Metric("invoices", "invoice_date", lambda now, d: F.sum("total_amount")),
}

GROUPS: dict[str, Callable[[str], Column]] = {
    "DAY": lambda ts: F.to_date(ts),
    "WEEK": lambda ts: week_start(C(ts)),
    "MONTH": lambda ts: month_start(C(ts)),
    "WAREHOUSE": lambda ts: C("warehouse_id"),
    "CARRIER": lambda ts: C("carrier_id"),
    "CUSTOMER": lambda ts: C("customer_id"),
}


def kpi(tables, metric: str, period: tuple | None = None, group_by: str | None = None, *,
        as_of, days: int = 30) -> DataFrame:
    """Value of ``metric``, for a period (from, to; the end is excluded) and per group.

    ``tables`` maps an entity name to its frame, as attributes or items; ``order_facts`` are
    orders, for which customer names are not needed.
    """
    spec = METRICS[metric]
    df = tables[spec.table] if isinstance(tables, dict) else getattr(tables, spec.table)
    if period is not None:
        start, end = period
        df = df.filter((C(spec.time) >= as_ts(start)) & (C(spec.time) < as_ts(end)))
    keys = [] if group_by is None else [GROUPS[group_by](spec.time).alias("group_key")]
    out = df.groupBy(*keys).agg(spec.value(as_ts(as_of), days).alias("value"))
    return out.withColumn("metric", F.lit(metric))


def one_row(spark: SparkSession, **values: DataFrame) -> DataFrame:
    """One row whose columns are one-cell frames, each as a scalar subquery."""
    return spark.range(1).select(*[df.scalar().alias(name) for name, df in values.items()])


def executive_tiles(tables, *, as_of) -> DataFrame:
    """Today's compliance, on-time rate, warehouse productivity and revenue in one row."""
    day = F.date_trunc("day", as_ts(as_of))
    period = (day, day + F.expr("INTERVAL 1 DAY"))

    def cell(metric: str) -> DataFrame:
        return kpi(tables, metric, period, as_of=as_of).select("value")

    return one_row(
        tables.spark,
        sla_compliance_pct=cell("SLA_COMPLIANCE"),
        on_time_delivery_pct=cell("ON_TIME_DELIVERY_RATE"),
        warehouse_productivity=cell("WAREHOUSE_EFFICIENCY"),
        revenue=cell("TOTAL_REVENUE"),
        total_orders=cell("TOTAL_ORDERS"),
    )
