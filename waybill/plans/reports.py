"""Reports over the daily tables: totals, shares, rankings, latest day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import as_ts, average, pct
from waybill.functions.policies import rank_of
from waybill.operators.rows import latest_slice, top_by
from waybill.plans.gold import n_if

C = F.col
SLA_RANK = {"Good": 1, "At Risk": 2, "Breached": 3}
RISK_RANK = {"Low": 1, "Medium": 2, "High": 3}


def since(day: str, days: int, as_of) -> Column:
    return C(day) >= F.date_sub(F.to_date(as_ts(as_of)), days)


def share_of_total(df: DataFrame, *by: str, name: str = "percentage",
                   count: str = "row_count") -> DataFrame:
    """Row count per group and its share of all rows.

    The total is a scalar subquery over the counts, so no window gathers them in one task.
    """
    counts = df.groupBy(*by).agg(F.count("*").alias(count))
    whole = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(name, pct(C(count), whole))


def orders_summary(daily: DataFrame) -> DataFrame:
    """One row over the whole daily order table."""
    return daily.agg(
        F.count_distinct(C("order_day")).alias("total_days"),
        F.count_distinct(C("sap_system")).alias("total_systems"),
        F.count("*").alias("total_rows"),
        F.sum("total_orders").alias("total_orders_all_time"),
        F.sum("total_revenue").alias("total_revenue_all_time"),
        average(C("sla_compliance_pct")).alias("avg_sla_compliance_pct"),
        average(C("delivery_rate_pct")).alias("avg_delivery_rate_pct"),
        F.min("order_day").alias("earliest_day"),
        F.max("order_day").alias("latest_day"),
    )


def latest_day(daily: DataFrame, day: str = "order_day") -> DataFrame:
    return latest_slice(daily, day)


def latest_day_by_system(daily: DataFrame) -> DataFrame:
    return latest_slice(daily, "order_day").groupBy("order_day", "sap_system").agg(
        F.sum("total_orders").alias("orders"),
        F.sum("total_revenue").alias("revenue"),
        average(C("sla_compliance_pct")).alias("sla_pct"),
        average(C("delivery_rate_pct")).alias("delivery_pct"),
    )


def sla_distribution(daily: DataFrame) -> DataFrame:
    return daily.groupBy("sla_status").agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_revenue").alias("total_revenue"),
        average(C("sla_compliance_pct")).alias("avg_compliance_pct"),
    ).orderBy(rank_of(SLA_RANK, C("sla_status")), "sla_status")


def recent_trend(daily: DataFrame, days: int = 7, *, as_of) -> DataFrame:
    return daily.filter(since("order_day", days, as_of)).groupBy("order_day").agg(
        F.sum("total_orders").alias("orders"),
        F.sum("total_revenue").alias("revenue"),
        average(C("sla_compliance_pct")).alias("sla_compliance"),
    ).orderBy(F.desc("order_day"))


def sla_class_report(per_order: DataFrame) -> DataFrame:
    """Orders per class with their share and averages."""
    grouped = per_order.groupBy("sla_compliance").agg(
        F.count("*").alias("order_count"),
        average(C("processing_days")).alias("avg_processing_days"),
        average(C("sla_variance_hours")).alias("avg_variance_hours"),
        n_if(C("is_critical")).alias("critical_count"),
        average(C("total_amount")).alias("avg_order_value"),
    )
    whole = grouped.agg(F.sum("order_count")).scalar()
    return grouped.withColumn("percentage", pct(C("order_count"), whole)).orderBy(
        F.desc("order_count"), "sla_compliance")


def transit_report(delays: DataFrame) -> DataFrame:
    return delays.groupBy("delay_status", "priority", "priority_rank").agg(
        F.count("*").alias("shipment_count"),
        average(C("days_in_transit"), 1).alias("avg_days_in_transit"),
        average(C("days_delayed"), 1).alias("avg_days_delayed"),
        F.sum("shipment_value").alias("total_value"),
        F.count_distinct(C("carrier_name")).alias("carrier_count"),
    ).orderBy("priority_rank", F.desc("shipment_count"), "delay_status").drop("priority_rank")


def most_delayed(delays: DataFrame, n: int = 10) -> DataFrame:
    rows = delays.filter(C("delay_status") == "Delayed").select(
        "shipment_number", "order_number", "carrier_name", "days_in_transit", "days_delayed",
        "delay_status", "priority", "shipment_value", "planned_delivery_date")
    return top_by(rows, n, F.desc("days_delayed"), F.desc("shipment_value"), "shipment_number")


def warehouse_summary(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.count_distinct(C("movement_day")).alias("total_days"),
        F.count_distinct(C("warehouse_id")).alias("total_warehouses"),
        F.count_distinct(C("movement_type")).alias("movement_types"),
        F.sum("total_movements").alias("total_movements_all_time"),
        average(C("quantity_per_hour")).alias("avg_productivity"),
        average(C("exception_rate_pct")).alias("avg_exception_rate"),
        n_if(C("performance_status") == "Below Target").alias("below_target_days"),
        F.max("movement_day").alias("latest_day"),
    )


def warehouse_performance(daily: DataFrame, days: int = 30, by_type: bool = True, *,
                          as_of) -> DataFrame:
    by = ["warehouse_id", "movement_type", "performance_status"] if by_type else ["warehouse_id"]
    return daily.filter(since("movement_day", days, as_of)).groupBy(*by).agg(
        F.count("*").alias("total_days"),
        average(C("quantity_per_hour")).alias("avg_productivity"),
        average(C("exception_rate_pct")).alias("avg_exception_rate"),
    )


def revenue_summary(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.count_distinct(C("invoice_day")).alias("total_days"),
        F.count_distinct(C("customer_id")).alias("total_customers"),
        F.sum("total_invoices").alias("total_invoices_all_time"),
        F.sum("total_revenue").alias("total_revenue_all_time"),
        F.sum("total_paid").alias("total_collected"),
        F.sum("total_due").alias("total_outstanding"),
        average(C("collection_efficiency_pct")).alias("avg_collection_efficiency"),
        average(C("avg_days_to_payment"), 1).alias("avg_dso"),
        n_if(C("collection_risk") == "High").alias("high_risk_customers"),
        F.max("invoice_day").alias("latest_day"),
    )


AGING = ("aging_current", "aging_1_30", "aging_31_60", "aging_61_90", "aging_90_plus")


def aging_report(daily: DataFrame, days: int = 30, *, as_of) -> DataFrame:
    return daily.filter(since("invoice_day", days, as_of)).agg(
        *[F.sum(a).alias(f"{a}_outstanding") for a in AGING],
        F.sum("total_outstanding").alias("total_outstanding"),
        pct(F.sum("aging_90_plus"), F.sum("total_outstanding")).alias("pct_90_plus"),
    )


def top_customers(daily: DataFrame, n: int = 20, days: int = 90, *, as_of) -> DataFrame:
    risk = F.max(rank_of(RISK_RANK, C("collection_risk")))
    grouped = daily.filter(since("invoice_day", days, as_of)).groupBy("customer_id").agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_paid").alias("total_collected"),
        F.sum("total_due").alias("total_outstanding"),
        F.sum("aging_90_plus").alias("at_risk_amount"),
        average(C("collection_efficiency_pct")).alias("avg_collection_efficiency"),
        average(C("avg_days_to_payment"), 1).alias("avg_dso"),
        risk.alias("risk_rank"),
        F.count_distinct(C("invoice_day")).alias("invoice_days"),
    )
    label = F.element_at(F.array(*[F.lit(k) for k in RISK_RANK]), C("risk_rank"))
    return top_by(grouped.withColumn("risk_level", label).drop("risk_rank"), n,
                  F.desc("total_revenue"), "customer_id")


def high_risk_customers(daily: DataFrame, n: int = 10, days: int = 30, *, as_of) -> DataFrame:
    rows = daily.filter(since("invoice_day", days, as_of) & (C("aging_90_plus") > 0))
    grouped = rows.groupBy("customer_id", "collection_risk").agg(
        F.sum("aging_90_plus").alias("aging_90_plus"),
        F.sum("total_outstanding").alias("total_outstanding"),
        pct(F.sum("aging_90_plus"), F.sum("total_outstanding")).alias("pct_90_plus"),
        F.count_distinct(C("invoice_day")).alias("invoice_days"),
    )
    return top_by(grouped, n, F.desc("aging_90_plus"), "customer_id", "collection_risk")


def silver_summary(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count("*").alias("total_orders"),
        F.count_distinct(C("customer_id")).alias("unique_customers"),
        F.count_distinct(C("sap_system")).alias("sap_systems"),
        F.sum("total_amount").alias("total_revenue"),
        average(C("total_amount")).alias("avg_order_value"),
        F.min("order_date").alias("earliest_order"),
        F.max("order_date").alias("latest_order"),
        n_if(C("order_status") == "Delivered").alias("delivered_orders"),
        n_if(C("sla_status") == "Good").alias("sla_good"),
        n_if(C("sla_status") == "At Risk").alias("sla_at_risk"),
        n_if(C("sla_status") == "Breached").alias("sla_breached"),
    )


