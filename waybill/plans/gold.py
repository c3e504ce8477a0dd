"""Daily KPI tables over silver entities.

Each function is one aggregation: a partial aggregate before the shuffle on the grain columns,
then expressions over the grouped row. Grain columns come first in the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import (
    as_ts,
    average,
    bin_floor,
    diff_boundary,
    movement_label,
    pct,
    ratio,
    urgency,
)
from waybill.functions.policies import PRIORITY_RANK, URGENCY_RANK, rank_of

C = F.col


def n_if(cond: Column) -> Column:
    return F.count_if(cond)


def sum_if(value: Column, cond: Column) -> Column:
    return F.sum(F.when(cond, value))


def distinct(column: str, approx: bool) -> Column:
    return F.approx_count_distinct(column) if approx else F.count_distinct(C(column))


def _is(column: str, value: str) -> Column:
    return C(column) == value


# ---------------------------------------------------------------- orders

def orders_daily(orders: DataFrame, by: Sequence[str] = ("sap_system",), *,
                 approx: bool = False) -> DataFrame:
    """Orders per day and system: volume, value, status, service level and priority mix."""
    status = {s: n_if(_is("order_status", s)) for s in
              ("Pending", "Confirmed", "Shipped", "Delivered", "Cancelled")}
    grouped = orders.groupBy(F.to_date("order_date").alias("order_day"), *by).agg(
        F.count("*").alias("total_orders"),
        F.sum("total_amount").alias("total_order_value"),
        average(C("total_amount")).alias("avg_order_value"),
        F.sum("total_lines").alias("total_lines"),
        F.sum("total_quantity").alias("total_quantity"),
        F.sum("total_weight_kg").alias("total_weight_kg"),
        distinct("customer_id", approx).alias("unique_customers"),
        *[c.alias(f"{s.lower()}_orders") for s, c in status.items()],
        n_if(_is("sla_status", "Good")).alias("sla_good"),
        n_if(_is("sla_status", "At Risk")).alias("sla_at_risk"),
        n_if(_is("sla_status", "Breached")).alias("sla_breached"),
        n_if(C("is_delayed")).alias("delayed_orders"),
        average(C("order_age_hours")).alias("avg_order_age_hours"),
        *[n_if(_is("priority", p)).alias(f"{p.lower()}_priority")
          for p in ("High", "Medium", "Low")],
        F.min("order_date").alias("first_order_time"),
        F.max("order_date").alias("last_order_time"),
        F.sort_array(F.collect_set("currency")).alias("currencies_used"),
    )
    n = C("total_orders")
    return grouped.withColumns({
        "sla_compliance_pct": pct(C("sla_good"), n),
        "avg_lines_per_order": ratio(C("total_lines"), n),
        "avg_quantity_per_order": ratio(C("total_quantity"), n),
        "avg_weight_per_order": ratio(C("total_weight_kg"), n),
        "order_completion_rate": pct(C("delivered_orders"), n),
        "order_cancellation_rate": pct(C("cancelled_orders"), n),
        "order_velocity_per_hour": ratio(n, F.lit(24)),
    })


def orders_by_sla(orders: DataFrame, by: Sequence[str] = ("sap_system", "sla_status"),
                  *, shipped_and_pending: bool = False) -> DataFrame:
    """Orders per day, system and service-level class: counts, revenue and lead times.

    Grouping by class makes ``sla_compliance_pct`` 0 or 100 per row; ``orders_daily`` has
    the rate over all classes. ``shipped_and_pending`` adds those counts and the pending rate.
    """
    n_good, n_delivered = n_if(_is("sla_status", "Good")), n_if(_is("order_status", "Delivered"))
    n = F.count("*")
    extra = []
    if shipped_and_pending:
        pending = n_if(_is("order_status", "Pending"))
        extra = [n_if(_is("order_status", "Shipped")).alias("shipped_orders"),
                 pending.alias("pending_orders"), pct(pending, n).alias("pending_rate_pct")]
    return orders.groupBy(F.to_date("order_date").alias("order_day"), *by).agg(
        n.alias("total_orders"),
        n_delivered.alias("delivered_orders"),
        n_if(_is("order_status", "Cancelled")).alias("cancelled_orders"),
        F.sum("total_amount").alias("total_revenue"),
        average(C("total_amount")).alias("avg_order_value"),
        F.min("total_amount").alias("min_order_value"),
        F.max("total_amount").alias("max_order_value"),
        average(F.datediff("actual_ship_date", "order_date")).alias("avg_days_to_ship"),
        average(F.datediff("actual_delivery_date", "order_date")).alias("avg_days_to_delivery"),
        n_good.alias("sla_good_count"),
        n_if(_is("sla_status", "At Risk")).alias("sla_at_risk_count"),
        n_if(_is("sla_status", "Breached")).alias("sla_breached_count"),
        pct(n_good, n).alias("sla_compliance_pct"),
        pct(n_delivered, n).alias("delivery_rate_pct"),
        *extra,
    )


def orders_volume(orders: DataFrame) -> DataFrame:
    """Daily order volume and value with urgent orders and customers."""
    return orders.groupBy(F.to_date("order_date").alias("order_day"), "sap_system").agg(
        F.count("*").alias("total_orders"),
        F.sum("total_amount").alias("total_order_value"),
        average(C("total_amount")).alias("avg_order_value"),
        F.max("total_amount").alias("max_order_value"),
        n_if(_is("priority", "High")).alias("urgent_orders"),
        F.count_distinct(C("customer_id")).alias("unique_customers"),
    )


def sla_overview(orders: DataFrame) -> DataFrame:
    """Service-level class counts, compliance and order age per day and system."""
    good = n_if(_is("sla_status", "Good"))
    return orders.groupBy(F.to_date("order_date").alias("performance_day"), "sap_system").agg(
        F.count("*").alias("total_orders"),
        good.alias("sla_good"),
        n_if(_is("sla_status", "At Risk")).alias("sla_at_risk"),
        n_if(_is("sla_status", "Breached")).alias("sla_breached"),
        pct(good, F.count("*")).alias("sla_compliance_pct"),
        average(C("order_age_hours")).alias("avg_order_age_hours"),
        F.max("order_age_hours").alias("max_order_age_hours"),
    )


def orders_hourly(orders: DataFrame) -> DataFrame:
    return orders.groupBy(bin_floor(C("order_date"), 3600).alias("order_hour"), "sap_system").agg(
        F.count("*").alias("total_orders"), F.sum("total_amount").alias("total_value"),
        n_if(_is("sla_status", "Breached")).alias("breached_orders"))


# ---------------------------------------------------------------- service level

def sla_daily(orders: DataFrame) -> DataFrame:
    """Service level per day and system with a weighted score.

    Score: half the compliance, three tenths the on-time delivery rate, two tenths the share of
    orders that were not cancelled.
    """
    good, breached = _is("sla_status", "Good"), _is("sla_status", "Breached")
    delivered = _is("order_status", "Delivered")
    finished = C("order_status").isin("Shipped", "Delivered")
    age = C("order_age_hours")
    grouped = orders.groupBy(F.to_date("order_date").alias("performance_date"),
                             "sap_system").agg(
        F.count("*").alias("total_orders"),
        n_if(good).alias("order_sla_good"),
        n_if(_is("sla_status", "At Risk")).alias("order_sla_at_risk"),
        n_if(breached).alias("order_sla_breached"),
        n_if(C("is_delayed")).alias("delayed_orders"),
        average(age).alias("avg_order_age_hours"),
        *[n_if(_is("order_status", s)).alias(f"{s.lower()}_orders") for s in
          ("Pending", "Confirmed", "Shipped", "Delivered", "Cancelled")],
        n_if(_is("priority", "High")).alias("high_priority_orders"),
        n_if(_is("priority", "High") & breached).alias("high_priority_breached"),
        n_if(good & delivered).alias("on_time_deliveries"),
        average(F.when(finished, age)).alias("avg_time_to_ship"),
        average(F.when(delivered, age)).alias("avg_time_to_deliver"),
        F.sum("total_amount").alias("total_order_value"),
        F.coalesce(sum_if(C("total_amount"), breached), F.lit(0)).alias("breached_order_value"),
    )
    n, none = C("total_orders"), F.lit(0).cast("decimal(5,2)")
    rates = grouped.withColumns({
        "order_sla_compliance_pct": pct(C("order_sla_good"), n),
        "order_sla_at_risk_pct": pct(C("order_sla_at_risk"), n),
        "order_sla_breach_pct": pct(C("order_sla_breached"), n),
        "delay_rate_pct": pct(C("delayed_orders"), n),
        "high_priority_breach_rate": F.coalesce(
            pct(C("high_priority_breached"), C("high_priority_orders")), none),
        "completion_rate": pct(C("delivered_orders"), n),
        "cancellation_rate": pct(C("cancelled_orders"), n),
        "otdr_pct": F.coalesce(pct(C("on_time_deliveries"), C("delivered_orders")), none),
        "breach_financial_impact_pct": pct(C("breached_order_value"), C("total_order_value")),
    })
    score = (C("order_sla_compliance_pct") * 5 + C("otdr_pct") * 3
             + (F.lit(100) - C("cancellation_rate")) * 2) / 10
    return rates.withColumn("overall_performance_score", F.round(score, 2))


def sla_summary(daily: DataFrame, days_back: int = 7, *, as_of) -> DataFrame:
    """Service level per system over the last days of ``sla_daily``, with a grade."""
    recent = daily.filter(C("performance_date") >= F.date_sub(F.to_date(as_ts(as_of)), days_back))
    grouped = recent.groupBy("sap_system").agg(
        F.sum("total_orders").alias("total_orders"),
        average(C("order_sla_compliance_pct")).alias("avg_sla_compliance"),
        average(C("otdr_pct")).alias("avg_otdr"),
        average(C("overall_performance_score")).alias("avg_performance_score"),
        F.sum("order_sla_breached").alias("total_breached"),
        F.sum("order_sla_at_risk").alias("total_at_risk"),
        average(C("delay_rate_pct")).alias("avg_delay_rate"),
        average(C("completion_rate")).alias("avg_completion_rate"),
    )
    score = C("avg_performance_score")
    grade = (F.when(score >= 95, "Excellent").when(score >= 85, "Good").when(score >= 75, "Fair")
             .when(score >= 60, "Poor").otherwise("Critical"))
    return grouped.withColumn("performance_trend", grade)


def one_shipment_per_order(shipments: DataFrame) -> DataFrame:
    """Delivery facts per order. An order counts as delivered when all its shipments are.

    Carrier and status are those of the last shipment: one that is still open, else the one
    delivered last.
    """
    open_left = F.count_if(C("actual_delivery_date").isNull())
    last = F.struct(C("actual_delivery_date").isNull(), "actual_delivery_date",
                    "actual_ship_date", "carrier_name", "shipment_status")
    return shipments.groupBy("order_number").agg(
        F.count("*").alias("shipment_count"),
        F.min("actual_ship_date").alias("first_ship_date"),
        F.when(open_left == 0, F.max("actual_delivery_date")).alias("last_delivery_date"),
        F.max_by("carrier_name", last).alias("carrier_name"),
        F.max_by("shipment_status", last).alias("shipment_status"),
    )


def sla_per_order(orders: DataFrame, shipments: DataFrame, *, as_of, target_days: int = 1,
                  critical_value: int = 10000) -> DataFrame:
    """One row per order with cycle times, class by processing days and on-time flag.

    Shipments are reduced to one row per order first, so an order is never repeated.
    ``on_time_delivery`` stays null until the order is fully delivered.
    """
    facts = one_shipment_per_order(shipments).select(
        "order_number", "carrier_name", "last_delivery_date")
    joined = orders.drop("actual_delivery_date").join(facts, "order_number", "left")
    done = F.coalesce(C("actual_ship_date"), as_ts(as_of))
    days = F.datediff(done, "order_date")
    return joined.select(
        "order_number", "customer_id", "sap_system", "order_date", "requested_delivery_date",
        "promised_delivery_date", "actual_ship_date",
        C("last_delivery_date").alias("actual_delivery_date"),
        "order_status", "sla_status",
        days.alias("processing_days"),
        F.datediff("last_delivery_date", "order_date").alias("total_cycle_days"),
        F.lit(target_days).alias("sla_target_days"),
        ((days - target_days) * 24).alias("sla_variance_hours"),
        F.when(days <= target_days, "Good").when(days <= target_days + 1, "At Risk")
        .otherwise("Breached").alias("sla_compliance"),
        (C("last_delivery_date") <= C("promised_delivery_date")).alias("on_time_delivery"),
        ((C("sla_status") == "Breached") & (C("total_amount") > critical_value))
        .alias("is_critical"),
        "total_amount", "carrier_name",
    )


# ---------------------------------------------------------------- shipments

def in_transit(shipments: DataFrame) -> DataFrame:
    """Shipments on the way: flagged so, or shipped and not delivered."""
    return shipments.filter((C("shipment_status") == "In Transit")
                            | (C("actual_ship_date").isNotNull()
                               & C("actual_delivery_date").isNull()))


def transit_progress(shipments: DataFrame, *, as_of) -> DataFrame:
    """Shipments in transit with hours on the way, hours left, urgency and progress."""
    now = as_ts(as_of)
    elapsed = diff_boundary("hour", now, C("actual_ship_date"))
    left = diff_boundary("hour", C("planned_delivery_date"), now)
    planned = diff_boundary("hour", C("planned_delivery_date"), C("planned_ship_date"))
    return in_transit(shipments).select(
        "shipment_number", "tracking_number", "order_number", "carrier_id", "carrier_name",
        "service_level", "transport_mode", "origin_location", "origin_country",
        "destination_location", "destination_country", "actual_ship_date",
        "planned_delivery_date",
        elapsed.alias("current_transit_hours"),
        left.alias("hours_to_planned_delivery"),
        F.when(planned > 0, pct(elapsed, planned)).otherwise(F.lit(0).cast("decimal(5,2)"))
        .alias("transit_progress_pct"),
        "shipment_status",
        urgency(left).alias("urgency_level"),
        rank_of(URGENCY_RANK, urgency(left)).alias("urgency_rank"),
        "is_on_time", "total_packages", "total_weight_kg", "total_volume_m3",
        F.to_date("actual_ship_date").alias("ship_day"),
        F.to_date("planned_delivery_date").alias("expected_delivery_day"),
        "sap_system",
    )


def transit_delays(shipments: DataFrame, *, as_of, high_value: int = 10000,
                   medium_value: int = 5000) -> DataFrame:
    """Shipments in transit with days on the way, delay class and value-based priority."""
    now = as_ts(as_of)
    left = F.datediff("planned_delivery_date", now)
    delay = (F.when(left > 2, "On Track").when(left >= 0, "At Risk").when(left < 0, "Delayed")
             .otherwise("Unknown"))
    priority = (F.when((left < 0) & (C("shipment_value") > high_value), "High")
                .when(left.between(0, 2) & (C("shipment_value") > medium_value), "Medium")
                .otherwise("Normal"))
    return in_transit(shipments).select(
        "shipment_number", "order_number", "customer_id", "sap_system", "origin_country",
        "destination_country", "carrier_name", "planned_ship_date", "actual_ship_date",
        "planned_delivery_date", "shipment_status",
        F.datediff(now, "actual_ship_date").alias("days_in_transit"),
        left.alias("days_until_planned_delivery"),
        C("planned_delivery_date").alias("eta_date"),
        delay.alias("delay_status"),
        F.greatest(-left, F.lit(0)).alias("days_delayed"),
        priority.alias("priority"),
        rank_of(PRIORITY_RANK, priority).alias("priority_rank"),
        "shipment_value",
    )


def transit_by_day(shipments: DataFrame, *, as_of) -> DataFrame:
    """Shipments in transit per ship day and system: load, hours on the way, delays, spread."""
    overdue = C("planned_delivery_date") < as_ts(as_of)
    hours = diff_boundary("hour", as_ts(as_of), C("actual_ship_date"))
    return in_transit(shipments).groupBy(F.to_date("actual_ship_date").alias("ship_day"),
                                         "sap_system").agg(
        F.count("*").alias("total_shipments"),
        F.sum("total_weight_kg").alias("total_weight_kg"),
        average(hours).alias("avg_transit_hours"),
        F.max(hours).alias("max_transit_hours"),
        n_if(overdue).alias("delayed_shipments"),
        n_if(~overdue).alias("on_time_shipments"),
        F.count_distinct(C("carrier_id")).alias("unique_carriers"),
        F.count_distinct(C("origin_country")).alias("unique_origins"),
        F.count_distinct(C("destination_country")).alias("unique_destinations"),
    )


def transit_by_carrier(shipments: DataFrame, *, as_of) -> DataFrame:
    """Active shipments per carrier and destination country."""
    today = F.to_date(as_ts(as_of))
    due = F.to_date("planned_delivery_date")
    return in_transit(shipments).groupBy("carrier_id", "destination_country").agg(
        F.count("*").alias("active_shipments"),
        n_if(due == today).alias("arriving_today"),
        n_if(due < today).alias("delayed_shipments"),
        average(F.datediff("planned_delivery_date", "actual_ship_date"))
        .alias("avg_planned_transit_days"),
    )


def shipments_by_day(shipments: DataFrame) -> DataFrame:
    """Shipments per ship day, customer and carrier."""
    return shipments.groupBy(F.to_date("actual_ship_date").alias("ship_day"), "customer_id",
                             "carrier_id").agg(
        F.count("*").alias("shipment_count"),
        F.sum("shipment_value").alias("total_value"),
        n_if(C("is_on_time")).alias("on_time_count"))


# ---------------------------------------------------------------- warehouse

def warehouse_mix(moves: DataFrame, *, approx: bool = False) -> DataFrame:
    """Movements per day, warehouse and system: type mix, quality, people, hours."""
    label = movement_label(C("movement_type"))
    kinds = {"receipts": "Receipt", "pickings": "Picking", "shippings": "Shipping",
             "transfers": "Transfer", "returns": "Return"}
    grouped = moves.groupBy(F.to_date("movement_timestamp").alias("movement_day"),
                            "warehouse_id", "sap_system").agg(
        F.count("*").alias("total_movements"),
        F.sum("quantity").alias("total_quantity_moved"),
        F.sum("weight_kg").alias("total_weight_kg"),
        F.sum("volume_m3").alias("total_volume_m3"),
        *[n_if(label == v).alias(k) for k, v in kinds.items()],
        n_if(C("inspection_required")).alias("movements_requiring_inspection"),
        n_if(C("exception_flag")).alias("exception_movements"),
        average(C("processing_time_minutes")).alias("avg_processing_time_minutes"),
        F.min("processing_time_minutes").alias("min_processing_time"),
        F.max("processing_time_minutes").alias("max_processing_time"),
        distinct("operator_id", approx).alias("unique_operators"),
        distinct("equipment_id", approx).alias("unique_equipment"),
        distinct("zone", approx).alias("unique_zones"),
        distinct("material_id", approx).alias("unique_materials"),
        F.min("movement_timestamp").alias("first_movement"),
        F.max("movement_timestamp").alias("last_movement"),
        *[n_if(_is("quality_status", s)).alias(f"quality_{s.lower()}")
          for s in ("OK", "Hold", "Rejected")],
    )
    n = C("total_movements")
    return grouped.withColumns({
        "exception_rate_pct": pct(C("exception_movements"), n),
        "movements_per_operator": ratio(n, C("unique_operators")),
        "quantity_per_operator": ratio(C("total_quantity_moved"), C("unique_operators")),
        "movements_per_hour": ratio(n, F.lit(24)),
        "quality_pass_rate": pct(C("quality_ok"), n),
        "inspection_rate": pct(C("movements_requiring_inspection"), n),
        "receipt_pct": pct(C("receipts"), n),
        "picking_pct": pct(C("pickings"), n),
        "shipping_pct": pct(C("shippings"), n),
        "transfer_pct": pct(C("transfers"), n),
        "return_pct": pct(C("returns"), n),
        "operational_hours": diff_boundary("hour", C("last_movement"), C("first_movement")),
    })


def warehouse_productivity(moves: DataFrame, *, shift_hours: int = 8, target: int = 100,
                           approx: bool = False) -> DataFrame:
    """Movements per day, warehouse, type and system against an hourly quantity target."""
    n, qty = F.count("*"), F.sum("quantity")
    exceptions = n_if(C("exception_flag"))
    grouped = moves.groupBy(F.to_date("movement_timestamp").alias("movement_day"),
                            "warehouse_id", "movement_type", "sap_system").agg(
        n.alias("total_movements"),
        qty.alias("total_quantity"),
        distinct("material_id", approx).alias("unique_materials"),
        distinct("operator_id", approx).alias("unique_operators"),
        distinct("location_code", approx).alias("unique_locations"),
        average(C("processing_time_minutes")).alias("avg_processing_time_min"),
        average(C("quantity")).alias("avg_quantity_per_movement"),
        exceptions.alias("exception_count"),
        *[n_if(_is("exception_type", t)).alias(f"{t.lower()}_count")
          for t in ("Damage", "Shortage", "Quality")],
        pct(exceptions, n).alias("exception_rate_pct"),
        ratio(n, F.lit(shift_hours)).alias("movements_per_hour"),
        ratio(qty, F.lit(shift_hours)).alias("quantity_per_hour"),
    )
    wanted = F.lit(target * shift_hours)
    variance = pct(C("total_quantity") - wanted, wanted, 6)
    band = (F.when(variance >= 10, "Exceeding").when(variance >= 0, "Meeting")
            .when(variance >= -10, "Near Target").otherwise("Below Target"))
    return grouped.withColumns({
        "productivity_target": F.lit(target),
        "productivity_variance_pct": pct(C("total_quantity") - wanted, wanted),
        "performance_status": band,
        "movements_per_operator": ratio(C("total_movements"), C("unique_operators")),
    })


def warehouse_throughput(moves: DataFrame) -> DataFrame:
    """Movements per day and system over all warehouses."""
    return moves.groupBy(F.to_date("movement_timestamp").alias("movement_day"),
                         "sap_system").agg(
        F.count("*").alias("total_movements"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("weight_kg").alias("total_weight_kg"),
        average(C("processing_time_minutes")).alias("avg_processing_minutes"),
        F.max("processing_time_minutes").alias("max_processing_minutes"),
        n_if(C("exception_flag")).alias("exception_count"),
        n_if(C("inspection_required")).alias("inspection_required_count"),
        F.count_distinct(C("operator_id")).alias("unique_operators"),
        F.count_distinct(C("material_id")).alias("unique_materials"),
        F.count_distinct(C("warehouse_id")).alias("unique_warehouses"),
        n_if(_is("movement_type", "GR")).alias("inbound_movements"),
        n_if(_is("movement_type", "GI")).alias("outbound_movements"),
    )


def warehouse_labour(moves: DataFrame) -> DataFrame:
    """Movements per day and warehouse with labour hours and movements per labour hour."""
    minutes = F.sum("processing_time_minutes")
    return moves.groupBy(F.to_date("movement_timestamp").alias("movement_day"),
                         "warehouse_id").agg(
        F.count("*").alias("total_movements"),
        F.sum("quantity").alias("total_quantity"),
        ratio(minutes, F.lit(60)).alias("labour_hours"),
        ratio(F.count("*") * 60, minutes).alias("movements_per_labour_hour"),
        n_if(C("exception_flag")).alias("exceptions"),
    )


# ---------------------------------------------------------------- revenue

def _aging(buckets: dict[str, str], value: Column | None) -> list[Column]:
    if value is None:
        return [n_if(_is("aging_bucket", b)).alias(k) for k, b in buckets.items()]
    return [F.coalesce(sum_if(value, _is("aging_bucket", b)), F.lit(0)).alias(k)
            for k, b in buckets.items()]


AGING_COLUMNS = {"aging_current": "Current", "aging_1_30": "1-30", "aging_31_60": "31-60",
                 "aging_61_90": "61-90", "aging_90_plus": "90+"}


def revenue_daily(invoices: DataFrame, *, approx: bool = False) -> DataFrame:
    """Invoices per day, fiscal period and system: revenue, mix, aging counts, collection."""
    kinds = {"standard": "Standard", "credit": "Credit", "debit": "Debit",
             "proforma": "Pro-forma"}
    counts = {"current_invoices" if k == "aging_current" else k: b
              for k, b in AGING_COLUMNS.items()}
    grain = [F.to_date("invoice_date").alias("invoice_day"), "fiscal_year", "fiscal_period",
             "sap_system"]
    grouped = invoices.groupBy(*grain).agg(
        F.count("*").alias("total_invoices"),
        F.sum("total_amount").alias("total_revenue"),
        F.sum("subtotal_amount").alias("total_subtotal"),
        F.sum("tax_amount").alias("total_tax"),
        F.sum("discount_amount").alias("total_discounts"),
        average(C("total_amount")).alias("avg_invoice_amount"),
        F.sum("amount_due").alias("total_amount_due"),
        F.sum("amount_paid").alias("total_amount_paid"),
        *[n_if(_is("invoice_type", v)).alias(f"{k}_invoices") for k, v in kinds.items()],
        *[n_if(_is("payment_status", s)).alias(f"{s.lower()}_invoices")
          for s in ("Paid", "Pending", "Partial", "Overdue")],
        *_aging(counts, None),
        distinct("customer_id", approx).alias("unique_customers"),
        n_if(C("is_disputed")).alias("disputed_invoices"),
        F.coalesce(sum_if(C("total_amount"), C("is_disputed")), F.lit(0))
        .alias("disputed_amount"),
        average(C("payment_efficiency")).alias("avg_payment_efficiency"),
        average(C("gross_margin_pct")).alias("avg_gross_margin_pct"),
        average(F.when(_is("payment_status", "Paid"), C("days_overdue")))
        .alias("avg_days_to_payment"),
        F.sort_array(F.collect_set("currency")).alias("currencies_used"),
    )
    n, revenue = C("total_invoices"), C("total_revenue")
    shares = {"current_pct": "current_invoices", "aging_1_30_pct": "aging_1_30",
              "aging_31_60_pct": "aging_31_60", "aging_61_90_pct": "aging_61_90",
              "aging_90_plus_pct": "aging_90_plus", "paid_rate": "paid_invoices",
              "pending_rate": "pending_invoices", "overdue_rate": "overdue_invoices",
              "dispute_rate": "disputed_invoices"}
    return grouped.withColumns({
        **{k: pct(C(v), n) for k, v in shares.items()},
        "collection_rate": pct(C("total_amount_paid"),
                               C("total_amount_paid") + C("total_amount_due")),
        "revenue_per_customer": ratio(revenue, C("unique_customers")),
        "effective_tax_rate": pct(C("total_tax"), C("total_subtotal")),
        "discount_rate": pct(C("total_discounts"), C("total_subtotal")),
        "dso_days": ratio(C("total_amount_due"), revenue, factor=30),
    })


def revenue_by_service(invoices: DataFrame) -> DataFrame:
    """Revenue per day and system as a map from service type to amount, in two stages."""
    day = F.to_date("invoice_date").alias("invoice_day")
    per_service = invoices.groupBy(day, "sap_system", "service_type").agg(
        F.sum("total_amount").alias("revenue"))
    entries = F.sort_array(F.collect_list(F.struct("service_type", "revenue")))
    return per_service.groupBy("invoice_day", "sap_system").agg(
        F.map_from_entries(entries).alias("revenue_by_service"))


def revenue_recognition(invoices: DataFrame, *, dso_target: int = 30, high_risk: int = 20,
                        medium_risk: int = 10) -> DataFrame:
    """Invoices per day, customer and system: aging amounts, days to pay, collection risk."""
    n, revenue, paid = F.count("*"), F.sum("total_amount"), F.sum("amount_paid")
    days = average(F.datediff("payment_date", "invoice_date"))
    grouped = invoices.groupBy(F.to_date("invoice_date").alias("invoice_day"), "customer_id",
                               "sap_system").agg(
        n.alias("total_invoices"),
        F.count_distinct(C("invoice_number")).alias("unique_invoices"),
        revenue.alias("total_revenue"),
        paid.alias("total_paid"),
        F.sum("amount_due").alias("total_due"),
        *[n_if(_is("payment_status", s)).alias(f"{s.lower()}_invoices")
          for s in ("Pending", "Partial", "Paid", "Overdue")],
        *_aging(AGING_COLUMNS, C("amount_due")),
        days.alias("avg_days_to_payment"),
        average(C("total_amount")).alias("avg_invoice_value"),
        F.coalesce(pct(paid, revenue), F.lit(0)).alias("collection_efficiency_pct"),
        pct(n_if(_is("payment_status", "Paid")), n).alias("payment_rate_pct"),
        pct(n_if(_is("payment_status", "Overdue")), n).alias("overdue_rate_pct"),
    )
    rate = C("overdue_rate_pct")
    return grouped.withColumns({
        "dso_target_days": F.lit(dso_target),
        "dso_variance_days": C("avg_days_to_payment") - dso_target,
        "collection_risk": F.when(rate > high_risk, "High").when(rate > medium_risk, "Medium")
        .otherwise("Low"),
        "total_outstanding": C("total_due"),
        **{f"{k}_pct": F.when(C("total_due") > 0, pct(C(k), C("total_due"))).otherwise(F.lit(0))
           for k in ("aging_current", "aging_90_plus")},
    })


def revenue_by_month(invoices: DataFrame) -> DataFrame:
    """Invoices per month and customer with the outstanding amount per aging bucket."""
    return invoices.groupBy(F.date_format("invoice_date", "yyyy-MM").alias("invoice_month"),
                            "customer_id").agg(
        F.count("*").alias("invoice_count"),
        F.sum("total_amount").alias("total_revenue"),
        F.sum("amount_due").alias("outstanding"),
        *_aging(AGING_COLUMNS, C("amount_due")),
    )


def revenue_paid_and_due(invoices: DataFrame) -> DataFrame:
    """Revenue per day and system split by whether the invoice is paid."""
    paid = _is("payment_status", "Paid")
    zero = F.lit(0)
    return invoices.groupBy(F.to_date("invoice_date").alias("invoice_day"), "sap_system").agg(
        F.count("*").alias("total_invoices"),
        F.sum("total_amount").alias("total_revenue"),
        F.coalesce(sum_if(C("total_amount"), paid), zero).alias("total_paid"),
        F.coalesce(sum_if(C("total_amount"), ~paid), zero).alias("total_due"),
        average(C("total_amount")).alias("avg_invoice_amount"),
        F.max("total_amount").alias("max_invoice_amount"),
        *[n_if(_is("payment_status", s)).alias(f"{s.lower()}_invoices")
          for s in ("Overdue", "Paid", "Pending")],
        n_if(C("is_disputed")).alias("disputed_invoices"),
        F.count_distinct(C("customer_id")).alias("unique_customers"),
        average(C("payment_efficiency")).alias("avg_payment_efficiency"),
    )
