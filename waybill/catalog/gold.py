"""Registered daily KPI tables, reports and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.catalog.base import query
from waybill.catalog.views_sql import NOW, avg, money, pct, rnd, total
from waybill.plans import gold

DAY = "CAST(CAST({0} AS DATE) AS VARCHAR)"
ORDER_DAY = DAY.format("order_date")


def cnt(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def stat(s: str) -> str:
    return cnt(f"order_status = '{s}'")


STATUS_COUNTS = ", ".join(f"{stat(s)} AS {s.lower()}_orders" for s in
                          ("Pending", "Confirmed", "Shipped", "Delivered", "Cancelled"))


@query("gld_1_orders_daily", views="g_orders_lines", sql=f"""
SELECT {ORDER_DAY} AS order_day, sap_system, count(*) AS total_orders,
  {total('total_c')} AS total_order_value, {avg('total_c', cents=2)} AS avg_order_value,
  sum(total_lines)::BIGINT AS total_lines, sum(total_quantity)::DOUBLE AS total_quantity,
  sum(total_weight_kg)::DOUBLE AS total_weight_kg,
  count(DISTINCT customer_id) AS unique_customers, {STATUS_COUNTS},
  {cnt("sla_status = 'Good'")} AS sla_good, {cnt("sla_status = 'At Risk'")} AS sla_at_risk,
  {cnt("sla_status = 'Breached'")} AS sla_breached, {cnt('is_delayed')} AS delayed_orders,
  {avg('order_age_hours')} AS avg_order_age_hours,
  {cnt("priority = 'High'")} AS high_priority, {cnt("priority = 'Medium'")} AS medium_priority,
  {cnt("priority = 'Low'")} AS low_priority,
  min(order_date)::VARCHAR AS first_order_time, max(order_date)::VARCHAR AS last_order_time,
  string_agg(DISTINCT currency, ',' ORDER BY currency) AS currencies_used,
  {pct(cnt("sla_status = 'Good'"), 'count(*)')} AS sla_compliance_pct,
  {rnd('sum(total_lines)', 'count(*)')} AS avg_lines_per_order,
  {rnd('sum(total_quantity)', 'count(*)')} AS avg_quantity_per_order,
  {rnd('sum(total_weight_kg)', 'count(*)')} AS avg_weight_per_order,
  {pct(stat('Delivered'), 'count(*)')} AS order_completion_rate,
  {pct(stat('Cancelled'), 'count(*)')} AS order_cancellation_rate,
  {rnd('count(*)', '24')} AS order_velocity_per_hour
FROM g_orders_lines GROUP BY ALL""")
def _(t):
    df = gold.orders_daily(t.gold_orders_with_lines)
    return df.withColumn("currencies_used", F.array_join("currencies_used", ","))


BY_SLA = f"""count(*) AS total_orders, {stat('Delivered')} AS delivered_orders,
  {stat('Cancelled')} AS cancelled_orders, {total('total_c')} AS total_revenue,
  {avg('total_c', cents=2)} AS avg_order_value, {money('min(total_amount)')} AS min_order_value,
  {money('max(total_amount)')} AS max_order_value,
  {avg("date_diff('day', order_date, actual_ship_date)")} AS avg_days_to_ship,
  {avg("date_diff('day', order_date, actual_delivery_date)")} AS avg_days_to_delivery,
  {cnt("sla_status = 'Good'")} AS sla_good_count,
  {cnt("sla_status = 'At Risk'")} AS sla_at_risk_count,
  {cnt("sla_status = 'Breached'")} AS sla_breached_count,
  {pct(cnt("sla_status = 'Good'"), 'count(*)')} AS sla_compliance_pct,
  {pct(stat('Delivered'), 'count(*)')} AS delivery_rate_pct"""


@query("gld_2_orders_by_sla", views="g_orders", sql=f"""
SELECT {ORDER_DAY} AS order_day, sap_system, sla_status, {BY_SLA}
FROM g_orders GROUP BY ALL""")
def _(t):
    return gold.orders_by_sla(t.gold_order_facts)


@query("gld_2_orders_by_scope", views="g_orders", sql=f"""
SELECT {ORDER_DAY} AS order_day, sap_system, sla_status, partner_access_scope, {BY_SLA}
FROM g_orders GROUP BY ALL""")
def _(t):
    return gold.orders_by_sla(t.gold_order_facts, ("sap_system", "sla_status", "partner_access_scope"))


@query("gld_3_orders_lab", views="g_orders", sql=f"""
SELECT {ORDER_DAY} AS order_day, sap_system, sla_status, {BY_SLA},
  {stat('Shipped')} AS shipped_orders, {stat('Pending')} AS pending_orders,
  {pct(stat('Pending'), 'count(*)')} AS pending_rate_pct
FROM g_orders GROUP BY ALL""")
def _(t):
    return gold.orders_by_sla(t.gold_order_facts, shipped_and_pending=True)


@query("gld_4_orders_by_customer", views="g_orders", sql=f"""
SELECT {ORDER_DAY} AS order_day, sap_system, sla_status, customer_id, customer_name, {BY_SLA}
FROM g_orders GROUP BY ALL""")
def _(t):
    return gold.orders_by_sla(
        t.gold_orders, ("sap_system", "sla_status", "customer_id", "customer_name"))


GOOD_DELIVERED = cnt("sla_status = 'Good' AND order_status = 'Delivered'")
HIGH = cnt("priority = 'High'")
HIGH_BREACHED = cnt("priority = 'High' AND sla_status = 'Breached'")
BREACHED_C = "coalesce(sum(total_c) FILTER (WHERE sla_status = 'Breached'), 0)"

SLA_DAILY = f"""
SELECT *, {rnd('(round(order_sla_compliance_pct * 100)::BIGINT * 5 + round(otdr_pct * 100)::BIGINT * 3 + (10000 - round(cancellation_rate * 100)::BIGINT) * 2)', '10', cents=2)}
  AS overall_performance_score FROM (
SELECT {ORDER_DAY} AS performance_date, sap_system, count(*) AS total_orders,
  {cnt("sla_status = 'Good'")} AS order_sla_good,
  {cnt("sla_status = 'At Risk'")} AS order_sla_at_risk,
  {cnt("sla_status = 'Breached'")} AS order_sla_breached, {cnt('is_delayed')} AS delayed_orders,
  {avg('order_age_hours')} AS avg_order_age_hours, {STATUS_COUNTS},
  {HIGH} AS high_priority_orders, {HIGH_BREACHED} AS high_priority_breached,
  {GOOD_DELIVERED} AS on_time_deliveries,
  {avg("CASE WHEN order_status IN ('Shipped', 'Delivered') THEN order_age_hours END")}
    AS avg_time_to_ship,
  {avg("CASE WHEN order_status = 'Delivered' THEN order_age_hours END")} AS avg_time_to_deliver,
  {total('total_c')} AS total_order_value, {BREACHED_C}::DOUBLE / 100 AS breached_order_value,
  {pct(cnt("sla_status = 'Good'"), 'count(*)')} AS order_sla_compliance_pct,
  {pct(cnt("sla_status = 'At Risk'"), 'count(*)')} AS order_sla_at_risk_pct,
  {pct(cnt("sla_status = 'Breached'"), 'count(*)')} AS order_sla_breach_pct,
  {pct(cnt('is_delayed'), 'count(*)')} AS delay_rate_pct,
  coalesce({pct(HIGH_BREACHED, HIGH)}, 0.0::DOUBLE) AS high_priority_breach_rate,
  {pct(stat('Delivered'), 'count(*)')} AS completion_rate,
  {pct(stat('Cancelled'), 'count(*)')} AS cancellation_rate,
  coalesce({pct(GOOD_DELIVERED, stat('Delivered'))}, 0.0::DOUBLE) AS otdr_pct,
  {pct(BREACHED_C, 'sum(total_c)')} AS breach_financial_impact_pct
FROM g_orders GROUP BY ALL)"""


@query("gld_5_sla_daily", views="g_orders", sql=SLA_DAILY)
def _(t):
    return gold.sla_daily(t.gold_order_facts)


@query("gld_5_sla_daily_half_day", views="h_orders",
       sql=SLA_DAILY.replace("FROM g_orders", "FROM h_orders"))
def _(t):
    return gold.sla_daily(t.half_day_order_facts)


def avg_h(column: str) -> str:
    """Mean of a two-digit percentage."""
    return avg(f"round({column} * 100)::BIGINT", cents=2)


@query("gld_6_sla_summary", views="g_orders", sql=f"""
WITH daily AS ({SLA_DAILY})
SELECT *, CASE WHEN avg_performance_score >= 95 THEN 'Excellent'
  WHEN avg_performance_score >= 85 THEN 'Good' WHEN avg_performance_score >= 75 THEN 'Fair'
  WHEN avg_performance_score >= 60 THEN 'Poor' ELSE 'Critical' END AS performance_trend
FROM (SELECT sap_system, sum(total_orders)::BIGINT AS total_orders,
  {avg_h('order_sla_compliance_pct')} AS avg_sla_compliance, {avg_h('otdr_pct')} AS avg_otdr,
  {avg_h('overall_performance_score')} AS avg_performance_score,
  sum(order_sla_breached)::BIGINT AS total_breached,
  sum(order_sla_at_risk)::BIGINT AS total_at_risk, {avg_h('delay_rate_pct')} AS avg_delay_rate,
  {avg_h('completion_rate')} AS avg_completion_rate
FROM daily WHERE performance_date::DATE >= CAST({NOW} AS DATE) - 365 GROUP BY sap_system)""")
def _(t):
    return gold.sla_summary(gold.sla_daily(t.gold_order_facts), 365, as_of=t.as_of)


PER_ORDER = f"""
SELECT order_number, customer_id, sap_system, order_date::VARCHAR AS order_date,
  requested_delivery_date::VARCHAR AS requested_delivery_date,
  promised_delivery_date::VARCHAR AS promised_delivery_date,
  actual_ship_date::VARCHAR AS actual_ship_date, last_delivery::VARCHAR AS actual_delivery_date,
  order_status, sla_status, days AS processing_days,
  date_diff('day', order_date, last_delivery) AS total_cycle_days, 1 AS sla_target_days,
  (days - 1) * 24 AS sla_variance_hours,
  CASE WHEN days <= 1 THEN 'Good' WHEN days <= 2 THEN 'At Risk' ELSE 'Breached' END
    AS sla_compliance,
  last_delivery <= promised_delivery_date AS on_time_delivery,
  sla_status = 'Breached' AND total_amount > 10000 AS is_critical,
  {money('total_amount')} AS total_amount, carrier_name
FROM (SELECT o.*, s.carrier_name, s.last_delivery,
        date_diff('day', order_date, coalesce(actual_ship_date, {NOW})) AS days
      FROM g_orders o LEFT JOIN (
        SELECT order_number AS k, max_by(carrier_name, (actual_delivery_date IS NULL)::VARCHAR
            || coalesce(actual_delivery_date::VARCHAR, '') || coalesce(actual_ship_date::VARCHAR, '')
            || ' ' || carrier_name) AS carrier_name,
          CASE WHEN count(*) = count(actual_delivery_date) THEN max(actual_delivery_date) END
            AS last_delivery FROM s_shipments GROUP BY 1) s ON o.order_number = s.k)"""


@query("gld_7_sla_per_order", views="g_orders s_shipments", sql=PER_ORDER)
def _(t):
    return gold.sla_per_order(t.gold_order_facts, t.shipments, as_of=t.as_of)


TRANSIT = "(shipment_status = 'In Transit' OR (actual_ship_date IS NOT NULL AND " \
          "actual_delivery_date IS NULL))"
URGENCY = """CASE WHEN hours_left < 0 THEN 'Overdue' WHEN hours_left <= 24 THEN 'Critical'
  WHEN hours_left <= 48 THEN 'High' WHEN hours_left <= 72 THEN 'Medium' ELSE 'Normal' END"""


@query("gld_8_transit_progress", views="s_shipments", sql=f"""
SELECT shipment_number, tracking_number, order_number, carrier_id, carrier_name, service_level,
  transport_mode, origin_location, destination_location, total_packages,
  litres::DOUBLE / 1000 AS total_volume_m3,
  origin_country, destination_country, actual_ship_date::VARCHAR AS actual_ship_date,
  planned_delivery_date::VARCHAR AS planned_delivery_date, elapsed AS current_transit_hours,
  hours_left AS hours_to_planned_delivery,
  CASE WHEN planned > 0 THEN {pct('elapsed', 'planned')} ELSE 0 END AS transit_progress_pct,
  shipment_status, {URGENCY} AS urgency_level,
  CASE WHEN hours_left < 0 THEN 0 WHEN hours_left <= 24 THEN 1 WHEN hours_left <= 48 THEN 2
    WHEN hours_left <= 72 THEN 3 ELSE 4 END AS urgency_rank,
  is_on_time, total_weight_kg::DOUBLE AS total_weight_kg,
  {DAY.format('actual_ship_date')} AS ship_day,
  {DAY.format('planned_delivery_date')} AS expected_delivery_day, sap_system
FROM (SELECT *, date_diff('hour', actual_ship_date, {NOW}) AS elapsed,
        date_diff('hour', {NOW}, planned_delivery_date) AS hours_left,
        date_diff('hour', planned_ship_date, planned_delivery_date) AS planned
      FROM s_shipments WHERE {TRANSIT})""")
def _(t):
    return gold.transit_progress(t.measured_shipments, as_of=t.as_of)


DELAYS = f"""
SELECT shipment_number, order_number, customer_id, sap_system, origin_country,
  destination_country, carrier_name, planned_ship_date::VARCHAR AS planned_ship_date,
  actual_ship_date::VARCHAR AS actual_ship_date,
  planned_delivery_date::VARCHAR AS planned_delivery_date, shipment_status,
  date_diff('day', actual_ship_date, {NOW}) AS days_in_transit,
  days_left AS days_until_planned_delivery, planned_delivery_date::VARCHAR AS eta_date,
  CASE WHEN days_left > 2 THEN 'On Track' WHEN days_left >= 0 THEN 'At Risk'
    WHEN days_left < 0 THEN 'Delayed' ELSE 'Unknown' END AS delay_status,
  greatest(-days_left, 0) AS days_delayed,
  CASE WHEN days_left < 0 AND shipment_value > 10000 THEN 'High'
    WHEN days_left BETWEEN 0 AND 2 AND shipment_value > 5000 THEN 'Medium' ELSE 'Normal' END
    AS priority,
  CASE WHEN days_left < 0 AND shipment_value > 10000 THEN 1
    WHEN days_left BETWEEN 0 AND 2 AND shipment_value > 5000 THEN 2 ELSE 3 END AS priority_rank,
  {money('shipment_value')} AS shipment_value
FROM (SELECT *, date_diff('day', {NOW}, planned_delivery_date) AS days_left
      FROM s_shipments WHERE {TRANSIT})"""


@query("gld_9_transit_delays", views="s_shipments", sql=DELAYS)
def _(t):
    return gold.transit_delays(t.shipments, as_of=t.as_of)


@query("gld_10_transit_by_day", views="s_shipments", sql=f"""
SELECT {DAY.format('actual_ship_date')} AS ship_day, sap_system, count(*) AS total_shipments,
  sum(total_weight_kg)::DOUBLE AS total_weight_kg,
  {avg(f"date_diff('hour', actual_ship_date, {NOW})")} AS avg_transit_hours,
  max(date_diff('hour', actual_ship_date, {NOW})) AS max_transit_hours,
  {cnt(f'planned_delivery_date < {NOW}')} AS delayed_shipments,
  {cnt(f'planned_delivery_date >= {NOW}')} AS on_time_shipments,
  count(DISTINCT carrier_id) AS unique_carriers,
  count(DISTINCT origin_country) AS unique_origins,
  count(DISTINCT destination_country) AS unique_destinations
FROM s_shipments WHERE {TRANSIT} GROUP BY ALL""")
def _(t):
    return gold.transit_by_day(t.shipments, as_of=t.as_of)


@query("gld_11_transit_by_carrier", views="s_shipments", sql=f"""
SELECT carrier_id, destination_country, count(*) AS active_shipments,
  {cnt(f'planned_delivery_date::DATE = {NOW}::DATE')} AS arriving_today,
  {cnt(f'planned_delivery_date::DATE < {NOW}::DATE')} AS delayed_shipments,
  {avg("date_diff('day', actual_ship_date, planned_delivery_date)")} AS avg_planned_transit_days
FROM s_shipments WHERE {TRANSIT} GROUP BY ALL""")
def _(t):
    return gold.transit_by_carrier(t.shipments, as_of=t.as_of)


def kind(*codes: str) -> str:
    return cnt("movement_type IN (" + ", ".join(f"'{c}'" for c in codes) + ")")


MOVE_DAY = DAY.format("movement_timestamp")


@query("gld_12_warehouse_mix", views="s_warehouse", sql=f"""
SELECT {MOVE_DAY} AS movement_day, warehouse_id, sap_system, count(*) AS total_movements,
  sum(quantity)::DOUBLE AS total_quantity_moved, sum(weight_kg)::DOUBLE AS total_weight_kg,
  sum(litres)::DOUBLE / 1000 AS total_volume_m3,
  {kind('GR')} AS receipts, {kind('PI')} AS pickings, {kind('GI')} AS shippings,
  {kind('TR')} AS transfers, {kind('RT')} AS returns,
  {cnt('inspection_required')} AS movements_requiring_inspection,
  {cnt('exception_flag')} AS exception_movements,
  {avg('processing_time_minutes')} AS avg_processing_time_minutes,
  min(processing_time_minutes) AS min_processing_time,
  max(processing_time_minutes) AS max_processing_time,
  count(DISTINCT operator_id) AS unique_operators,
  count(DISTINCT equipment_id) AS unique_equipment, count(DISTINCT zone) AS unique_zones,
  count(DISTINCT material_id) AS unique_materials,
  min(movement_timestamp)::VARCHAR AS first_movement,
  max(movement_timestamp)::VARCHAR AS last_movement,
  {cnt("quality_status = 'OK'")} AS quality_ok, {cnt("quality_status = 'Hold'")} AS quality_hold,
  {cnt("quality_status = 'Rejected'")} AS quality_rejected,
  {pct(cnt('exception_flag'), 'count(*)')} AS exception_rate_pct,
  {rnd('count(*)', 'count(DISTINCT operator_id)')} AS movements_per_operator,
  {rnd('sum(quantity)', 'count(DISTINCT operator_id)')} AS quantity_per_operator,
  {rnd('count(*)', '24')} AS movements_per_hour,
  {pct(cnt("quality_status = 'OK'"), 'count(*)')} AS quality_pass_rate,
  {pct(cnt('inspection_required'), 'count(*)')} AS inspection_rate,
  {pct(kind('GR'), 'count(*)')} AS receipt_pct, {pct(kind('PI'), 'count(*)')} AS picking_pct,
  {pct(kind('GI'), 'count(*)')} AS shipping_pct, {pct(kind('TR'), 'count(*)')} AS transfer_pct,
  {pct(kind('RT'), 'count(*)')} AS return_pct,
  date_diff('hour', min(movement_timestamp), max(movement_timestamp)) AS operational_hours
FROM s_warehouse GROUP BY ALL""")
def _(t):
    return gold.warehouse_mix(t.measured_warehouse)


WH_VARIANCE = "((sum(quantity) - 800) * 100.0 / 800)"
WH_DAILY = f"""
SELECT {MOVE_DAY} AS movement_day, warehouse_id, movement_type, sap_system,
  count(*) AS total_movements, sum(quantity)::DOUBLE AS total_quantity,
  count(DISTINCT material_id) AS unique_materials,
  count(DISTINCT operator_id) AS unique_operators,
  count(DISTINCT location_code) AS unique_locations,
  {avg('processing_time_minutes')} AS avg_processing_time_min,
  {avg('quantity')} AS avg_quantity_per_movement, {cnt('exception_flag')} AS exception_count,
  {cnt("exception_type = 'Damage'")} AS damage_count,
  {cnt("exception_type = 'Shortage'")} AS shortage_count,
  {cnt("exception_type = 'Quality'")} AS quality_count,
  {pct(cnt('exception_flag'), 'count(*)')} AS exception_rate_pct,
  {rnd('count(*)', '8')} AS movements_per_hour, {rnd('sum(quantity)', '8')} AS quantity_per_hour,
  100 AS productivity_target, {pct('sum(quantity) - 800', '800')} AS productivity_variance_pct,
  CASE WHEN {WH_VARIANCE} >= 10 THEN 'Exceeding' WHEN {WH_VARIANCE} >= 0 THEN 'Meeting'
    WHEN {WH_VARIANCE} >= -10 THEN 'Near Target' ELSE 'Below Target' END AS performance_status,
  {rnd('count(*)', 'count(DISTINCT operator_id)')} AS movements_per_operator
FROM s_warehouse GROUP BY ALL"""


@query("gld_13_warehouse_productivity", views="s_warehouse", sql=WH_DAILY)
def _(t):
    return gold.warehouse_productivity(t.warehouse)


@query("gld_14_warehouse_labour", views="s_warehouse", sql=f"""
SELECT {MOVE_DAY} AS movement_day, warehouse_id, count(*) AS total_movements,
  sum(quantity)::DOUBLE AS total_quantity,
  {rnd('sum(processing_time_minutes)', '60')} AS labour_hours,
  {rnd('count(*) * 60', 'sum(processing_time_minutes)')} AS movements_per_labour_hour,
  {cnt('exception_flag')} AS exceptions
FROM s_warehouse GROUP BY ALL""")
def _(t):
    return gold.warehouse_labour(t.warehouse)


INV_DAY = DAY.format("invoice_date")


def pay(s: str) -> str:
    return cnt(f"payment_status = '{s}'")


def age(b: str) -> str:
    return cnt(f"aging_bucket = '{b}'")


def age_sum(b: str) -> str:
    return f"(coalesce(sum(due_c) FILTER (WHERE aging_bucket = '{b}'), 0)::DOUBLE / 100)"


AGING_SUMS = f"""{age_sum('Current')} AS aging_current, {age_sum('1-30')} AS aging_1_30,
  {age_sum('31-60')} AS aging_31_60, {age_sum('61-90')} AS aging_61_90,
  {age_sum('90+')} AS aging_90_plus"""


@query("gld_15_revenue_daily", views="s_invoices", sql=f"""
SELECT {INV_DAY} AS invoice_day, fiscal_year, fiscal_period, sap_system,
  count(*) AS total_invoices, {total('total_c')} AS total_revenue,
  {total('sub_c')} AS total_subtotal, {total('tax_c')} AS total_tax,
  {total('disc_c')} AS total_discounts, {avg('total_c', cents=2)} AS avg_invoice_amount,
  {total('due_c')} AS total_amount_due, {total('paid_c')} AS total_amount_paid,
  {cnt("invoice_type = 'Standard'")} AS standard_invoices,
  {cnt("invoice_type = 'Credit'")} AS credit_invoices,
  {cnt("invoice_type = 'Debit'")} AS debit_invoices,
  {cnt("invoice_type = 'Pro-forma'")} AS proforma_invoices,
  {pay('Paid')} AS paid_invoices, {pay('Pending')} AS pending_invoices,
  {pay('Partial')} AS partial_invoices, {pay('Overdue')} AS overdue_invoices,
  {age('Current')} AS current_invoices, {age('1-30')} AS aging_1_30,
  {age('31-60')} AS aging_31_60, {age('61-90')} AS aging_61_90, {age('90+')} AS aging_90_plus,
  count(DISTINCT customer_id) AS unique_customers, {cnt('is_disputed')} AS disputed_invoices,
  coalesce(sum(total_c) FILTER (WHERE is_disputed), 0)::DOUBLE / 100 AS disputed_amount,
  {avg('payment_efficiency')} AS avg_payment_efficiency,
  {avg('margin')} AS avg_gross_margin_pct,
  {avg("CASE WHEN payment_status = 'Paid' THEN days_overdue END")} AS avg_days_to_payment,
  string_agg(DISTINCT currency, ',' ORDER BY currency) AS currencies_used,
  {pct(age('Current'), 'count(*)')} AS current_pct, {pct(age('1-30'), 'count(*)')} AS aging_1_30_pct,
  {pct(age('31-60'), 'count(*)')} AS aging_31_60_pct,
  {pct(age('61-90'), 'count(*)')} AS aging_61_90_pct,
  {pct(age('90+'), 'count(*)')} AS aging_90_plus_pct, {pct(pay('Paid'), 'count(*)')} AS paid_rate,
  {pct(pay('Pending'), 'count(*)')} AS pending_rate,
  {pct(pay('Overdue'), 'count(*)')} AS overdue_rate,
  {pct(cnt('is_disputed'), 'count(*)')} AS dispute_rate,
  {pct('sum(paid_c)', 'sum(paid_c) + sum(due_c)')} AS collection_rate,
  {rnd('sum(total_c)', 'count(DISTINCT customer_id)', cents=2)} AS revenue_per_customer,
  {pct('sum(tax_c)', 'sum(sub_c)')} AS effective_tax_rate,
  {pct('sum(disc_c)', 'sum(sub_c)')} AS discount_rate,
  {rnd('sum(due_c) * 30', 'sum(total_c)')} AS dso_days
FROM s_invoices GROUP BY ALL""")
def _(t):
    df = gold.revenue_daily(t.measured_invoices)
    return df.withColumn("currencies_used", F.array_join("currencies_used", ","))


@query("gld_15_revenue_by_service", views="s_invoices", sql=f"""
SELECT invoice_day, sap_system,
  string_agg(service_type || '=' || printf('%.2f', c::DOUBLE / 100), ';' ORDER BY service_type)
    AS revenue_by_service
FROM (SELECT {INV_DAY} AS invoice_day, sap_system, service_type, sum(total_c) AS c
      FROM s_invoices GROUP BY ALL) GROUP BY ALL""")
def _(t):
    df = gold.revenue_by_service(t.invoices)
    text = F.transform(F.map_entries("revenue_by_service"), lambda e: F.concat_ws(
        "=", e["key"], e["value"].cast("string")))
    return df.withColumn("revenue_by_service", F.array_join(text, ";"))


def share(amount: str) -> str:
    return pct(f"round({amount} * 100)", "round(total_due * 100)")


PAY_DAYS = "date_diff('day', invoice_date, payment_date)"
RECOGNITION = f"""
SELECT *, 30 AS dso_target_days,
  (round(avg_days_to_payment * 100) - 3000) / 100 AS dso_variance_days,
  CASE WHEN overdue_rate_pct > 20 THEN 'High' WHEN overdue_rate_pct > 10 THEN 'Medium'
    ELSE 'Low' END AS collection_risk, total_due AS total_outstanding,
  CASE WHEN total_due > 0 THEN {share('aging_current')} ELSE 0 END AS aging_current_pct,
  CASE WHEN total_due > 0 THEN {share('aging_90_plus')} ELSE 0 END AS aging_90_plus_pct
FROM (SELECT {INV_DAY} AS invoice_day, customer_id, sap_system, count(*) AS total_invoices,
  count(DISTINCT invoice_number) AS unique_invoices, {total('total_c')} AS total_revenue,
  {total('paid_c')} AS total_paid, {total('due_c')} AS total_due,
  {pay('Pending')} AS pending_invoices, {pay('Partial')} AS partial_invoices,
  {pay('Paid')} AS paid_invoices, {pay('Overdue')} AS overdue_invoices, {AGING_SUMS},
  {avg(PAY_DAYS)} AS avg_days_to_payment, {avg('total_c', cents=2)} AS avg_invoice_value,
  coalesce({pct('sum(paid_c)', 'sum(total_c)')}, 0.0::DOUBLE) AS collection_efficiency_pct,
  {pct(pay('Paid'), 'count(*)')} AS payment_rate_pct,
  {pct(pay('Overdue'), 'count(*)')} AS overdue_rate_pct
FROM s_invoices GROUP BY ALL)"""


@query("gld_16_revenue_recognition", views="s_invoices", sql=RECOGNITION)
def _(t):
    return gold.revenue_recognition(t.invoices)


@query("gld_17_revenue_by_month", views="s_invoices", sql=f"""
SELECT strftime(invoice_date, '%Y-%m') AS invoice_month, customer_id,
  count(*) AS invoice_count, {total('total_c')} AS total_revenue, {total('due_c')} AS outstanding,
  {AGING_SUMS} FROM s_invoices GROUP BY ALL""")
def _(t):
    return gold.revenue_by_month(t.invoices)


@query("gld_18_orders_volume", views="g_orders", sql=f"""
SELECT {ORDER_DAY} AS order_day, sap_system, count(*) AS total_orders,
  {total('total_c')} AS total_order_value, {avg('total_c', cents=2)} AS avg_order_value,
  {money('max(total_amount)')} AS max_order_value, {HIGH} AS urgent_orders,
  count(DISTINCT customer_id) AS unique_customers
FROM g_orders GROUP BY ALL""")
def _(t):
    return gold.orders_volume(t.gold_order_facts)


@query("gld_18_sla_overview", views="g_orders", sql=f"""
SELECT {ORDER_DAY} AS performance_day, sap_system, count(*) AS total_orders,
  {cnt("sla_status = 'Good'")} AS sla_good, {cnt("sla_status = 'At Risk'")} AS sla_at_risk,
  {cnt("sla_status = 'Breached'")} AS sla_breached,
  {pct(cnt("sla_status = 'Good'"), 'count(*)')} AS sla_compliance_pct,
  {avg('order_age_hours')} AS avg_order_age_hours, max(order_age_hours) AS max_order_age_hours
FROM g_orders GROUP BY ALL""")
def _(t):
    return gold.sla_overview(t.gold_order_facts)


@query("gld_18_warehouse_throughput", views="s_warehouse", sql=f"""
SELECT {MOVE_DAY} AS movement_day, sap_system, count(*) AS total_movements,
  sum(quantity)::DOUBLE AS total_quantity, sum(weight_kg)::DOUBLE AS total_weight_kg,
  {avg('processing_time_minutes')} AS avg_processing_minutes,
  max(processing_time_minutes) AS max_processing_minutes,
  {cnt('exception_flag')} AS exception_count,
  {cnt('inspection_required')} AS inspection_required_count,
  count(DISTINCT operator_id) AS unique_operators,
  count(DISTINCT material_id) AS unique_materials,
  count(DISTINCT warehouse_id) AS unique_warehouses,
  {kind('GR')} AS inbound_movements, {kind('GI')} AS outbound_movements
FROM s_warehouse GROUP BY ALL""")
def _(t):
    return gold.warehouse_throughput(t.warehouse)


@query("gld_18_revenue_split", views="s_invoices", sql=f"""
SELECT {INV_DAY} AS invoice_day, sap_system, count(*) AS total_invoices,
  {total('total_c')} AS total_revenue,
  coalesce(sum(total_c) FILTER (WHERE payment_status = 'Paid'), 0)::DOUBLE / 100 AS total_paid,
  coalesce(sum(total_c) FILTER (WHERE payment_status <> 'Paid'), 0)::DOUBLE / 100 AS total_due,
  {avg('total_c', cents=2)} AS avg_invoice_amount,
  {money('max(total_amount)')} AS max_invoice_amount, {pay('Overdue')} AS overdue_invoices,
  {pay('Paid')} AS paid_invoices, {pay('Pending')} AS pending_invoices,
  {cnt('is_disputed')} AS disputed_invoices,
  count(DISTINCT customer_id) AS unique_customers,
  {avg('payment_efficiency')} AS avg_payment_efficiency
FROM s_invoices GROUP BY ALL""")
def _(t):
    return gold.revenue_paid_and_due(t.invoices)


@query("gld_19_orders_hourly", views="g_orders", sql=f"""
SELECT date_trunc('hour', order_date)::VARCHAR AS order_hour, sap_system,
  count(*) AS total_orders, {total('total_c')} AS total_value,
  {cnt("sla_status = 'Breached'")} AS breached_orders FROM g_orders GROUP BY ALL""")
def _(t):
    return gold.orders_hourly(t.gold_order_facts)


@query("gld_20_shipments_by_day", views="s_shipments", sql=f"""
SELECT {DAY.format('actual_ship_date')} AS ship_day, customer_id, carrier_id,
  count(*) AS shipment_count, {total('value_c')} AS total_value, {cnt('is_on_time')} AS on_time_count
FROM s_shipments GROUP BY ALL""")
def _(t):
    return gold.shipments_by_day(t.shipments)
