"""Registered extraction of entities from JSON messages made from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.catalog.base import query
from waybill.catalog.gold import cnt
from waybill.catalog.views_sql import NOW, money, pct
from waybill.operators import extract as x
from waybill.operators.rows import top_by, union_all
from waybill.plans import messages as m
from waybill.sources.driver_messages import Messages

C = F.col


def ts(expr: str, name: str) -> str:
    return f"({expr})::VARCHAR AS {name}"


@query("ext_1_header", views="s_orders", sql="""
SELECT order_number AS docnum, '03' AS status, '2' AS direction, 'SALES' AS sender,
  'LAKE' AS receiver, strftime(order_date, '%Y%m%d') AS created_date,
  strftime(order_date, '%H%M%S') AS created_time FROM s_orders""")
def _(t):
    return x.message_summary(Messages(t).orders).select("header.*")


@query("ext_2_summary", views="s_shipments", sql=f"""
SELECT 'SHPMNT' AS message_type, 'SHPMNT05' AS idoc_type, sap_system,
  shipment_number AS idoc_number, {ts('planned_ship_date', 'timestamp')} FROM s_shipments""")
def _(t):
    return x.message_summary(Messages(t).shipments).drop("header")


@query("ext_3_partner_summary", views="s_orders s_shipments s_warehouse", sql="""
SELECT 'ORDERS' AS message_type, order_number AS idoc_number, '' AS carrier_id,
  '' AS carrier_name, customer_id, customer_name, '' AS warehouse_partner_id,
  'CUSTOMER' AS partner_access_scope FROM s_orders
UNION ALL SELECT 'SHPMNT', shipment_number, carrier_id, carrier_name, customer_id, customer_name,
  '', 'CARRIER_CUSTOMER' FROM s_shipments
UNION ALL SELECT 'DESADV', shipment_number, carrier_id, carrier_name, customer_id, customer_name,
  '', 'CARRIER_CUSTOMER' FROM s_shipments WHERE actual_delivery_date IS NOT NULL
UNION ALL SELECT 'WHSCON', movement_id, '', '', '', '', warehouse_partner_id,
  'WAREHOUSE_PARTNER' FROM s_warehouse""")
def _(t):
    made = Messages(t)
    every = union_all([made.orders, made.shipments, made.deliveries, made.movements])
    return x.partner_summary(every).select(
        "message_type", "idoc_number", "carrier_id", "carrier_name", "customer_id",
        "customer_name", "warehouse_partner_id", "partner_access_scope")


@query("msg_28_partner_coverage", views="s_orders s_shipments s_warehouse", sql=f"""
WITH a AS (SELECT 'ORDERS' AS k, customer_id AS c, '' AS r, '' AS w FROM s_orders
  UNION ALL SELECT 'SHPMNT', customer_id, carrier_id, '' FROM s_shipments
  UNION ALL SELECT 'WHSCON', '', '', warehouse_partner_id FROM s_warehouse)
SELECT count(*) AS total_messages, {pct(cnt("r <> ''"), 'count(*)')} AS carrier_coverage,
  {pct(cnt("c <> '' AND k IN ('ORDERS', 'INVOIC')"), 'count(*)')} AS customer_coverage,
  {pct(cnt("w <> '' AND k = 'WHSCON'"), 'count(*)')} AS warehouse_coverage FROM a""")
def _(t):
    made = Messages(t)
    return m.partner_coverage(x.partner_summary(
        union_all([made.orders, made.shipments, made.movements])))


AGE12 = ("CASE WHEN order_age_hours < 12 THEN 'Good' WHEN order_age_hours < 24 THEN 'At Risk' "
         "ELSE 'Breached' END")


@query("ext_4_orders_flat", views="s_orders_lines", sql=f"""
SELECT order_number, 1 AS order_version, {ts('order_date', 'order_date')}, customer_id,
  customer_name, {ts('requested_delivery_date', 'requested_delivery_date')},
  {ts('requested_delivery_date', 'promised_delivery_date')}, 'ZOR' AS order_type, priority,
  {money('total_amount')} AS total_amount, currency, 'Net 30' AS payment_terms,
  '03' AS order_status, order_age_hours::DOUBLE AS order_age_hours, is_delayed,
  {AGE12} AS sla_status, total_lines::INTEGER AS total_lines,
  total_quantity::DOUBLE AS total_quantity, total_weight_kg::DOUBLE AS total_weight_kg,
  sap_system, order_number AS idoc_number FROM s_orders_lines""")
def _(t):
    df = x.extract_orders_flat(Messages(t).orders_flat, as_of=t.as_of)
    return df.drop("processing_status", "created_by", "last_modified", "idoc_type",
                   "message_timestamp", "raw_control", "raw_data")


@query("ext_5_orders_header", views="s_orders", sql=f"""
SELECT order_number, 'ZOR' AS order_type, customer_id AS customer_number, customer_id,
  customer_name, {ts('order_date::DATE::TIMESTAMP', 'order_date')},
  {ts('requested_delivery_date', 'requested_delivery_date')}, order_status,
  {money('total_amount')} AS total_value, currency, 'Net 30' AS payment_terms,
  'CUSTOMER' AS partner_access_scope FROM s_orders""")
def _(t):
    return x.extract_orders_header(Messages(t).orders).select(
        "order_number", "order_type", "customer_number", "customer_id", "customer_name",
        "order_date", "requested_delivery_date", "order_status", "total_value", "currency",
        "payment_terms", "partner_access_scope")


@query("ext_6_orders_segments", views="s_orders", sql=f"""
SELECT order_number, customer_id, customer_name, {ts('order_date', 'order_date')},
  {ts('requested_delivery_date', 'requested_delivery_date')},
  {ts('order_date + INTERVAL 24 HOUR', 'promised_delivery_date')}, 'WH001' AS warehouse_id,
  'ZOR' AS order_type, priority, {money('total_amount')} AS subtotal_amount,
  1.5::DOUBLE AS tax_amount, {money('total_amount')} AS total_amount, currency,
  'Net 30' AS payment_terms, 'Pending' AS order_status, order_age_hours, is_delayed,
  CASE WHEN order_age_hours < 20 THEN 'Good' WHEN order_age_hours < 24 THEN 'At Risk'
    ELSE 'Breached' END AS sla_status, 'Main Store' AS ship_to_city,
  2 AS total_lines, 5.5::DOUBLE AS total_quantity, 25::DOUBLE AS total_weight_kg,
  'CUSTOMER' AS partner_access_scope, sap_system FROM s_orders""")
def _(t):
    df = x.extract_orders(Messages(t).orders, as_of=t.as_of)
    return df.drop("sla_target_hours", "ship_to_name", "ship_to_street", "ship_to_state",
                   "ship_to_postal_code", "ship_to_country", "idoc_type", "idoc_number",
                   "message_timestamp")


@query("ext_7_orders_lab", views="s_orders", sql=f"""
SELECT order_number || '-2' AS message_id, order_number, sap_system, customer_id AS customer_number,
  customer_name, order_date::DATE::VARCHAR AS order_date,
  requested_delivery_date::DATE::VARCHAR AS delivery_date,
  actual_ship_date::DATE::VARCHAR AS actual_ship_date,
  actual_delivery_date::DATE::VARCHAR AS actual_delivery_date,
  {money('total_amount')} AS total_amount, currency, order_status,
  date_diff('day', {NOW}, requested_delivery_date) AS sla_days_remaining,
  CASE WHEN date_diff('day', {NOW}, requested_delivery_date) >= 3 THEN 'Good'
    WHEN date_diff('day', {NOW}, requested_delivery_date) >= 1 THEN 'At Risk'
    ELSE 'Breached' END AS sla_status,
  date_diff('day', order_date, actual_ship_date) AS days_to_ship,
  date_diff('day', order_date, actual_delivery_date) AS days_to_delivery,
  customer_id AS partner_access_scope,
  1 + (order_number::BIGINT % 3 = 0)::BIGINT AS line_count FROM s_orders""")
def _(t):
    return x.extract_orders_lab(Messages(t).orders_lab, as_of=t.as_of).drop(
        "timestamp", "order_type")


FACTS = """ship_delay_hours, delivery_delay_hours, transit_time_hours, is_on_time,
  is_in_transit"""
TIMES = ", ".join(ts(c, c) for c in ("planned_ship_date", "actual_ship_date",
                                     "planned_delivery_date", "actual_delivery_date"))
SHIP_KEEP = ("planned_ship_date", "actual_ship_date", "planned_delivery_date",
             "actual_delivery_date", "ship_delay_hours", "delivery_delay_hours",
             "transit_time_hours", "is_on_time", "is_in_transit")


@query("ext_8_shipments_flat", views="s_shipments", sql=f"""
SELECT shipment_number, tracking_number, order_number, carrier_id AS carrier_code, carrier_name,
  service_level, shipment_status, total_weight_kg::DOUBLE AS total_weight_kg, {TIMES}, {FACTS}
FROM s_shipments""")
def _(t):
    return x.extract_shipments_flat(Messages(t).shipments_flat).select(
        "shipment_number", "tracking_number", "order_number", "carrier_code", "carrier_name",
        "service_level", "shipment_status", "total_weight_kg", *SHIP_KEEP)


STATUS_TEXT = ("CASE shipment_status WHEN 'Delivered' THEN 'Delivered' WHEN 'In Transit' THEN "
               "'In Transit' ELSE 'Exception' END")


@query("ext_9_shipments_segments", views="s_shipments", sql=f"""
SELECT shipment_number, tracking_number, order_number, origin_country AS origin_location,
  destination_country AS destination_location, carrier_id, carrier_name, service_level,
  customer_id, customer_name, 'CARRIER_CUSTOMER' AS partner_access_scope,
  {STATUS_TEXT} AS shipment_status, total_weight_kg::DOUBLE AS total_weight_kg, sap_system,
  {TIMES}, {FACTS} FROM s_shipments""")
def _(t):
    return x.extract_shipments(Messages(t).shipments).select(
        "shipment_number", "tracking_number", "order_number", "origin_location",
        "destination_location", "carrier_id", "carrier_name", "service_level", "customer_id",
        "customer_name", "partner_access_scope", "shipment_status", "total_weight_kg",
        "sap_system", *SHIP_KEEP)


@query("ext_10_status_codes", views="s_shipments", sql="""
SELECT CASE shipment_status WHEN 'Delivered' THEN 'In Transit' WHEN 'In Transit' THEN 'Picked Up'
  ELSE 'Delivered' END AS shipment_status, count(*) AS row_count FROM s_shipments GROUP BY 1""")
def _(t):
    from waybill.functions.policies import SHIPMENT_STATUS_CODES_ALT
    return x.extract_shipments(Messages(t).shipments, SHIPMENT_STATUS_CODES_ALT).groupBy(
        "shipment_status").agg(F.count("*").alias("row_count"))


@query("ext_11_tracking_events", views="s_shipments", sql=f"""
SELECT shipment_number, 1 AS sequence, 'PLANNED' AS event_type,
  {ts('planned_ship_date', 'event_time')}, 'P' AS status_code, origin_country AS location
FROM s_shipments UNION ALL
SELECT shipment_number, 2, 'STATUS_UPDATE', planned_delivery_date::VARCHAR,
  CASE shipment_status WHEN 'Delivered' THEN 'B' WHEN 'In Transit' THEN 'A' ELSE 'C' END,
  destination_country FROM s_shipments""")
def _(t):
    return x.extract_tracking_events(Messages(t).shipments).drop("sap_system", "status_text")


@query("ext_12_deliveries", views="s_shipments", sql=f"""
SELECT 'D' || shipment_number AS delivery_number,
  {ts('actual_ship_date::DATE::TIMESTAMP', 'delivery_date')}, order_number, carrier_id,
  tracking_number, customer_id, 'WH001' AS warehouse_id,
  total_weight_kg::DOUBLE AS total_weight_kg, total_weight_kg * 2.0::DOUBLE AS total_gross_weight_kg,
  total_weight_kg / 4.0::DOUBLE AS total_volume_m3, 2 AS item_count, 3.5::DOUBLE AS total_quantity,
  1 AS total_pallets, 2 AS total_cartons, 'CARRIER_CUSTOMER' AS partner_access_scope
FROM s_shipments WHERE actual_delivery_date IS NOT NULL""")
def _(t):
    return x.extract_deliveries(Messages(t).deliveries).drop(
        "carrier_name", "service_level", "customer_name", "sap_system", "idoc_type",
        "idoc_number", "message_timestamp")


@query("ext_13_warehouse_flat", views="s_warehouse", sql=f"""
SELECT movement_id, {ts('movement_timestamp', 'movement_timestamp')}, '03' AS movement_status,
  warehouse_id, movement_type, material_id, quantity::DOUBLE AS quantity,
  weight_kg::DOUBLE AS weight_kg, zone, operator_id, equipment_id, quality_status,
  inspection_required, processing_time_minutes, exception_flag FROM s_warehouse""")
def _(t):
    return x.extract_warehouse_flat(Messages(t).movements_flat).select(
        "movement_id", "movement_timestamp", "movement_status", "warehouse_id", "movement_type",
        "material_id", "quantity", "weight_kg", "zone", "operator_id", "equipment_id",
        "quality_status", "inspection_required", "processing_time_minutes", "exception_flag")


@query("ext_14_warehouse_header", views="s_warehouse", sql=f"""
SELECT movement_id AS confirmation_number, warehouse_id, warehouse_partner_id, movement_type,
  order_number AS reference_document, material_id, quantity::INTEGER AS quantity,
  weight_kg::DOUBLE AS weight_kg, {ts('movement_timestamp', 'movement_timestamp')},
  operator_id, 'WAREHOUSE_PARTNER' AS partner_access_scope FROM s_warehouse""")
def _(t):
    return x.extract_warehouse_header(Messages(t).movements).select(
        "confirmation_number", "warehouse_id", "warehouse_partner_id", "movement_type",
        "reference_document", "material_id", "quantity", "weight_kg", "movement_timestamp",
        "operator_id", "partner_access_scope")


@query("ext_15_warehouse_items", views="s_warehouse", sql=f"""
SELECT movement_id AS confirmation_number, '10' AS item_number, warehouse_id,
  warehouse_partner_id, warehouse_partner_id <> '' AS is_partner_operated, movement_type,
  {ts('movement_timestamp', 'movement_timestamp')}, material_id, quantity::DOUBLE AS quantity,
  quantity::DOUBLE AS target_quantity, 0::DOUBLE AS quantity_variance FROM s_warehouse""")
def _(t):
    return x.extract_warehouse_items(Messages(t).movements).select(
        "confirmation_number", "item_number", "warehouse_id", "warehouse_partner_id",
        "is_partner_operated", "movement_type", "movement_timestamp", "material_id", "quantity",
        "target_quantity", "quantity_variance")


@query("ext_16_warehouse_children", views="s_warehouse", sql="""
SELECT movement_id AS confirmation_number,
  'S1-' || material_id || ',S2-' || material_id AS serial_numbers, location_code AS source_bin,
  processing_time_minutes::DOUBLE AS processing_time_minutes, equipment_id,
  95.5::DOUBLE AS productivity_score, quality_status AS quality_check_result,
  exception_flag AS has_exception, exception_type,
  CASE WHEN exception_flag THEN quality_status END AS exception_reason FROM s_warehouse""")
def _(t):
    return x.extract_warehouse_items(Messages(t).movements).select(
        "confirmation_number", "serial_numbers", "source_bin", "processing_time_minutes",
        "equipment_id", "productivity_score", "quality_check_result", "has_exception",
        "exception_type", "exception_reason")


@query("ext_17_invoices_flat", views="s_invoices", sql=f"""
SELECT invoice_number, invoice_type, {ts('invoice_date', 'invoice_date')},
  {ts('due_date', 'due_date')}, {ts('payment_date', 'payment_date')}, customer_id, currency,
  sub_c::DOUBLE / 100 AS subtotal_amount, tax_c::DOUBLE / 100 AS tax_amount,
  disc_c::DOUBLE / 100 AS discount_amount, {money('amount_paid')} AS amount_paid,
  payment_status, service_type, total_line_items::INTEGER AS total_line_items,
  fiscal_year::INTEGER AS fiscal_year, fiscal_period::INTEGER AS fiscal_period, is_disputed,
  {money('total_amount')} AS total_amount, {money('amount_due')} AS amount_due,
  -days_overdue AS days_to_due, days_overdue, is_overdue, aging_bucket, payment_efficiency
FROM s_invoices""")
def _(t):
    return x.extract_invoices_flat(Messages(t).invoices_flat, as_of=t.as_of).select(
        "invoice_number", "invoice_type", "invoice_date", "due_date", "payment_date",
        "customer_id", "currency", "subtotal_amount", "tax_amount", "discount_amount",
        "amount_paid", "payment_status", "service_type", "total_line_items", "fiscal_year",
        "fiscal_period", "is_disputed", "total_amount", "amount_due", "days_to_due",
        "days_overdue", "is_overdue", "aging_bucket", "payment_efficiency")


@query("ext_18_invoices_header", views="s_invoices", sql=f"""
SELECT invoice_number, 'ZINV' AS invoice_type, customer_id AS bill_to_customer, customer_id,
  order_number AS order_reference, tax_c::DOUBLE / 100 AS tax_amount,
  {money('total_amount')} AS total_amount, currency, {ts('invoice_date', 'invoice_date')},
  {ts('due_date', 'due_date')}, payment_status, 'CUSTOMER' AS partner_access_scope
FROM s_invoices""")
def _(t):
    return x.extract_invoices_header(Messages(t).invoices).select(
        "invoice_number", "invoice_type", "bill_to_customer", "customer_id", "order_reference",
        "tax_amount", "total_amount", "currency", "invoice_date", "due_date", "payment_status",
        "partner_access_scope")


@query("ext_19_invoices_segments", views="s_invoices", sql=f"""
SELECT invoice_number, {ts('invoice_date', 'invoice_date')}, {ts('due_date', 'due_date')},
  customer_id, 'D-' || order_number AS delivery_number, sub_c::DOUBLE / 100 AS subtotal_amount,
  tax_c::DOUBLE / 100 AS tax_amount, {money('total_amount')} AS total_amount, currency,
  {money('amount_paid')} AS amount_paid, {money('amount_due')} AS amount_due, payment_status,
  date_diff('day', invoice_date, {NOW}) AS aging_days,
  greatest(days_overdue, 0) AS days_overdue, is_overdue, aging_bucket, payment_efficiency,
  date_diff('day', invoice_date, {NOW}) > 30 AS is_immutable FROM s_invoices""")
def _(t):
    df = x.extract_invoices(Messages(t).invoices, as_of=t.as_of, payments=t.invoices)
    return df.select("invoice_number", "invoice_date", "due_date", "customer_id",
                     "delivery_number", "subtotal_amount", "tax_amount", "total_amount",
                     "currency", "amount_paid", "amount_due", "payment_status", "aging_days",
                     "days_overdue", "is_overdue", "aging_bucket", "payment_efficiency",
                     "is_immutable")


@query("ext_20_order_items", views="s_orders", sql="""
SELECT order_number, 1 AS position, '10' AS item_number, 'MAT-A' AS material_id,
  3::DOUBLE AS quantity, ((total_c + 2) // 4)::DOUBLE / 100 AS net_amount FROM s_orders
UNION ALL SELECT order_number, 2, '20', 'MAT-B', 2.5,
  (total_c - (total_c + 2) // 4)::DOUBLE / 100 FROM s_orders""")
def _(t):
    return x.extract_order_items(Messages(t).orders).select(
        "order_number", "position", "item_number", "material_id", "quantity", "net_amount")


@query("ext_23_invoice_lines", views="s_invoices s_order_lines", sql="""
SELECT invoice_number, row_number() OVER (PARTITION BY invoice_number ORDER BY item_number)
    AS position, (item_number * 10)::VARCHAR AS item_number, material_id,
  quantity::DOUBLE AS quantity, net_amount::DOUBLE AS net_amount
FROM s_invoices i JOIN s_order_lines l ON i.order_number = l.order_number""")
def _(t):
    return x.extract_invoice_items(Messages(t).invoice_lines).select(
        "invoice_number", "position", "item_number", "material_id", "quantity", "net_amount")


@query("ext_24_delivery_lines", views="s_shipments", sql="""
SELECT 'D' || shipment_number AS delivery_number, p AS position, (p * 10)::VARCHAR AS item_number,
  'P' || p AS material_id, CASE p WHEN 1 THEN 1.5 ELSE 2 END::DOUBLE AS quantity, order_number,
  (total_weight_kg / 2.0)::DOUBLE AS weight_kg,
  CASE p WHEN 1 THEN 'B' || shipment_number END AS batch_number,
  CASE p WHEN 1 THEN 1.5::DOUBLE END AS batch_quantity
FROM s_shipments, (VALUES (1), (2)) v(p) WHERE actual_delivery_date IS NOT NULL""")
def _(t):
    return x.extract_delivery_items(Messages(t).delivery_lines).select(
        "delivery_number", "position", "item_number", "material_id", "quantity", "order_number",
        "weight_kg", "batch_number", "batch_quantity")


@query("dq_ref_006_payload", views="s_invoices", sql="""
SELECT count(*) AS invoices, count(*) FILTER (WHERE order_number::BIGINT % 97 = 0) AS differing
FROM s_invoices""")
def _(t):
    """The subtotal that a message states against the lines it holds."""
    raw = Messages(t).invoice_lines
    lines = x.extract_invoice_items(raw).groupBy("invoice_number").agg(
        F.sum("net_amount").alias("line_total"))
    stated = x.extract_invoices(raw, as_of=t.as_of).select("invoice_number", "subtotal_amount")
    return stated.join(lines, "invoice_number", "left").agg(
        F.count("*").alias("invoices"),
        F.count_if(~F.col("subtotal_amount").eqNullSafe(F.col("line_total"))).alias("differing"))


@query("ext_21_payload_orders", views="s_orders", sql=f"""
SELECT order_number, customer_id, {ts('order_date', 'order_date')},
  {money('total_amount')} AS total_value, order_status AS status,
  order_number AS source_idoc_number FROM s_orders""")
def _(t):
    payload = F.to_json(F.struct(
        F.struct("order_number", F.date_format("order_date", "yyyy-MM-dd HH:mm:ss")
                 .alias("order_date")).alias("header"),
        F.struct("customer_id").alias("customer"),
        C("total_amount").cast("double").alias("total_value"),
        C("order_status").alias("status")))
    raw = t.orders.select(F.lit("ORDERS").alias("idoc_type"),
                          C("order_number").alias("idoc_number"), payload.alias("raw_payload"))
    return x.extract_payload_orders(raw).drop("order_id")


@query("ext_22_object_or_array", views="s_shipments s_orders", sql="""
SELECT 'array' AS shape, count(*) AS messages, count(*) AS with_customer FROM s_orders
UNION ALL SELECT 'object', count(*), count(*) FROM s_shipments
WHERE actual_delivery_date IS NOT NULL""")
def _(t):
    made = Messages(t)
    parts = []
    for shape, df in (("array", made.orders), ("object", made.deliveries)):
        parts.append(x.partner_summary(df).agg(
            F.lit(shape).alias("shape"), F.count("*").alias("messages"),
            F.count_if(C("customer_id") != "").alias("with_customer")))
    return union_all(parts)


@query("msg_24_order_extract", views="s_orders", sql=f"""
SELECT {ts('order_date', 'timestamp')}, order_number, {ts('order_date::DATE', 'order_date')},
  customer_id, 'MAT-A' AS first_material, sap_system FROM s_orders""")
def _(t):
    return m.order_extract(Messages(t).orders)


@query("msg_24_top_customers", views="s_orders", sql="""
SELECT customer_id, count(*) AS orders FROM s_orders GROUP BY 1
ORDER BY orders DESC, customer_id LIMIT 10""")
def _(t):
    return top_by(m.count_by(m.order_extract(Messages(t).orders), "customer_id", name="orders"), 10,
                  F.desc("orders"), "customer_id")


@query("msg_24_warehouse_operations", views="s_warehouse", sql="""
SELECT warehouse_id, movement_type AS operation, count(*) AS operations,
  sum(quantity)::DOUBLE AS quantity FROM s_warehouse GROUP BY ALL""")
def _(t):
    return m.warehouse_operations(Messages(t).movements)


@query("msg_24_top_payload_invoices", views="s_invoices", sql=f"""
SELECT invoice_number, customer_id, {money('total_amount')} AS amount FROM s_invoices
ORDER BY total_c DESC, invoice_number LIMIT 10""")
def _(t):
    return m.top_payload_invoices(Messages(t).invoices)
