"""Registered dimensions, facts and metrics over the star, and linkage joins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.catalog.base import query
from waybill.catalog.gold import DAY, cnt
from waybill.catalog.views_sql import NOW, avg, money, pct, total
from waybill.operators import rows, storage
from waybill.plans import gold, linkage, star
from waybill.session import checkpoint_dir

C = F.col
NUMBER = "row_number() OVER (ORDER BY left(md5({0}), 2), {0})"


def folder(t, name: str) -> str:
    return f"{checkpoint_dir(t.spark)}/waybill/{name}-{uuid.uuid4().hex}"


def dim_sql(view: str, key: str, surrogate: str, columns: str) -> str:
    return (f"SELECT {NUMBER.format(key)} AS {surrogate}, {columns}, "
            f"CAST({NOW} AS DATE)::VARCHAR AS valid_from, NULL::VARCHAR AS valid_to, "
            f"true AS is_current FROM {view}")


def customer_dim(t):
    source = star.members(t.customers.withColumn("customer_type", F.lit("EXTERNAL")),
                          "customer_id", ["customer_name", "customer_type", "region"])
    return star.load_dimension(source, "customer_id",
                               ["customer_name", "customer_type", "region"], "customer_key",
                               as_of=t.as_of)


def carrier_dim(t):
    source = star.members(t.carriers.withColumn("service_type", F.lit("GROUND")), "carrier_id",
                          ["carrier_name", "service_type"])
    return star.load_dimension(source, "carrier_id", ["carrier_name", "service_type"],
                               "carrier_key", as_of=t.as_of)


def loaded(t, name: str, make) -> DataFrame:
    """A dimension as facts read it: loaded into a table once for these tables."""
    paths = t.__dict__.setdefault("_loaded", {})
    if name not in paths:
        path = folder(t, name)
        storage.create_or_replace(make(t), path)
        paths[name] = path
    return t.spark.read.parquet(paths[name])


def customers(t):
    return loaded(t, "customer-dimension", customer_dim)


def carriers(t):
    return loaded(t, "carrier-dimension", carrier_dim)


D_CUSTOMER = dim_sql("s_customers", "customer_id", "customer_key",
                     "customer_id, customer_name, 'EXTERNAL' AS customer_type, region")
D_CARRIER = dim_sql("s_carriers", "carrier_id", "carrier_key",
                    "carrier_id, carrier_name, 'GROUND' AS service_type")
DIMS = f"d_customer AS ({D_CUSTOMER}), d_carrier AS ({D_CARRIER})"

TYPED = ("SELECT customer_id, max(customer_name) AS customer_name, "
         "CASE WHEN count(*) >= 8 THEN 'KEY' ELSE 'EXTERNAL' END AS customer_type FROM s_orders "
         "{0} GROUP BY customer_id")
EARLIER = "1998-01-01"


@query("dim_1_customer_history", views="s_orders", sql=f"""
WITH first_load AS (SELECT {NUMBER.format('customer_id')} AS customer_key, *
    FROM ({TYPED.format(f"WHERE order_date < TIMESTAMP '{EARLIER}'")})),
  second_load AS ({TYPED.format('')}),
  fresh AS (SELECT n.* FROM second_load n LEFT JOIN first_load o USING (customer_id)
    WHERE o.customer_id IS NULL OR o.customer_name <> n.customer_name
       OR o.customer_type <> n.customer_type)
SELECT o.customer_key, o.customer_id, o.customer_name, o.customer_type,
  '{EARLIER}' AS valid_from,
  CASE WHEN f.customer_id IS NOT NULL THEN CAST({NOW} AS DATE)::VARCHAR END AS valid_to,
  f.customer_id IS NULL AS is_current
FROM first_load o LEFT JOIN fresh f USING (customer_id)
UNION ALL
SELECT (SELECT max(customer_key) FROM first_load) + {NUMBER.format('customer_id')}, customer_id,
  customer_name, customer_type, CAST({NOW} AS DATE)::VARCHAR, NULL, true FROM fresh""")
def _(t):
    attributes = ["customer_name", "customer_type"]

    def typed(orders):
        kind = F.when(F.count("*") >= 8, "KEY").otherwise("EXTERNAL")
        return orders.groupBy("customer_id").agg(F.max("customer_name").alias("customer_name"),
                                                 kind.alias("customer_type"))

    before = typed(t.orders.filter(C("order_date") < F.lit(EARLIER).cast("timestamp")))
    first = star.load_dimension(before, "customer_id", attributes, "customer_key",
                                as_of=f"{EARLIER} 00:00:00")
    return star.load_dimension(typed(t.orders), "customer_id", attributes, "customer_key",
                               as_of=t.as_of, existing=first)


@query("dim_1_customer", views="s_customers", sql=D_CUSTOMER)
def _(t):
    return customer_dim(t)


@query("dim_2_carrier", views="s_carriers", sql=D_CARRIER)
def _(t):
    return carrier_dim(t)


@query("dim_3_location", views="s_locations", sql=dim_sql(
    "s_locations", "location_id", "location_key", "location_id, country, region"))
def _(t):
    source = star.members(t.locations, "location_id", ["country", "region"])
    return star.load_dimension(source, "location_id", ["country", "region"], "location_key",
                               as_of=t.as_of)


FACT = f"""SELECT shipment_number, customer_key, carrier_key,
  strftime(actual_ship_date, '%Y%m%d')::INTEGER AS ship_date_key,
  strftime(actual_delivery_date, '%Y%m%d')::INTEGER AS delivery_date_key,
  total_weight_kg::DOUBLE AS total_weight, {money('shipment_value')} AS total_value,
  coalesce(actual_delivery_date <= actual_ship_date + INTERVAL 7 DAY, false)
    AS on_time_delivery_flag,
  date_diff('day', actual_ship_date, actual_delivery_date) AS delivery_delay_days,
  {DAY.format('actual_ship_date')} AS ship_day, shipment_status AS status,
  origin_country, destination_country
FROM s_shipments LEFT JOIN d_customer USING (customer_id) LEFT JOIN d_carrier USING (carrier_id)"""
STAR_VIEWS = "s_shipments s_customers s_carriers"


def fact(t):
    return star.fact_shipment(t.shipments, customers(t), carriers(t))


@query("fact_1_shipment", views=STAR_VIEWS, sql=f"WITH {DIMS} {FACT}")
def _(t):
    return fact(t)


@query("fact_2_order", views="s_orders s_customers s_carriers", sql=f"""
WITH {DIMS}
SELECT order_number, customer_key, strftime(order_date, '%Y%m%d')::INTEGER AS order_date_key,
  {money('total_amount')} AS total_value, order_status AS status,
  order_date::VARCHAR AS order_date
FROM s_orders LEFT JOIN d_customer USING (customer_id)""")
def _(t):
    return star.fact_order(t.orders, customers(t))


RATE = pct(cnt("on_time_delivery_flag"), "count(*)")
VALUE = "sum(round(total_value * 100)::BIGINT)::DOUBLE / 100"


@query("mtr_1_shipments_daily", views=STAR_VIEWS, sql=f"""
WITH {DIMS}, fact AS ({FACT})
SELECT ship_day, customer_id, customer_name, carrier_id, carrier_name,
  count(*) AS shipment_count, sum(total_weight) AS total_weight,
  {cnt('on_time_delivery_flag')} AS on_time_count, {RATE} AS on_time_rate,
  {avg('delivery_delay_days')} AS avg_delay_days
FROM fact JOIN d_customer USING (customer_key) JOIN d_carrier USING (carrier_key)
GROUP BY ALL""")
def _(t):
    return star.shipments_daily(fact(t), customers(t), carriers(t))


@query("mtr_2_customer_metrics", views=STAR_VIEWS, sql=f"""
WITH {DIMS}, fact AS ({FACT})
SELECT customer_id, customer_name, customer_type,
  count(DISTINCT shipment_number) AS total_shipments, sum(total_weight) AS total_weight,
  {VALUE} AS total_value, {RATE} AS on_time_rate, max(ship_day) AS last_shipment_day
FROM fact JOIN d_customer USING (customer_key) GROUP BY ALL""")
def _(t):
    return star.customer_metrics(fact(t), customers(t))


@query("mtr_3_carrier_metrics", views=STAR_VIEWS, sql=f"""
WITH {DIMS}, fact AS ({FACT})
SELECT carrier_id, carrier_name, count(DISTINCT shipment_number) AS total_shipments,
  sum(total_weight) AS total_weight, {RATE} AS on_time_rate,
  {avg('delivery_delay_days')} AS avg_delay_days, max(ship_day) AS last_shipment_day
FROM fact JOIN d_carrier USING (carrier_key) GROUP BY ALL""")
def _(t):
    return star.carrier_metrics(fact(t), carriers(t))


ON_TIME_7 = cnt("actual_delivery_date <= actual_ship_date + INTERVAL 7 DAY")


@query("mtr_4_carrier_performance", views="s_shipments", sql=f"""
SELECT carrier_id, count(*) AS total_deliveries, {avg('total_weight_kg')} AS avg_weight,
  {ON_TIME_7} AS on_time_deliveries,
  {avg("date_diff('day', actual_ship_date, actual_delivery_date)")} AS avg_delay_days,
  {pct(ON_TIME_7, 'count(*)')} AS on_time_rate
FROM s_shipments GROUP BY carrier_id""")
def _(t):
    return star.carrier_performance(t.shipments)


# ---------------------------------------------------------------- joins

@query("src_7_warehouse_names", views="s_warehouse s_warehouses", sql="""
SELECT warehouse_id, warehouse_name, count(*) AS movements
FROM s_warehouse LEFT JOIN s_warehouses USING (warehouse_id) GROUP BY ALL""")
def _(t):
    named = linkage.with_warehouse_names(t.warehouse, t.warehouses)
    return named.groupBy("warehouse_id", "warehouse_name").agg(F.count("*").alias("movements"))


@query("src_7_carrier_codes", views="s_shipments s_carriers", sql="""
SELECT shipment_number, carrier_id, scac
FROM s_shipments LEFT JOIN s_carriers USING (carrier_id)""")
def _(t):
    return linkage.with_carrier_codes(t.shipments, t.carriers).select(
        "shipment_number", "carrier_id", "scac")


@query("join_1_orders_shipments", views="s_orders s_shipments", sql="""
SELECT o.order_number, o.order_status, coalesce(n, 0) AS shipment_count,
  f::VARCHAR AS first_ship_date, d::VARCHAR AS last_delivery_date
FROM s_orders o LEFT JOIN (SELECT order_number, count(*) AS n, min(actual_ship_date) AS f,
    CASE WHEN count(*) = count(actual_delivery_date) THEN max(actual_delivery_date) END AS d
  FROM s_shipments GROUP BY 1) s USING (order_number)""")
def _(t):
    return linkage.orders_with_shipments(t.orders, t.shipments).select(
        "order_number", "order_status", "shipment_count", "first_ship_date",
        "last_delivery_date")


@query("join_4_fact_dimensions", views=STAR_VIEWS, sql=f"""
WITH {DIMS}, fact AS ({FACT})
SELECT carrier_key, count(*) AS shipments, count(customer_key) AS with_customer
FROM fact GROUP BY carrier_key""")
def _(t):
    return fact(t).groupBy("carrier_key").agg(
        F.count("*").alias("shipments"), F.count("customer_key").alias("with_customer"))


@query("join_5_star_routes", views=STAR_VIEWS + " s_locations", sql=f"""
WITH {DIMS}, fact AS ({FACT})
SELECT o.region AS origin_region, d.region AS destination_region, count(*) AS shipment_count,
  {VALUE} AS total_value
FROM fact f JOIN s_locations o ON f.origin_country = o.country
  JOIN s_locations d ON f.destination_country = d.country GROUP BY ALL""")
def _(t):
    return star.shipments_by_route(fact(t), t.locations)


@query("join_6_new_members", views="s_orders s_shipments", sql="""
SELECT DISTINCT customer_id FROM s_shipments WHERE customer_id NOT IN (
  SELECT customer_id FROM s_orders WHERE order_date < TIMESTAMP '1995-06-01')""")
def _(t):
    early = t.orders.filter(C("order_date") < F.lit("1995-06-01").cast("timestamp"))
    dim = star.load_dimension(
        star.members(early, "customer_id", ["customer_name"]), "customer_id",
        ["customer_name"], "customer_key", as_of="1995-06-01 00:00:00")
    return star.new_members(t.shipments, dim, "customer_id")


@query("join_7_customers_with_orders", views="s_orders s_customers", sql="""
SELECT customer_id, customer_name, region FROM s_customers c
WHERE EXISTS (SELECT 1 FROM s_orders o WHERE o.customer_id = c.customer_id)""")
def _(t):
    return rows.present_keys(t.customers, t.orders, {"customer_id": "customer_id"}).select(
        "customer_id", "customer_name", "region")


@query("join_7_customers_without_orders", views="s_orders s_customers", sql="""
SELECT customer_id, customer_name, region FROM s_customers c
WHERE NOT EXISTS (SELECT 1 FROM s_orders o WHERE o.customer_id = c.customer_id
                  AND o.order_date >= TIMESTAMP '2001-01-01')""")
def _(t):
    recent = t.orders.filter(C("order_date") >= F.lit("2001-01-01").cast("timestamp"))
    return rows.missing_keys(t.customers, recent, {"customer_id": "customer_id"}).select(
        "customer_id", "customer_name", "region")


@query("join_8_partner_gold", views="s_invoices s_customers", sql=f"""
SELECT customer_id, strftime(invoice_date, '%Y-%m') AS invoice_month,
  count(*) AS invoice_count, {total('total_c')} AS total_revenue
FROM s_invoices WHERE customer_id IN (SELECT customer_id FROM s_customers WHERE region = 'ASIA')
GROUP BY ALL""")
def _(t):
    monthly = gold.revenue_by_month(t.invoices).select(
        "customer_id", "invoice_month", "invoice_count", "total_revenue")
    return linkage.partner_filtered(monthly, t.customers, "customer_id", C("region") == "ASIA")


@query("join_10_order_portal", views="s_orders s_shipments s_invoices", sql=f"""
SELECT o.order_number, o.customer_id, o.customer_name, o.order_date::VARCHAR AS order_date,
  o.order_status, {money('o.total_amount')} AS total_amount, coalesce(n, 0) AS shipment_count,
  d::VARCHAR AS last_delivery_date,
  CASE WHEN d <= promised_delivery_date THEN 'Delivered On Time'
    WHEN d IS NOT NULL THEN 'Delivered Late' WHEN n > 0 THEN 'In Delivery'
    ELSE 'Not Shipped' END AS delivery_state,
  i.invoice_number, {money('i.total_amount')} AS invoice_amount, i.payment_status,
  {money('i.amount_due')} AS amount_due
FROM s_orders o LEFT JOIN (SELECT order_number, count(*) AS n,
    CASE WHEN count(*) = count(actual_delivery_date) THEN max(actual_delivery_date) END AS d
  FROM s_shipments GROUP BY 1) s USING (order_number)
  LEFT JOIN s_invoices i ON o.order_number = i.order_number""")
def _(t):
    return linkage.order_portal(t.orders, t.shipments, t.invoices)


@query("join_12_order_invoice", views="s_orders s_invoices", sql=f"""
SELECT o.order_number, o.customer_id, {money('o.total_amount')} AS total_amount,
  i.invoice_number, i.invoice_date::VARCHAR AS invoice_date,
  {money('i.total_amount')} AS invoice_amount,
  (i.total_c - o.total_c)::DOUBLE / 100 AS difference
FROM s_orders o LEFT JOIN s_invoices i ON o.order_number = i.order_number""")
def _(t):
    return linkage.order_to_invoice(t.orders, t.invoices)


