"""Registered row security, masking and partner queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.catalog.base import query
from waybill.catalog.gold import BY_SLA, DAY, ORDER_DAY, RECOGNITION, cnt
from waybill.catalog.views_sql import NOW, avg, money, pct, total
from waybill.operators import query as ask
from waybill.operators import security as sec
from waybill.operators.rows import union_all
from waybill.plans import gold
from waybill.plans.kpis import kpi

C = F.col

POLICY = sec.Policy(
    grants={
        "Carrier": {"shipments": ("carrier_id", "$carrier_id")},
        "WarehousePartner": {"warehouse": ("warehouse_partner_id", "$warehouse_partner_id")},
        "Customer": {"orders": ("customer_id", "$customer_id"),
                     "shipments": ("customer_id", "$customer_id"),
                     "invoices": ("customer_id", "$customer_id")},
        "ScopeReader": {"orders": ("partner_access_scope", "CUSTOMER")},
    },
    members={"Carrier": ("carrier-app", "mixed-app"), "WarehousePartner": ("warehouse-app",),
             "Customer": ("customer-app", "mixed-app")})
CARRIER = POLICY.principal("carrier-app", carrier_id="CARRIER-7")
WAREHOUSE = POLICY.principal("warehouse-app", warehouse_partner_id="PARTNER-WH003")
CUSTOMER = POLICY.principal("customer-app", customer_id="7")
MIXED = POLICY.principal("mixed-app", carrier_id="CARRIER-7", customer_id="7")
ADMIN = sec.Principal("admin-app", is_admin=True)
NOBODY = sec.Principal("guest-app")


def entities(t):
    return {"orders": t.orders, "shipments": t.shipments, "warehouse": t.warehouse,
            "invoices": t.invoices}


def access_table(t):
    """User access derived from the suppliers: five users, some entries inactive."""
    key = C("s_suppkey")
    return t.table("supplier").select(
        F.concat(F.lit("user-"), (key % 5).cast("string")).alias("user"),
        F.concat(F.lit("CARRIER-"), (key % 20).cast("string")).alias("partner"),
        F.concat(F.lit("ORG-"), (key % 4).cast("string")).alias("organization"),
        F.concat(F.lit("DEPT-"), (key % 3).cast("string")).alias("department"),
        (key % 10 != 0).alias("is_active"))


ACCESS = """access AS (SELECT 'user-' || (s_suppkey % 5) AS "user",
  'CARRIER-' || (s_suppkey % 20) AS partner, 'ORG-' || (s_suppkey % 4) AS organization,
  'DEPT-' || (s_suppkey % 3) AS department, s_suppkey % 10 <> 0 AS is_active FROM supplier)"""
SHIP = "SELECT shipment_number, carrier_id, customer_id FROM s_shipments"
SHIP_COLS = ("shipment_number", "carrier_id", "customer_id")
ALL = "s_orders s_shipments s_warehouse s_invoices"


def seen(principal: str, table: str, view: str, cond: str) -> str:
    return (f"SELECT '{principal}' AS principal, '{table}' AS table_name, "
            f"{cnt(cond)} AS visible_rows FROM {view}")


COUNTS = " UNION ALL ".join(
    seen(p, table, view, cond.get(table, "false"))
    for table, view in (("orders", "s_orders"), ("shipments", "s_shipments"),
                        ("warehouse", "s_warehouse"), ("invoices", "s_invoices"))
    for p, cond in (
        ("carrier-app", {"shipments": "carrier_id = 'CARRIER-7'"}),
        ("warehouse-app", {"warehouse": "warehouse_partner_id = 'PARTNER-WH003'"}),
        ("customer-app", {k: "customer_id = '7'" for k in ("orders", "shipments", "invoices")}),
        ("mixed-app", {"orders": "customer_id = '7'", "invoices": "customer_id = '7'",
                       "shipments": "carrier_id = 'CARRIER-7' OR customer_id = '7'"}),
        ("admin-app", {k: "true" for k in ("orders", "shipments", "warehouse", "invoices")}),
        ("guest-app", {})))


@query("rls_1_visible_counts", views=ALL, sql=COUNTS)
def _(t):
    return sec.visible_counts(entities(t), [CARRIER, WAREHOUSE, CUSTOMER, MIXED, ADMIN, NOBODY],
                              POLICY)


@query("rls_1_denied_table", views="s_invoices", sql="SELECT invoice_number FROM s_invoices WHERE false")
def _(t):
    return sec.secure(t.invoices, "invoices", CARRIER, POLICY).select("invoice_number")


@query("rls_2_carrier", views="s_shipments", sql=f"{SHIP} WHERE carrier_id = 'CARRIER-7'")
def _(t):
    return sec.secure(t.shipments, "shipments", CARRIER, POLICY).select(*SHIP_COLS)


@query("rls_2_warehouse", views="s_warehouse", sql="""
SELECT movement_id, warehouse_partner_id FROM s_warehouse
WHERE warehouse_partner_id = 'PARTNER-WH003'""")
def _(t):
    return sec.secure(t.warehouse, "warehouse", WAREHOUSE, POLICY).select(
        "movement_id", "warehouse_partner_id")


@query("rls_2_customer", views="s_invoices", sql="""
SELECT invoice_number, customer_id, payment_status FROM s_invoices WHERE customer_id = '7'""")
def _(t):
    return sec.secure(t.invoices, "invoices", CUSTOMER, POLICY).select(
        "invoice_number", "customer_id", "payment_status")


@query("rls_2_scope", views="s_orders", sql="""
SELECT order_number FROM s_orders WHERE partner_access_scope = 'CUSTOMER'""")
def _(t):
    reader = sec.Principal("reader", ("ScopeReader",))
    return sec.secure(t.orders, "orders", reader, POLICY).select("order_number")


@query("rls_3_two_roles", views="s_shipments",
       sql=f"{SHIP} WHERE carrier_id = 'CARRIER-7' OR customer_id = '7'")
def _(t):
    return sec.secure(t.shipments, "shipments", MIXED, POLICY).select(*SHIP_COLS)


@query("rls_4_admin", views="s_shipments", sql=SHIP)
def _(t):
    return sec.secure(t.shipments, "shipments", ADMIN, POLICY).select(*SHIP_COLS)


@query("rls_5_organization", views="s_shipments", sql="""
SELECT 'one' AS access, count(*) AS shipments FROM s_shipments
WHERE carrier_id = 'CARRIER-7' AND organization_id = 'ORG-3'
UNION ALL SELECT 'all', count(*) FROM s_shipments WHERE carrier_id = 'CARRIER-7'""")
def _(t):
    one = sec.Principal("a", attributes={"partner_id": "CARRIER-7", "organization_id": "ORG-3"})
    every = sec.Principal("b", attributes={"partner_id": "CARRIER-7",
                                           "organization_access": "ALL"})
    return union_all([t.shipments.filter(sec.organization_filter(p, "carrier_id",
                                                                 "organization_id"))
                      .agg(F.lit(name).alias("access"), F.count("*").alias("shipments"))
                      for name, p in (("one", one), ("all", every))])


@query("rls_6_department", views="s_shipments", sql=f"""
WITH {ACCESS} {SHIP} s WHERE EXISTS (SELECT 1 FROM access a WHERE a."user" = 'user-2'
  AND a.is_active AND a.partner = s.carrier_id AND a.organization = s.organization_id
  AND a.department = s.department)""")
def _(t):
    who = sec.Principal("user-2")
    return sec.by_access_table(t.shipments, access_table(t), who, {
        "carrier_id": "partner", "organization_id": "organization",
        "department": "department"}).select(*SHIP_COLS)


@query("rls_7_mapping_table", views="s_shipments", sql=f"""
WITH {ACCESS} {SHIP} WHERE carrier_id IN (SELECT partner FROM access
  WHERE "user" = 'user-3' AND is_active)""")
def _(t):
    return sec.by_access_table(t.shipments, access_table(t), sec.Principal("user-3"),
                               {"carrier_id": "partner"}).select(*SHIP_COLS)


@query("rls_8_time_bounded", views="s_shipments", sql=f"""
{SHIP} WHERE carrier_id = 'CARRIER-7' AND actual_ship_date::DATE >= {NOW}::DATE - 90""")
def _(t):
    mine = sec.secure(t.shipments, "shipments", CARRIER, POLICY)
    return sec.recent_only(mine, "actual_ship_date", as_of=t.as_of).select(*SHIP_COLS)


@query("rls_9_region", views="s_customers", sql="""
SELECT customer_id, region FROM s_customers WHERE region = 'EUROPE'""")
def _(t):
    who = sec.Principal("europe", attributes={"region": "EUROPE"})
    return t.customers.filter(sec.region_filter(who, "region")).select("customer_id", "region")


@query("rls_9_region_steward", views="s_customers", sql="SELECT customer_id, region FROM s_customers")
def _(t):
    who = sec.Principal("steward", ("DataSteward",))
    return t.customers.filter(sec.region_filter(who, "region")).select("customer_id", "region")


@query("rls_10_write_block", views="s_shipments", sql="""
SELECT 'accepted' AS part, count(*) AS row_count FROM s_shipments WHERE carrier_id = 'CARRIER-7'
UNION ALL SELECT 'rejected', count(*) FROM s_shipments WHERE carrier_id <> 'CARRIER-7'""")
def _(t):
    ok, rejected = sec.split_writes(t.shipments, "shipments", CARRIER, POLICY)
    return union_all([df.agg(F.lit(n).alias("part"), F.count("*").alias("row_count"))
                      for n, df in (("accepted", ok), ("rejected", rejected))])


@query("rls_11_audit_roles", sql=f"""
WITH {ACCESS} SELECT "user" AS principal, count(DISTINCT department) AS role_count,
  string_agg(DISTINCT department, ',' ORDER BY department) AS roles
FROM access WHERE is_active GROUP BY 1 HAVING count(DISTINCT department) > 1""")
def _(t):
    members = access_table(t).filter("is_active").select(
        C("user").alias("principal"), C("department").alias("role"))
    return sec.audit_members(members)


AUDITED = {"orders": 2, "shipments": 2, "invoices": 1, "warehouse": 1, "carriers": 0,
           "customers": 0}


@query("rls_11_audit_tables", views=" ".join(f"s_{n}" for n in AUDITED), sql=" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count, {k} AS filters FROM s_{n}"
    for n, k in AUDITED.items()))
def _(t):
    """Rows of each silver table, and the filters that the policy puts on it."""
    held = union_all([getattr(t, n).agg(F.lit(n).alias("table_name"), F.count("*")
                                        .alias("row_count")) for n in AUDITED])
    return sec.audit_tables(held, sec.policy_table(t.spark, POLICY))


@query("rls_12_scopes", views="s_shipments", sql="""
SELECT carrier_id, count(*) AS row_count FROM s_shipments GROUP BY 1""")
def _(t):
    return sec.scopes(t.shipments, "carrier_id")


@query("rls_12_preview", views="s_shipments", sql=f"""
SELECT shipment_number, carrier_id, planned_ship_date::VARCHAR AS planned_ship_date
FROM s_shipments WHERE carrier_id = 'CARRIER-7'
ORDER BY s_shipments.planned_ship_date DESC, shipment_number LIMIT 5""")
def _(t):
    return sec.preview(t.shipments, "shipments", CARRIER, POLICY, 5,
                       F.desc("planned_ship_date"), "shipment_number").select(
        "shipment_number", "carrier_id", "planned_ship_date")


@query("rls_12_checklist", views=ALL, sql=f"""
SELECT count(*) AS checks, {cnt('visible_rows > 0')} AS with_rows,
  count(*) = {cnt('visible_rows > 0')} AS all_visible FROM ({COUNTS})""")
def _(t):
    return sec.checklist(sec.visible_counts(
        entities(t), [CARRIER, WAREHOUSE, CUSTOMER, MIXED, ADMIN, NOBODY], POLICY))


# ---------------------------------------------------------------- masking

@query("msk_1_carrier_portal", views="s_shipments", sql="""
SELECT shipment_number, tracking_number, carrier_id, carrier_name, order_number,
  'Customer-' || left(customer_id, 3) AS customer_reference,
  sha256(customer_name) AS customer_name_hash, origin_country, destination_country,
  planned_ship_date::VARCHAR AS planned_ship_date, actual_ship_date::VARCHAR AS actual_ship_date,
  planned_delivery_date::VARCHAR AS planned_delivery_date,
  actual_delivery_date::VARCHAR AS actual_delivery_date,
  total_weight_kg::DOUBLE AS total_weight_kg, shipment_status,
  CASE WHEN actual_delivery_date <= planned_delivery_date THEN 'On-Time' ELSE 'Delayed' END
    AS delivery_performance
FROM s_shipments WHERE carrier_id <> '' AND shipment_status IN ('In Transit', 'Delivered',
  'Picked Up')""")
def _(t):
    return sec.carrier_portal(t.shipments)


@query("msk_2_warehouse_portal", views="s_warehouse", sql=f"""
SELECT {DAY.format('movement_timestamp')} AS movement_day, warehouse_id, warehouse_partner_id,
  material_id, movement_type, movement_timestamp::VARCHAR AS movement_timestamp,
  quantity::DOUBLE AS quantity, location_code, operator_id, processing_time_minutes, sap_system
FROM s_warehouse WHERE warehouse_partner_id <> ''""")
def _(t):
    return sec.warehouse_portal(t.warehouse)


@query("msk_3_customer_portal", views="s_orders s_shipments", sql=f"""
SELECT o.order_number, o.customer_id, o.customer_name, o.order_date::VARCHAR AS order_date,
  o.requested_delivery_date::VARCHAR AS requested_delivery_date, o.order_status,
  {money('o.total_amount')} AS order_value, s.shipment_number, s.carrier_name, s.tracking_number,
  s.shipment_status, s.actual_ship_date::VARCHAR AS shipped_at,
  s.actual_delivery_date::VARCHAR AS delivered_at, o.sla_status,
  CASE WHEN s.actual_delivery_date <= o.requested_delivery_date THEN 'On-Time'
    WHEN s.actual_delivery_date IS NOT NULL THEN 'Delayed' ELSE 'Pending' END AS delivery_status,
  o.sap_system
FROM s_orders o LEFT JOIN s_shipments s ON o.order_number = s.order_number
WHERE o.customer_id <> ''""")
def _(t):
    return sec.customer_portal(t.orders, t.shipments)


@query("msk_4_column_policy", views="s_shipments", sql="""
SELECT shipment_number, 'Customer-' || left(customer_id, 3) AS customer_id,
  'CONFIDENTIAL' AS customer_name, shipment_status FROM s_shipments""")
def _(t):
    rows = t.shipments.select("shipment_number", "customer_id", "customer_name",
                              "shipment_value", "shipment_status")
    return sec.mask(rows, "carrier")


# ---------------------------------------------------------------- partner queries

TREE = {"and": [{"shipment_status": {"eq": "In Transit"}},
                {"or": [{"carrier_id": {"startsWith": "CARRIER-1"}},
                        {"destination_country": {"contains": "_2"}}]},
                {"not": {"service_level": {"eq": "EXPRESS"}}},
                {"shipment_value": {"gt": 1000, "le": 90000}},
                {"total_weight_kg": {"ge": 2, "lt": 49}}, {"sap_system": {"ne": "DEV"}}]}
TREE_SQL = """shipment_status = 'In Transit' AND (carrier_id LIKE 'CARRIER-1%'
  OR destination_country LIKE '%\\_2%' ESCAPE '\\') AND NOT service_level = 'EXPRESS'
  AND shipment_value > 1000 AND shipment_value <= 90000 AND total_weight_kg >= 2
  AND total_weight_kg < 49 AND sap_system <> 'DEV'"""


@query("qry_1_filter_tree", views="s_shipments",
       sql=f"SELECT shipment_number, carrier_id FROM s_shipments WHERE {TREE_SQL}")
def _(t):
    return t.shipments.filter(ask.condition(t.shipments, TREE)).select(
        "shipment_number", "carrier_id")


@query("qry_2_order_by", views="s_shipments", sql="""
SELECT shipment_number, shipment_value::DOUBLE AS shipment_value FROM s_shipments
ORDER BY s_shipments.shipment_value DESC, shipment_number LIMIT 20""")
def _(t):
    return ask.query(t.shipments, None, [("shipment_value", "DESC")], key="shipment_number",
                     limit=20).select("shipment_number", "shipment_value")


@query("qry_3_offset_page", views="s_orders", sql="""
SELECT order_number, order_status FROM s_orders WHERE order_status = 'Pending'
ORDER BY s_orders.order_date DESC, order_number LIMIT 50 OFFSET 100""")
def _(t):
    return ask.query(t.orders, {"order_status": {"eq": "Pending"}}, [("order_date", "DESC")],
                     key="order_number", offset=100).select("order_number", "order_status")


@query("qry_3_total_count", views="s_orders", sql="""
SELECT count(*) AS total_count FROM s_orders WHERE order_status = 'Pending'""")
def _(t):
    return ask.total_count(t.orders, {"order_status": {"eq": "Pending"}})


@query("qry_4_keyset_page", views="s_orders", sql="""
SELECT order_number, order_date::VARCHAR AS order_date FROM s_orders
WHERE order_date < TIMESTAMP '2000-01-01 05:00:00' OR order_date = TIMESTAMP '2000-01-01 05:00:00'
  AND order_number > '5' ORDER BY s_orders.order_date DESC, order_number LIMIT 26""")
def _(t):
    after = ask.encode_cursor(["2000-01-01 05:00:00", "5"])
    return ask.page_rows(t.orders, [("order_date", "DESC")], key="order_number", first=25,
                         after=after).select("order_number", "order_date")


NULLABLE = ("actual_delivery_date", "shipment_number")


@query("qry_4_pages_over_nulls", views="s_shipments", sql="""
WITH r AS (SELECT 'ASC' AS direction, row_number() OVER (ORDER BY actual_delivery_date NULLS LAST,
      shipment_number) AS n, actual_delivery_date IS NULL AS open, * FROM s_shipments
    UNION ALL SELECT 'DESC', row_number() OVER (ORDER BY actual_delivery_date DESC NULLS LAST,
      shipment_number), actual_delivery_date IS NULL, * FROM s_shipments),
  c AS (SELECT direction, open, max(n) FILTER (WHERE shipment_number < '3') AS n, count(*) AS k
        FROM r GROUP BY 1, 2)
SELECT c.direction, c.open AS cursor_is_null, count(*) FILTER (WHERE r.n > c.n) AS rows_after,
  count(*) FILTER (WHERE r.n <= c.n) AS rows_before
FROM c JOIN r ON c.direction = r.direction GROUP BY ALL""")
def _(t):
    """Rows on either side of a cursor, at a date and within the nulls, in both directions."""
    parts = []
    for direction in ("ASC", "DESC"):
        order = [("actual_delivery_date", direction)]
        for is_null in (False, True):
            some = t.shipments.filter((C("actual_delivery_date").isNull() == is_null)
                                      & (C("shipment_number") < "3"))
            back = [C(n).desc() if (d == "ASC") else C(n).asc()
                    for n, d in [*order, ("shipment_number", "ASC")]]
            last = some.orderBy(*back).select(*NULLABLE).first()
            if last is None:
                continue
            after = ask.beyond(t.shipments, order, key="shipment_number",
                               after=ask.encode_cursor(list(last)))
            parts.append(t.shipments.agg(
                F.lit(direction).alias("direction"), F.lit(is_null).alias("cursor_is_null"),
                F.count_if(after).alias("rows_after"), F.count_if(~after).alias("rows_before")))
    return union_all(parts)


@query("qry_5_shipments", views="s_shipments", sql="""
SELECT shipment_number, shipment_status FROM s_shipments WHERE shipment_status = 'Delivered'
  AND planned_ship_date BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-12-31'
ORDER BY s_shipments.planned_ship_date DESC, shipment_number LIMIT 50""")
def _(t):
    where = ask.shipments_query("Delivered", "1999-01-01 00:00:00", "1999-12-31 00:00:00")
    return ask.query(t.shipments, where, [("planned_ship_date", "DESC")],
                     key="shipment_number").select("shipment_number", "shipment_status")


@query("qry_5_shipment_by_number", views="s_shipments", sql="""
SELECT shipment_number, tracking_number, carrier_id FROM s_shipments
WHERE tracking_number = 'TRK100x1'""")
def _(t):
    return ask.query(t.shipments, ask.shipments_query(tracking_number="TRK100x1"),
                     key="shipment_number").select("shipment_number", "tracking_number",
                                                   "carrier_id")


@query("qry_6_orders", views="s_orders", sql="""
SELECT order_number, sla_status FROM s_orders WHERE order_status = 'Delivered'
  AND order_date >= TIMESTAMP '2000-01-01' AND order_date <= TIMESTAMP '2000-03-01'
  AND sla_status = 'Missed' ORDER BY s_orders.order_date DESC, order_number LIMIT 100""")
def _(t):
    where = ask.orders_query("Delivered", "2000-01-01 00:00:00", "2000-03-01 00:00:00", "Missed")
    return ask.query(t.orders, where, [("order_date", "DESC")], key="order_number",
                     limit=100).select("order_number", "sla_status")


@query("qry_7_movements", views="s_warehouse", sql="""
SELECT movement_id, warehouse_id FROM s_warehouse WHERE warehouse_id = 'WH002'
  AND movement_type = 'GI' AND movement_timestamp >= TIMESTAMP '2000-06-01'
ORDER BY s_warehouse.movement_timestamp, movement_id LIMIT 50""")
def _(t):
    where = ask.movements_query("WH002", "GI", "2000-06-01 00:00:00")
    return ask.query(t.warehouse, where, [("movement_timestamp", "ASC")],
                     key="movement_id").select("movement_id", "warehouse_id")


@query("qry_8_invoices", views="s_invoices", sql="""
SELECT invoice_number, payment_status, aging_bucket FROM s_invoices
WHERE strftime(invoice_date, '%Y-%m') = '2000-12' AND payment_status = 'Overdue'
  AND aging_bucket = '90+' ORDER BY invoice_number LIMIT 100""")
def _(t):
    where = ask.invoices_query("2000-12", "Overdue", "90+")
    return ask.query(t.invoices, where, key="invoice_number", limit=100).select(
        "invoice_number", "payment_status", "aging_bucket")


@query("qry_9_kpi_period", views="s_shipments", sql=f"""
SELECT carrier_id AS group_key, 'ON_TIME_DELIVERY_RATE' AS metric,
  {pct(cnt('actual_delivery_date IS NOT NULL AND is_on_time'), cnt('actual_delivery_date IS NOT NULL'))}
  AS value FROM s_shipments WHERE actual_ship_date >= TIMESTAMP '1999-01-01'
  AND actual_ship_date < TIMESTAMP '2000-01-01' GROUP BY 1""")
def _(t):
    return kpi(t, "ON_TIME_DELIVERY_RATE", ("1999-01-01 00:00:00", "2000-01-01 00:00:00"),
               "CARRIER", as_of=t.as_of)


DONE = "actual_delivery_date IS NOT NULL"
METRICS = f"""count(*) AS total_shipments, {cnt(f'{DONE} AND is_on_time')} AS on_time_shipments,
  {cnt(f'{DONE} AND NOT is_on_time')} AS late_shipments,
  {pct(cnt(f'{DONE} AND is_on_time'), cnt(DONE))} AS on_time_rate,
  {avg('transit_time_hours')} AS avg_transit_hours, {total('value_c')} AS total_value,
  sum(total_weight_kg)::DOUBLE AS total_weight"""
RANGE = "actual_ship_date >= TIMESTAMP '1999-01-01' AND actual_ship_date < TIMESTAMP '2001-01-01'"
SPAN = ("1999-01-01 00:00:00", "2001-01-01 00:00:00")
UNIT_SQL = {
    "DAY": "CAST(actual_ship_date AS DATE)",
    "WEEK": "CAST(actual_ship_date AS DATE) - dayofweek(actual_ship_date)::INTEGER",
    "MONTH": "CAST(date_trunc('month', actual_ship_date) AS DATE)",
    "QUARTER": "CAST(date_trunc('quarter', actual_ship_date) AS DATE)",
    "YEAR": "CAST(date_trunc('year', actual_ship_date) AS DATE)",
}
for _unit, _expr in UNIT_SQL.items():
    @query(f"qry_10_metrics_{_unit.lower()}", views="s_shipments", sql=f"""
SELECT ({_expr})::VARCHAR AS period, {METRICS} FROM s_shipments WHERE {RANGE} GROUP BY 1""")
    def _(t, unit=_unit):
        return ask.shipment_metrics(t.shipments, *SPAN, unit)


@query("qry_10_summary", views="s_shipments",
       sql=f"SELECT {METRICS} FROM s_shipments WHERE {RANGE}")
def _(t):
    return ask.shipment_summary(t.shipments, *SPAN)


@query("qry_11_on_time_rate", views="s_shipments", sql=f"""
SELECT {pct(cnt(f'{DONE} AND is_on_time'), cnt(DONE))} AS on_time_rate
FROM s_shipments WHERE {RANGE} AND carrier_id = 'CARRIER-3'""")
def _(t):
    return ask.on_time_rate(t.shipments, *SPAN, carrier_id="CARRIER-3")


@query("qry_11_delivery_time", views="s_shipments", sql=f"""
SELECT {avg('transit_time_hours')} AS average_delivery_hours FROM s_shipments WHERE {RANGE}""")
def _(t):
    return ask.average_delivery_time(t.shipments, *SPAN)


@query("qry_12_search", views="s_shipments s_orders s_customers", sql="""
SELECT * FROM (SELECT 'customer' AS type, customer_id AS id, customer_name AS label
  FROM s_customers WHERE contains(lower(customer_name), '0000012')
UNION ALL SELECT 'order', order_number, order_number || ' | ' || customer_name FROM s_orders
  WHERE contains(order_number, '0000012') OR contains(lower(customer_name), '0000012')
UNION ALL SELECT 'shipment', shipment_number, tracking_number || ' | ' || customer_name
  FROM s_shipments WHERE contains(lower(tracking_number), '0000012')
     OR contains(lower(customer_name), '0000012'))
ORDER BY type, id LIMIT 60""".replace("SELECT * FROM", "SELECT *, count(*) OVER () AS total FROM"))
def _(t):
    tables = {"customer": (t.customers, "customer_id", ["customer_name"]),
              "order": (t.orders, "order_number", ["order_number", "customer_name"]),
              "shipment": (t.shipments, "shipment_number", ["tracking_number",
                                                            "customer_name"])}
    return ask.search(tables, "0000012", ["customer", "order", "shipment"], 60)


@query("qry_13_shipment_filters", views="s_shipments", sql="""
SELECT shipment_number, carrier_id FROM s_shipments
WHERE shipment_status IN ('Delivered') AND origin_country IN ('NATION_3', 'NATION_4')
  AND destination_country IN ('NATION_1', 'NATION_2', 'NATION_5') AND is_on_time = false
  AND shipment_value >= 20000.0 AND shipment_value <= 60000.0""")
def _(t):
    where = ask.shipment_filters(statuses=["Delivered"], on_time=False,
                                 origin_countries=["NATION_3", "NATION_4"],
                                 destination_countries=["NATION_1", "NATION_2", "NATION_5"],
                                 min_value=20000.0, max_value=60000.0)
    return t.shipments.filter(ask.condition(t.shipments, where)).select(
        "shipment_number", "carrier_id")


@query("qry_14_high_revenue_days", views="g_orders", sql=f"""
SELECT order_day, sap_system, sla_status, total_orders, total_revenue, avg_order_value
FROM (SELECT {ORDER_DAY} AS order_day, sap_system, sla_status, {BY_SLA}
      FROM g_orders GROUP BY ALL) WHERE total_revenue > 1000000""")
def _(t):
    daily = gold.orders_by_sla(t.gold_order_facts)
    return daily.filter(ask.condition(daily, {"total_revenue": {"gt": 1000000}})).select(
        "order_day", "sap_system", "sla_status", "total_orders", "total_revenue",
        "avg_order_value")


@query("qry_14_high_pending", views="s_invoices", sql=f"""
SELECT invoice_day, customer_id, sap_system, total_revenue, total_due
FROM ({RECOGNITION}) WHERE total_due > 400000""")
def _(t):
    daily = gold.revenue_recognition(t.invoices)
    return daily.filter(ask.condition(daily, {"total_due": {"gt": 400000}})).select(
        "invoice_day", "customer_id", "sap_system", "total_revenue", "total_due")


CARRIER_SLA = f"""SELECT carrier_id, {cnt('is_on_time')} AS ontime_shipments,
  {cnt('NOT is_on_time')} AS late_shipments, count(*) AS total_shipments,
  {pct(cnt('is_on_time'), 'count(*)')} AS ontime_percentage,
  {avg('delivery_delay_hours')} AS avg_delay_hours
FROM s_shipments WHERE {DONE} GROUP BY carrier_id"""


@query("qry_14_good_carriers", views="s_shipments",
       sql=f"SELECT * FROM ({CARRIER_SLA}) WHERE ontime_percentage > 50")
def _(t):
    rows = ask.carrier_sla(t.shipments)
    return rows.filter(ask.condition(rows, {"ontime_percentage": {"gt": 50}}))


@query("qry_14_poor_carriers", views="s_shipments",
       sql=f"SELECT * FROM ({CARRIER_SLA}) WHERE ontime_percentage < 50")
def _(t):
    rows = ask.carrier_sla(t.shipments)
    return rows.filter(ask.condition(rows, {"ontime_percentage": {"lt": 50}}))


@query("qry_14_carrier_ranking", views="s_shipments", sql=f"""
SELECT * FROM ({CARRIER_SLA}) ORDER BY ontime_percentage DESC, carrier_id LIMIT 10""")
def _(t):
    return ask.query(ask.carrier_sla(t.shipments), None, [("ontime_percentage", "DESC")],
                     key="carrier_id", limit=10)


@query("qry_14_revenue_trend", views="s_invoices", sql=f"""
SELECT {DAY.format('invoice_date')} AS invoice_day, sap_system, {total('total_c')} AS revenue
FROM s_invoices WHERE invoice_date BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2000-03-31'
GROUP BY 1, 2""")
def _(t):
    rows = t.invoices.filter(ask.condition(t.invoices, {
        "invoice_date": {"ge": "2000-01-01 00:00:00", "le": "2000-03-31 00:00:00"}}))
    return rows.groupBy(F.to_date("invoice_date").alias("invoice_day"), "sap_system").agg(
        F.sum("total_amount").alias("revenue")).orderBy("invoice_day", "sap_system")


@query("qry_15_carrier_sla", views="s_shipments", sql=CARRIER_SLA)
def _(t):
    return ask.carrier_sla(t.shipments)
