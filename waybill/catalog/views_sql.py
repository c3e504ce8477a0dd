"""DuckDB form of the frames in ``sources.driver_tables``, and exact rounding in SQL.

Money is carried twice: as ``x`` (decimal) and, where a ratio needs it, as ``x_c`` (whole cents),
because decimal division gives a binary floating-point number there.
"""

from __future__ import annotations

from waybill.sources.driver_tables import ENTITY_AS_OF, MESSAGE_AS_OF

NOW = f"TIMESTAMP '{ENTITY_AS_OF}'"
MNOW = f"TIMESTAMP '{MESSAGE_AS_OF}'"

SYSTEM = "CASE {0} % 3 WHEN 0 THEN 'PRD' WHEN 1 THEN 'QAS' ELSE 'DEV' END"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw": ((), """
        SELECT event_id::VARCHAR AS docnum,
               CASE event_type WHEN 'purchase' THEN 'ORDERS' WHEN 'click' THEN 'WHSCON'
                    WHEN 'view' THEN 'SHPMNT' WHEN 'signup' THEN 'INVOIC' ELSE 'DESADV' END
                    AS message_type,
               CASE event_type WHEN 'purchase' THEN 'ORDERS05' WHEN 'click' THEN 'WHSCON01'
                    WHEN 'view' THEN 'SHPMNT05' WHEN 'signup' THEN 'INVOIC02'
                    ELSE 'DESADV01' END AS idoc_type,
               CASE user_id % 3 WHEN 0 THEN 'PRD' WHEN 1 THEN 'QAS' ELSE 'DEV' END AS sap_system,
               CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN '51' ELSE '03' END
                    AS status,
               ts AS "timestamp",
               ts + to_seconds(event_id % 400) AS ingestion_time,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               props AS data, user_id::VARCHAR AS sender, value::DECIMAL(18,2) AS value
        FROM events"""),
    "orders_timed": ((), """
        SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice,
               o_orderdate + to_hours(o_orderkey % 24) AS order_date,
               o_orderdate + to_hours(o_orderkey % 24 + 12 + o_orderkey % 60) AS ship_ts,
               o_orderdate + to_hours(o_orderkey % 24 + 12 + o_orderkey % 60
                                      + 24 * (1 + o_custkey % 6)) AS del_ts
        FROM orders"""),
    "s_orders": (("orders_timed",), f"""
        SELECT b.*, CASE WHEN order_number::BIGINT % 20 = 0 THEN 'Cancelled'
                    WHEN actual_delivery_date IS NOT NULL THEN 'Delivered'
                    WHEN actual_ship_date IS NOT NULL THEN 'Shipped' ELSE 'Pending' END
                    AS order_status,
               CASE WHEN actual_ship_date IS NOT NULL THEN
                    CASE WHEN date_diff('hour', order_date, actual_ship_date) <= 24 THEN 'Met'
                         ELSE 'Missed' END
                    WHEN order_age_hours < 20 THEN 'Good' WHEN order_age_hours < 24 THEN 'At Risk'
                    ELSE 'Breached' END AS sla_status,
               order_age_hours > 24 AS is_delayed
        FROM (SELECT o_orderkey::VARCHAR AS order_number, o_custkey::VARCHAR AS customer_id,
                     c_name AS customer_name, order_date,
                     order_date + INTERVAL 7 DAY AS requested_delivery_date,
                     order_date + to_days((3 + o_orderkey % 5)::INTEGER) AS promised_delivery_date,
                     CASE WHEN ship_ts <= {NOW} AND o_orderkey % 7 <> 0 AND o_orderkey % 20 <> 0
                          THEN ship_ts END AS actual_ship_date,
                     CASE WHEN del_ts <= {NOW} AND o_orderkey % 7 <> 0 AND o_orderkey % 20 <> 0
                          THEN del_ts END AS actual_delivery_date,
                     CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'High'
                          WHEN o_orderpriority = '3-MEDIUM' THEN 'Medium' ELSE 'Low' END
                          AS priority,
                     o_totalprice::DECIMAL(18,2) AS total_amount,
                     round(o_totalprice * 100)::BIGINT AS total_c,
                     CASE c_nationkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END
                          AS currency,
                     date_diff('hour', order_date, {NOW}) AS order_age_hours,
                     {SYSTEM.format('o_orderkey')} AS sap_system,
                     'CUSTOMER' AS partner_access_scope
              FROM orders_timed JOIN customer ON o_custkey = c_custkey) b"""),
    "g_orders": (("s_orders",), f"""
        SELECT * REPLACE (CASE WHEN taken <= 20 THEN 'Good' WHEN taken <= 24 THEN 'At Risk'
                          ELSE 'Breached' END AS sla_status)
        FROM (SELECT *, date_diff('hour', order_date, coalesce(actual_ship_date, {NOW}))
                     AS taken FROM s_orders)"""),
    "h_orders": (("s_orders",), f"""
        SELECT * REPLACE (CASE WHEN taken < 12 THEN 'Good' WHEN taken < 24 THEN 'At Risk'
                          ELSE 'Breached' END AS sla_status)
        FROM (SELECT *, date_diff('hour', order_date, coalesce(actual_ship_date, {NOW}))
                     AS taken FROM s_orders)"""),
    "g_orders_lines": (("g_orders", "s_orders_lines"), """
        SELECT l.* REPLACE (o.sla_status AS sla_status)
        FROM s_orders_lines l JOIN g_orders o ON l.order_number = o.order_number"""),
    "s_lines": ((), """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
                 l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC,
                 l_quantity DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                 l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1"""),
    "s_order_lines": (("s_lines",), """
        SELECT l_orderkey::VARCHAR AS order_number, l_linenumber AS item_number,
               l_partkey::VARCHAR AS material_id, l_quantity::DECIMAL(15,3) AS quantity,
               l_extendedprice::DECIMAL(18,2) AS net_amount FROM s_lines"""),
    "s_orders_lines": (("s_orders", "s_lines"), """
        SELECT o.*, coalesce(n, 0) AS total_lines, coalesce(q, 0)::BIGINT AS total_quantity,
               coalesce(q, 0)::BIGINT AS total_weight_kg
        FROM s_orders o LEFT JOIN (SELECT l_orderkey::VARCHAR AS k, count(*) AS n,
             sum(l_quantity::BIGINT) AS q FROM s_lines GROUP BY 1) l ON o.order_number = l.k"""),
    "s_shipments": (("orders_timed", "s_lines"), f"""
        SELECT *, date_diff('hour', planned_ship_date, actual_ship_date) AS ship_delay_hours,
               date_diff('hour', planned_delivery_date, actual_delivery_date)
                   AS delivery_delay_hours,
               date_diff('hour', actual_ship_date, actual_delivery_date) AS transit_time_hours,
               actual_delivery_date <= planned_delivery_date AS is_on_time,
               actual_ship_date IS NOT NULL AND actual_delivery_date IS NULL AS is_in_transit,
               CASE WHEN actual_delivery_date IS NOT NULL THEN 'Delivered'
                    WHEN actual_ship_date IS NOT NULL THEN 'In Transit' ELSE 'Planned' END
                    AS shipment_status
        FROM (SELECT l_orderkey || '-' || l_linenumber AS shipment_number,
                     'TRK' || l_orderkey || 'x' || l_linenumber AS tracking_number,
                     l_orderkey::VARCHAR AS order_number, o_custkey::VARCHAR AS customer_id,
                     c_name AS customer_name, 'CARRIER-' || (l_suppkey % 20) AS carrier_id,
                     'Carrier ' || (l_suppkey % 20) AS carrier_name,
                     CASE l_partkey % 2 WHEN 0 THEN 'STANDARD' ELSE 'EXPRESS' END
                         AS service_level,
                     'NATION_' || (l_suppkey % 25) AS origin_country,
                     n_name AS destination_country,
                     order_date + INTERVAL 1 DAY AS planned_ship_date,
                     CASE WHEN left_ts <= {NOW} THEN left_ts END AS actual_ship_date,
                     left_ts + to_days((2 + l_partkey % 5)::INTEGER) AS planned_delivery_date,
                     CASE WHEN left_ts + to_days((1 + l_suppkey % 8)::INTEGER) <= {NOW}
                           AND l_suppkey % 25 <> 0
                          THEN left_ts + to_days((1 + l_suppkey % 8)::INTEGER) END
                         AS actual_delivery_date,
                     l_extendedprice::DECIMAL(18,2) AS shipment_value,
                     round(l_extendedprice * 100)::BIGINT AS value_c,
                     l_quantity::BIGINT AS total_weight_kg,
                     'LOC-' || (l_suppkey % 25) AS origin_location,
                     'LOC-' || c_nationkey AS destination_location,
                     CASE l_suppkey % 4 WHEN 0 THEN 'Road' WHEN 1 THEN 'Rail' WHEN 2 THEN 'Air'
                          ELSE 'Sea' END AS transport_mode,
                     1 + l_quantity::BIGINT % 7 AS total_packages,
                     l_quantity::BIGINT * (l_partkey % 40 + 1) AS litres,
                     {SYSTEM.format('l_orderkey')} AS sap_system,
                     'ORG-' || (l_suppkey % 4) AS organization_id,
                     'DEPT-' || (l_partkey % 3) AS department,
                     'CARRIER_CUSTOMER' AS partner_access_scope
              FROM (SELECT l.*, o.o_custkey, o.order_date,
                           o.order_date + to_hours(12 + (l_orderkey + l_linenumber) % 96)
                               AS left_ts
                    FROM s_lines l JOIN orders_timed o ON l_orderkey = o_orderkey)
              JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey)"""),
    "s_warehouse": (("s_lines",), f"""
        SELECT 'MV-' || l_orderkey || '-' || l_linenumber AS movement_id,
               'WH00' || (l_suppkey % 5 + 1) AS warehouse_id,
               CASE WHEN l_suppkey % 5 + 1 >= 3 THEN 'PARTNER-WH00' || (l_suppkey % 5 + 1)
                    ELSE '' END AS warehouse_partner_id,
               CASE l_linenumber % 4 WHEN 0 THEN 'GR' WHEN 1 THEN 'GI' WHEN 2 THEN 'TR'
                    ELSE 'CC' END AS movement_type,
               l_shipdate + to_hours(l_partkey % 24) AS movement_timestamp,
               l_quantity::BIGINT AS quantity, l_quantity::BIGINT AS weight_kg,
               l_quantity::BIGINT * (l_partkey % 40 + 1) AS litres,
               l_partkey::VARCHAR AS material_id, 'OP-' || (l_partkey % 50) AS operator_id,
               'EQ-' || (l_partkey % 20) AS equipment_id, 'Z' || (l_partkey % 4) AS zone,
               'LOC-' || (l_partkey % 4) || '-' || (l_suppkey % 9) AS location_code,
               l_partkey % 500 AS processing_time_minutes,
               l_returnflag = 'R' AS exception_flag,
               CASE WHEN l_returnflag = 'R' THEN CASE l_suppkey % 3 WHEN 0 THEN 'Damage'
                    WHEN 1 THEN 'Shortage' ELSE 'Quality' END END AS exception_type,
               l_linestatus = 'O' AS inspection_required,
               CASE l_returnflag WHEN 'A' THEN 'OK' WHEN 'N' THEN 'Hold' ELSE 'Rejected' END
                    AS quality_status,
               l_orderkey::VARCHAR AS order_number,
               {SYSTEM.format('l_orderkey')} AS sap_system,
               'WAREHOUSE_PARTNER' AS partner_access_scope
        FROM s_lines"""),
    "s_invoices": (("s_lines",), f"""
        SELECT *, days_overdue > 0 AND payment_status <> 'Paid' AS is_overdue,
               CASE WHEN NOT (days_overdue > 0 AND payment_status <> 'Paid') THEN 'Current'
                    WHEN days_overdue <= 30 THEN '1-30' WHEN days_overdue <= 60 THEN '31-60'
                    WHEN days_overdue <= 90 THEN '61-90' ELSE '90+' END AS aging_bucket,
               CASE WHEN payment_date <= due_date THEN 100 ELSE 0 END AS payment_efficiency
        FROM (SELECT *, total_c - paid_c AS due_c,
                     (total_c / 100)::DECIMAL(18,2) AS total_amount,
                     (paid_c / 100)::DECIMAL(18,2) AS amount_paid,
                     ((total_c - paid_c) / 100)::DECIMAL(18,2) AS amount_due,
                     CASE WHEN paid_c >= total_c THEN 'Paid' WHEN paid_c > 0 THEN 'Partial'
                          WHEN date_diff('day', due_date, {NOW}) > 0 THEN 'Overdue'
                          ELSE 'Pending' END AS payment_status,
                     date_diff('day', due_date, {NOW}) AS days_overdue
              FROM (SELECT *, CASE WHEN o_orderkey % 4 = 1 THEN (total_c + 1) // 2
                                   WHEN payment_date IS NOT NULL THEN total_c ELSE 0 END AS paid_c
                    FROM (SELECT o_orderkey, 'INV-' || o_orderkey AS invoice_number,
                                 o_orderkey::VARCHAR AS order_number,
                                 o_custkey::VARCHAR AS customer_id,
                                 CASE o_orderkey % 5 WHEN 1 THEN 'Credit' WHEN 2 THEN 'Debit'
                                      WHEN 3 THEN 'Pro-forma' ELSE 'Standard' END AS invoice_type,
                                 o_orderdate AS invoice_date,
                                 o_orderdate + INTERVAL 30 DAY AS due_date,
                                 CASE WHEN o_orderkey % 4 >= 2
                                       AND o_orderdate + to_days((o_orderkey % 60)::INTEGER)
                                           <= {NOW}
                                      THEN o_orderdate + to_days((o_orderkey % 60)::INTEGER) END
                                      AS payment_date,
                                 sub_c, disc_c, tax_c, sub_c + tax_c - disc_c AS total_c,
                                 total_line_items,
                                 CASE o_orderkey % 3 WHEN 0 THEN 'Storage'
                                      WHEN 1 THEN 'Transportation' ELSE 'Handling' END
                                      AS service_type,
                                 o_orderkey % 17 = 0 AS is_disputed,
                                 CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 45 - 5 END
                                      AS margin,
                                 year(o_orderdate) AS fiscal_year,
                                 month(o_orderdate) AS fiscal_period,
                                 CASE o_custkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR'
                                      ELSE 'GBP' END AS currency,
                                 {SYSTEM.format('o_orderkey')} AS sap_system,
                                 'CUSTOMER' AS partner_access_scope
                          FROM orders JOIN (
                            SELECT l_orderkey, sum(p)::BIGINT AS sub_c, count(*) AS total_line_items,
                                   sum((p * d + 50) // 100)::BIGINT AS disc_c,
                                   sum((p * (100 - d) * t + 5000) // 10000)::BIGINT AS tax_c
                            FROM (SELECT l_orderkey, round(l_extendedprice * 100)::BIGINT AS p,
                                         round(l_discount * 100)::BIGINT AS d,
                                         round(l_tax * 100)::BIGINT AS t FROM s_lines)
                            GROUP BY l_orderkey) ON o_orderkey = l_orderkey)))"""),
    "s_customers": ((), """
        SELECT c_custkey::VARCHAR AS customer_id, c_name AS customer_name,
               c_mktsegment AS segment, n_name AS country, r_name AS region
        FROM customer JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey"""),
    "s_carriers": ((), """
        SELECT DISTINCT 'CARRIER-' || (s_suppkey % 20) AS carrier_id,
               'Carrier ' || (s_suppkey % 20) AS carrier_name, 'SC' || (s_suppkey % 20) AS scac
        FROM supplier"""),
    "s_locations": ((), """
        SELECT 'LOC-' || n_nationkey AS location_id, n_name AS country, r_name AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    "s_warehouses": ((), """
        SELECT DISTINCT 'WH00' || (s_suppkey % 5 + 1) AS warehouse_id,
               'Warehouse ' || (s_suppkey % 5 + 1) AS warehouse_name,
               CASE WHEN s_suppkey % 5 + 1 >= 3 THEN 'PARTNER-WH00' || (s_suppkey % 5 + 1)
                    ELSE '' END AS partner_id,
               s_suppkey % 5 + 1 >= 3 AS is_partner_operated FROM supplier"""),
}


def with_views(names: str, body: str) -> str:
    """``body`` preceded by the common table expressions it needs."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for dep in VIEWS[name][0]:
            need(dep)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        need(name)
    body = body.strip()
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in ordered)
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def rnd(num: str, den: str = "1", scale: int = 2, cents: int = 0, factor: int = 1) -> str:
    """``factor * num / den`` rounded half away from zero, for whole numbers in SQL.

    ``cents`` is the power of ten ``num`` carries over ``den`` (2 for cents per piece).
    """
    n = f"({num})::HUGEINT * {factor * 10 ** scale}"
    d = f"(({den})::HUGEINT * {10 ** cents})"
    body = f"(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})))::DOUBLE / {10 ** scale}"
    return f"CASE WHEN {d} > 0 THEN {body} END"


def pct(num: str, den: str, scale: int = 2) -> str:
    return rnd(num, den, scale, factor=100)


def avg(value: str, scale: int = 2, cents: int = 0) -> str:
    return rnd(f"sum({value})", f"count({value})", scale, cents)


def money(value: str) -> str:
    return f"({value})::DOUBLE"


def total(value: str) -> str:
    """Sum of cents as an amount."""
    return f"(sum({value})::DOUBLE / 100)"
