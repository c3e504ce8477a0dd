"""Registered quality rules, roll-ups and checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import functions as F

from waybill.catalog.base import query, stored
from waybill.catalog.gold import BY_SLA, ORDER_DAY, WH_DAILY, RECOGNITION, SLA_DAILY, cnt
from waybill.catalog.views_sql import MNOW, NOW, pct
from waybill.operators import quality as q
from waybill.operators.rows import missing_keys
from waybill.plans import gold

C = F.col
ALL_VIEWS = ("raw s_orders g_orders s_shipments s_warehouse s_invoices s_carriers s_customers "
             "s_warehouses s_order_lines")


class Frames(Mapping):
    """Tables the rules name, built on first use."""

    def __init__(self, t):
        self._make = {
            "raw": lambda: t.raw, "orders": lambda: t.gold_orders,
            "shipments": lambda: t.shipments,
            "warehouse": lambda: t.warehouse, "invoices": lambda: t.invoices,
            "carriers": lambda: t.carriers, "customers": lambda: t.customers,
            "warehouses": lambda: t.warehouses,
            "bronze_rows": lambda: t.table("lineitem"), "silver_rows": lambda: t.shipments,
            "gold_orders": lambda: gold.orders_by_sla(t.gold_order_facts),
            "deliveries": lambda: t.shipments.filter(C("actual_delivery_date").isNotNull())
            .withColumnRenamed("shipment_number", "delivery_number"),
            "invoice_lines": lambda: t.invoices.join(
                t.order_lines.groupBy("order_number").agg(F.sum("net_amount")
                                                          .alias("line_total")),
                "order_number", "left"),
        }

    def __getitem__(self, name):
        return self._make[name]()

    def __iter__(self):
        return iter(self._make)

    def __len__(self):
        return len(self._make)


# SQL of each rule: (view, condition of a bad row) or the counts themselves
AGE = "CASE WHEN taken <= 20 THEN 'Good' WHEN taken <= 24 THEN 'At Risk' ELSE 'Breached' END"
BUCKET = ("CASE WHEN payment_status = 'Paid' OR days_overdue <= 0 THEN 'Current' WHEN days_overdue <= 30 THEN '1-30' "
          "WHEN days_overdue <= 60 THEN '31-60' WHEN days_overdue <= 90 THEN '61-90' "
          "ELSE '90+' END")
BAD = {
    "BRZ-001": ("raw", "docnum IS NULL OR data IS NULL"),
    "BRZ-002": ("raw", "message_type NOT IN ('ORDERS', 'SHPMNT', 'DESADV', 'WHSCON', 'INVOIC')"),
    "BRZ-004": ("raw", "date_diff('second', \"timestamp\", ingestion_time) > 30"),
    "SLV-ORD-001": ("s_orders", "order_number IS NULL OR order_number = ''"),
    "SLV-ORD-002": ("s_orders", "customer_id IS NULL OR customer_id = ''"),
    "SLV-ORD-003": ("s_orders", "requested_delivery_date <= order_date"),
    "SLV-ORD-004": ("s_orders", "total_amount <= 0"),
    "SLV-ORD-005": ("g_orders", f"sla_status <> {AGE}"),
    "SLV-SHP-002": ("s_shipments", "carrier_id NOT IN (SELECT carrier_id FROM s_carriers)"),
    "SLV-SHP-003": ("s_shipments", "is_in_transit AND (actual_ship_date IS NULL OR "
                                   "actual_delivery_date IS NOT NULL)"),
    "SLV-SHP-004": ("s_shipments", "transit_time_hours NOT BETWEEN 0 AND 720"),
    "SLV-WHS-001": ("s_warehouse",
                    "movement_type NOT IN ('GR', 'GI', 'TR', 'CC', 'PI', 'PA', 'RT')"),
    "SLV-WHS-002": ("s_warehouse", "quantity <= 0"),
    "SLV-WHS-004": ("s_warehouse", "processing_time_minutes NOT BETWEEN 1 AND 480"),
    "SLV-INV-002": ("s_invoices", "abs(total_c - (sub_c + tax_c - disc_c)) > 1"),
    "SLV-INV-003": ("s_invoices", f"aging_bucket <> {BUCKET}"),
    "SLV-INV-004": ("s_invoices", "payment_efficiency NOT BETWEEN 0 AND 200"),
    "REF-002": ("s_orders", "NOT total_amount > 0"),
    "REF-003": ("s_orders", f"order_date > {NOW}"),
    "REF-004": ("s_shipments", "shipment_status <> 'Pending' AND tracking_number = ''"),
    "REF-005": ("s_shipments", "actual_delivery_date < actual_ship_date"),
    "REF-006": ("s_invoices", "sub_c <> (SELECT sum(round(net_amount * 100)::BIGINT) FROM "
                              "s_order_lines l WHERE l.order_number = s_invoices.order_number)"),
    "REF-007": ("s_invoices", "due_date < invoice_date"),
    "REF-008": ("s_warehouse", "movement_type IN ('GR', 'GI') AND NOT quantity > 0"),
    "FK-001": ("s_orders", "customer_id NOT IN (SELECT customer_id FROM s_customers)"),
    "FK-002": ("s_shipments", "order_number NOT IN (SELECT order_number FROM s_orders)"),
    "FK-003": ("s_orders", "order_number NOT IN (SELECT order_number FROM s_invoices)"),
    "FK-004": ("(SELECT shipment_number AS delivery_number FROM s_shipments "
               "WHERE actual_delivery_date IS NOT NULL)",
               "delivery_number NOT IN (SELECT shipment_number FROM s_shipments)"),
    "FK-005": ("s_warehouse", "warehouse_id NOT IN (SELECT warehouse_id FROM s_warehouses)"),
    "FK-006": ("s_shipments", "carrier_id NOT IN (SELECT carrier_id FROM s_carriers)"),
}
UNIQUE = {"BRZ-003": ("raw", "docnum"), "SLV-SHP-001": ("s_shipments", "shipment_number"),
          "SLV-INV-001": ("s_invoices", "invoice_number"), "REF-001": ("s_orders", "order_number")}


# What is broken in some rows of each rule's table, so that a rule that finds nothing turns red:
# column, which rows, the bad value, and the same for the SQL side where its column differs.
# Both engines read the expressions. Rules that the tables break by themselves are left out.
def _some(key: str) -> str:
    return f"CAST({key} AS BIGINT) % 97 = 0"


ORDER = _some("order_number")
FAULTS: dict[str, tuple[str, ...]] = {
    "BRZ-001": ("data", _some("docnum"), "NULL"),
    "BRZ-002": ("message_type", _some("docnum"), "'UNKNOWN'"),
    "BRZ-003": ("docnum", _some("docnum"), "'0'"),
    "SLV-ORD-001": ("order_number", _some("customer_id"), "''"),
    "SLV-ORD-002": ("customer_id", ORDER, "NULL"),
    "SLV-ORD-003": ("requested_delivery_date", ORDER, "order_date"),
    "SLV-ORD-004": ("total_amount", ORDER, "CAST(-1 AS DECIMAL(18,2))"),
    "SLV-ORD-005": ("sla_status", ORDER, "CASE sla_status WHEN 'Good' THEN 'Breached' "
                                         "ELSE 'Good' END"),
    "SLV-SHP-001": ("shipment_number", ORDER, "'0-0'"),
    "SLV-SHP-002": ("carrier_id", ORDER, "'CARRIER-99'"),
    "SLV-SHP-003": ("is_in_transit", f"{ORDER} AND actual_delivery_date IS NOT NULL", "TRUE"),
    "SLV-SHP-004": ("transit_time_hours", ORDER, "CAST(721 AS BIGINT)"),
    "SLV-WHS-001": ("movement_type", ORDER, "'XX'"),
    "SLV-WHS-002": ("quantity", ORDER, "CAST(0 AS DECIMAL(15,3))"),
    "SLV-INV-001": ("invoice_number", ORDER, "'INV-0'"),
    "SLV-INV-002": ("total_amount", ORDER, "CAST(total_amount + 1 AS DECIMAL(18,2))",
                    "total_c", "total_c + 100"),
    "SLV-INV-003": ("aging_bucket", ORDER, "CASE aging_bucket WHEN '90+' THEN 'Current' "
                                           "ELSE '90+' END"),
    "SLV-INV-004": ("payment_efficiency", ORDER, "201"),
    "REF-001": ("order_number", _some("customer_id"), "'0'"),
    "REF-002": ("total_amount", ORDER, "CAST(0 AS DECIMAL(18,2))"),
    "REF-003": ("order_date", ORDER, "TIMESTAMP '2001-09-01 00:00:00'"),
    "REF-004": ("tracking_number", ORDER, "''"),
    "REF-005": ("actual_delivery_date", f"{ORDER} AND actual_ship_date IS NOT NULL",
                "actual_ship_date - INTERVAL 1 DAY"),
    "REF-006": ("subtotal_amount", ORDER, "CAST(subtotal_amount + 1 AS DECIMAL(18,2))",
                "sub_c", "sub_c + 100"),
    "REF-007": ("due_date", ORDER, "invoice_date - INTERVAL 1 DAY"),
    "REF-008": ("quantity", ORDER, "CAST(0 AS DECIMAL(15,3))"),
    "FK-001": ("customer_id", ORDER, "'X'"),
    "FK-002": ("order_number", ORDER, "'X'"),
    "FK-003": ("order_number", ORDER, "'X'"),
    "FK-004": ("delivery_number", _some("split_part(delivery_number, '-', 1)"), "'0'"),
    "FK-005": ("warehouse_id", ORDER, "'WH999'"),
    "FK-006": ("carrier_id", ORDER, "'CARRIER-99'"),
}


class Faulty(Mapping):
    """The tables, with the rule's own table broken in some rows."""

    def __init__(self, t, rule: q.Rule):
        self._good, self._rule = Frames(t), rule

    def __getitem__(self, name):
        df = self._good[name]
        if name != self._rule.table or self._rule.id not in FAULTS:
            return df
        column, rows, value = FAULTS[self._rule.id][:3]
        return df.withColumn(column, F.when(F.expr(rows), F.expr(value)).otherwise(C(column)))

    def __iter__(self):
        return iter(self._good)

    def __len__(self):
        return len(self._good)


def broken(rule: q.Rule, view: str) -> str:
    """The rule's view with the same rows broken."""
    if rule.id not in FAULTS:
        return view
    fault = FAULTS[rule.id]
    column, value = fault[3:] if len(fault) > 3 else (fault[0], fault[2])
    alias = view if view.isidentifier() else "checked"
    return (f"(SELECT * REPLACE (CASE WHEN {fault[1]} THEN {value} ELSE {column} END AS {column}) "
            f"FROM {view}) AS {alias}")


def rule_sql(rule: q.Rule, faults: bool = False) -> str:
    if rule.id in UNIQUE:
        view, key = UNIQUE[rule.id]
        view = broken(rule, view) if faults else view
        counts = (f"SELECT sum(c)::BIGINT AS n, {cnt('c > 1')} AS f FROM "
                  f"(SELECT {key}, count(*) AS c FROM {view} GROUP BY 1)")
    else:
        view, bad = BAD[rule.id]
        view = broken(rule, view) if faults else view
        counts = (f"SELECT (SELECT count(*) FROM {view}) AS n, "
                  f"(SELECT count(*) FROM {view} WHERE {bad}) AS f")
    return f"""
SELECT '{rule.id}' AS rule_id, '{rule.name}' AS rule_name, '{rule.dimension}' AS dimension,
  '{rule.priority}' AS priority, '{rule.layer}' AS layer, '{rule.table}' AS table_name,
  n AS total_count, f AS failed_count, {pct('f', 'n')} AS failed_pct,
  CASE WHEN f * 100 > n * {rule.max_pct} THEN 'Fail' ELSE 'Pass' END AS status,
  f || ' {rule.text}' AS message FROM ({counts})"""


def variance_sql(rule: q.Rule, a: str, b: str) -> str:
    v6 = pct("abs(b - a)", "a", 6)
    v = pct("abs(b - a)", "a")
    return f"""
SELECT '{rule.id}' AS rule_id, '{rule.name}' AS rule_name, '{rule.dimension}' AS dimension,
  '{rule.priority}' AS priority, '{rule.layer}' AS layer, '{rule.table}' AS table_name,
  100::BIGINT AS total_count, floor({v6})::BIGINT AS failed_count, {v} AS failed_pct,
  CASE WHEN {v6} > {rule.max_pct} THEN 'Fail' ELSE 'Pass' END AS status,
  'Variance: ' || printf('%.2f', {v}) || '%' AS message
FROM (SELECT ({a})::HUGEINT AS a, ({b})::HUGEINT AS b)"""


def _views(rule: q.Rule) -> str:
    text = " ".join(BAD.get(rule.id, UNIQUE.get(rule.id)))
    return " ".join(v for v in ALL_VIEWS.split()
                    if v in text.replace("(", " ").replace(")", " ").split()
                    or f"FROM {v}" in text)


def _as_of(rule: q.Rule, t) -> str:
    return t.message_as_of if rule.layer == "Bronze" else t.as_of


def _register(rule: q.Rule) -> None:
    name = "dq_" + rule.id.lower().replace("slv-", "").replace("-", "_")

    @query(name, views=_views(rule), sql=rule_sql(rule, faults=True))
    def _one(t):
        return q.run_rules(Faulty(t, rule), [rule], as_of=_as_of(rule, t))


EVERY_RULE = (*q.MESSAGE_RULES, *q.ORDER_RULES, *q.SHIPMENT_RULES, *q.WAREHOUSE_RULES,
              *q.INVOICE_RULES, *q.REFERENCE_RULES, *q.FOREIGN_KEY_RULES)
for _rule in EVERY_RULE:
    _register(_rule)


@query("dq_xlr_001", views="s_shipments", sql=variance_sql(
    q.CROSS_RULES[0], "SELECT count(*) FROM lineitem", "SELECT count(*) FROM s_shipments"))
def _(t):
    return q.run_rules(Frames(t), q.CROSS_RULES[:1], as_of=t.as_of)


@query("dq_xlr_002", views="g_orders", sql=variance_sql(
    q.CROSS_RULES[1], "SELECT sum(total_c) FROM g_orders",
    f"SELECT sum(total_c) FROM g_orders WHERE order_date < {NOW} - INTERVAL 30 DAY"))
def _(t):
    # a daily table that was last refreshed 30 days ago
    stale = t.gold_order_facts.filter(
        C("order_date") < F.lit(t.as_of).cast("timestamp") - F.expr("INTERVAL 30 DAY"))
    tables = {"orders": t.gold_orders, "gold_orders": gold.orders_by_sla(stale)}
    return q.run_rules(tables, q.CROSS_RULES[1:], as_of=t.as_of)


INCOMING = q.Rule("SLV-SHP-001", "Shipment number occurs once", "Uniqueness", "Critical", "Bronze",
                  "lines", "duplicate shipment numbers", unique=("l_orderkey", "l_linenumber"))
_INCOMING_SQL = rule_sql(INCOMING).replace("SELECT shipment_number, count(*) AS c FROM "
                                           "s_shipments GROUP BY 1",
                                           "SELECT count(*) AS c FROM lineitem "
                                           "GROUP BY l_orderkey, l_linenumber")


@query("dq_shp_001_incoming", sql=_INCOMING_SQL)
def _(t):
    return q.run_rules({"lines": t.table("lineitem")}, [INCOMING], as_of=t.as_of)


@query("dq_gld_002_current_day", views="g_orders", sql=f"""
WITH d AS (SELECT count(*) > 0 AS has FROM g_orders WHERE order_date::DATE = {NOW}::DATE)
SELECT has AS has_orders, has AS has_sla, has AS all_current FROM d""")
def _(t):
    return q.current_day({"orders": (gold.orders_by_sla(t.gold_order_facts), "order_day"),
                          "sla": (gold.sla_daily(t.gold_order_facts), "performance_date")}, as_of=t.as_of)


# ---------------------------------------------------------------- roll-ups

# what the scored rules read
SCORED_COLUMNS = {
    "orders": ("order_number", "customer_id", "order_date", "requested_delivery_date",
               "actual_ship_date", "total_amount"),
    "shipments": ("shipment_number", "carrier_id", "transit_time_hours"),
    "warehouse": ("movement_type", "quantity"),
    "invoices": ("invoice_number", "subtotal_amount", "tax_amount", "discount_amount",
                 "shipping_charges", "total_amount")}


def scored_tables(t):
    """Silver with the columns that the scored rules read, stored once."""
    return stored(t, SCORED_COLUMNS)


def scored(t):
    """All scored rules over stored silver, which is derived once for them."""
    return q.run_rules(Frames(scored_tables(t)), q.SCORED_RULES, as_of=t.as_of)


SCORED = "scored AS (" + " UNION ALL ".join(rule_sql(r) for r in q.SCORED_RULES) + ")"
HEALTH = ("CASE WHEN {0} > 0 THEN 'Critical' WHEN {1} >= 99 THEN 'Healthy' "
          "WHEN {1} >= 95 THEN 'Warning' ELSE 'At Risk' END")
PASSED = cnt("status = 'Pass'")
SCORE = (f"SELECT *, {HEALTH.format('critical_failures', 'quality_score')} AS health_status FROM "
         f"(SELECT count(*) AS total_rules, {PASSED} AS passed, "
         "count(*) FILTER (WHERE status = 'Fail') AS failed, "
         "count(*) FILTER (WHERE status = 'Fail' AND priority = 'Critical') AS critical_failures, "
         + pct("count(*) FILTER (WHERE status = 'Pass')", "count(*)")
         + " AS quality_score FROM scored)")


def scored_query(name: str, sql: str):
    return query(name, views=ALL_VIEWS, sql=f"WITH {SCORED} {sql}")


@scored_query("dqa_1_score", SCORE)
def _(t):
    return q.score(scored(t))


@scored_query("dqa_2_by_dimension", f"""
SELECT dimension, count(*) AS total, {cnt("status = 'Pass'")} AS passed,
  {cnt("status = 'Fail'")} AS failed, {pct(cnt("status = 'Pass'"), 'count(*)')} AS score
FROM scored GROUP BY dimension""")
def _(t):
    return q.by_dimension(scored(t))


ACTIONS = " ".join(f"WHEN '{r.id}' THEN '{r.action}'" for r in EVERY_RULE)


@scored_query("dqa_4_failed_rules", f"""
SELECT rule_id, rule_name, dimension, priority, table_name, failed_count,
  CASE rule_id {ACTIONS} END AS recommended_action FROM scored WHERE status = 'Fail'""")
def _(t):
    return q.failed_rules(scored(t), q.SCORED_RULES)


INCOMING_ALERT = f"""
SELECT 'Critical' AS alert_level, rule_id, 'CRITICAL: ' || message AS message,
  table_name AS affected_table, failed_count FROM ({_INCOMING_SQL}) WHERE status = 'Fail'"""


@query("dqa_5_critical_alerts", sql=INCOMING_ALERT)
def _(t):
    return q.critical_alerts(
        q.run_rules({"lines": t.table("lineitem")}, [INCOMING], as_of=t.as_of))


def good(*bad: str) -> str:
    less = "".join(f" - {cnt(b)}" for b in bad)
    return pct(f"count(*){less}", "count(*)")


def metric(view: str, name: str, layer: str, **scores: str) -> str:
    names = ("completeness_score", "validity_score", "uniqueness_score", "consistency_score",
             "accuracy_score")
    cells = ", ".join(f"({scores.get(n, 'NULL')})::DOUBLE AS {n}" for n in names)
    return (f"SELECT '{name}' AS table_name, '{layer}' AS layer, count(*) AS total_records, "
            f"{cells} FROM {view}")


TABLE_METRICS = " UNION ALL ".join([
    metric("raw", "raw", "Bronze", completeness_score=good(BAD["BRZ-001"][1]),
           validity_score=good(BAD["BRZ-002"][1]),
           uniqueness_score=pct("count(DISTINCT docnum)", "count(*)")),
    metric("s_orders", "orders", "Silver",
           completeness_score=good(BAD["SLV-ORD-001"][1], BAD["SLV-ORD-002"][1]),
           validity_score=good(BAD["SLV-ORD-004"][1]),
           consistency_score=good(BAD["SLV-ORD-003"][1])),
    metric("s_shipments", "shipments", "Silver",
           uniqueness_score=pct("count(DISTINCT shipment_number)", "count(*)"),
           validity_score=good(BAD["SLV-SHP-004"][1])),
    metric("s_warehouse", "warehouse", "Silver",
           validity_score=good(BAD["SLV-WHS-001"][1], BAD["SLV-WHS-002"][1])),
    metric("s_invoices", "invoices", "Silver",
           uniqueness_score=pct("count(DISTINCT invoice_number)", "count(*)"),
           accuracy_score=good(BAD["SLV-INV-002"][1])),
])


@query("dqa_6_table_metrics", views=ALL_VIEWS, sql=TABLE_METRICS)
def _(t):
    return q.table_metrics(t.raw, t.orders, t.shipments, t.warehouse, t.invoices)


@scored_query("dqa_7_quality_kpis", f"""
, s AS ({SCORE}), k AS (SELECT quality_score, (SELECT count(*) FROM raw) AS total_messages,
  (SELECT count(*) FROM s_orders) + (SELECT count(*) FROM s_shipments)
  + (SELECT count(*) FROM s_warehouse) + (SELECT count(*) FROM s_invoices) AS silver_records,
  (SELECT count(*) FROM scored WHERE status = 'Fail' AND priority = 'Critical')
    AS critical_issues FROM s)
SELECT *, {pct('silver_records', 'total_messages')} AS data_availability_pct,
  {HEALTH.format('critical_issues', 'quality_score')} AS health_status FROM k""")
def _(t):
    held = scored_tables(t)  # rows are counted where the rules read them
    return q.quality_kpis(scored(t), t.raw,
                          [held.orders, held.shipments, held.warehouse, held.invoices])


@scored_query("dqa_8_dimension_bag", f"""
, s AS ({SCORE})
SELECT *, (SELECT string_agg(dimension || '=' || st, ';' ORDER BY dimension) FROM
  (SELECT dimension, min(status) AS st FROM scored GROUP BY 1)) AS by_dimension FROM s""")
def _(t):
    bag = q.dimension_bag(scored(t))
    text = F.transform(F.map_entries("by_dimension"),
                       lambda e: F.concat_ws("=", e["key"], e["value"]))
    return bag.withColumn("by_dimension", F.array_join(text, ";"))


@scored_query("dqa_9_health_by_target", f"""
, h AS (SELECT dimension, CASE WHEN coalesce(failed_pct, 0) <= t THEN 'Healthy'
    WHEN coalesce(failed_pct, 0) <= t * 1.1 THEN 'Warning' ELSE 'Critical' END AS state
  FROM (SELECT *, CASE rule_id WHEN 'BRZ-004' THEN 90 WHEN 'SLV-SHP-002' THEN 1 ELSE 0 END AS t
        FROM scored))
SELECT dimension, {cnt("state = 'Healthy'")} AS healthy, {cnt("state = 'Warning'")} AS warnings,
  {cnt("state = 'Critical'")} AS critical FROM h GROUP BY dimension""")
def _(t):
    return q.health_by_target(scored(t), {"BRZ-004": 90, "SLV-SHP-002": 1})


CHECKS = (q.Check("completeness", "shipment_number"), q.Check("completeness", "actual_ship_date"),
          q.Check("uniqueness", "shipment_number"), q.Check("uniqueness", "order_number"),
          q.Check("validity", "shipment_status", allowed=("Delivered", "Planned")),
          q.Check("timeliness", "planned_ship_date", max_age_hours=24 * 365))


def checker(name: str, field: str, ok: str, limit: int = 100) -> str:
    rate = pct(ok, "count(*)")
    return (f"SELECT '{name}' AS check_name, '{field}' AS field, CASE WHEN {rate} >= {limit} "
            f"THEN 'PASS' ELSE 'FAIL' END AS status, {rate} AS value_pct, "
            f"count(*) - {ok} AS failed_count, {rate} < 95 AS alert FROM s_shipments")


@query("dqa_10_checker", views="s_shipments", sql=" UNION ALL ".join([
    checker("Completeness", "shipment_number", "count(shipment_number)"),
    checker("Completeness", "actual_ship_date", "count(actual_ship_date)"),
    checker("Uniqueness", "shipment_number", "count(DISTINCT shipment_number)"),
    checker("Uniqueness", "order_number", "count(DISTINCT order_number)"),
    checker("Validity", "shipment_status", cnt("shipment_status IN ('Delivered', 'Planned')")),
    checker("Timeliness", "planned_ship_date",
            cnt(f"planned_ship_date >= {NOW} - INTERVAL 8760 HOUR"), 95)]))
def _(t):
    return q.check_table(t.shipments, CHECKS, as_of=t.as_of)


SHIPPED_OK = cnt(f"actual_ship_date <= {NOW}")
WEIGHT_OK = cnt("total_weight_kg > 0 AND total_weight_kg < 50000")


@query("dqa_11_shipment_score", views="s_shipments", sql=f"""
SELECT count(*) AS total_records,
  {pct('count(shipment_number)', 'count(*)')} AS shipment_number_completeness,
  {pct('count(customer_id)', 'count(*)')} AS customer_id_completeness,
  {pct('count(actual_ship_date)', 'count(*)')} AS ship_date_completeness,
  {pct(SHIPPED_OK, 'count(*)')} AS valid_ship_date,
  {pct(cnt('actual_delivery_date IS NULL OR actual_delivery_date >= actual_ship_date'), 'count(*)')}
    AS logical_dates, {pct(WEIGHT_OK, 'count(*)')} AS valid_weight,
  {pct(f'count(shipment_number) + count(customer_id) + count(actual_ship_date) + {SHIPPED_OK} + {WEIGHT_OK}', 'count(*) * 5')}
    AS overall_quality_score FROM s_shipments""")
def _(t):
    return q.shipment_score(t.shipments, as_of=t.as_of)


@query("dqa_12_completeness_accuracy", views="s_shipments", sql=f"""
SELECT count(*) AS total_rows, {pct('count(shipment_number)', 'count(*)')} AS shipment_completeness,
  {pct('count(carrier_id)', 'count(*)')} AS carrier_completeness,
  {pct('count(customer_id)', 'count(*)')} AS customer_completeness,
  {pct('count(*) - ' + cnt('actual_ship_date > actual_delivery_date'), 'count(*)')}
    AS date_accuracy, {pct(cnt('total_weight_kg > 0'), 'count(*)')} AS weight_accuracy
FROM s_shipments""")
def _(t):
    return q.completeness_accuracy(t.shipments)


FRESH = cnt(f"date_diff('minute', ingestion_time, {MNOW}) <= 1440")


@query("dqa_12_freshness", views="raw", sql=f"""
SELECT count(*) AS total_rows, {FRESH} AS fresh, count(*) - {FRESH} AS stale,
  {pct(FRESH, 'count(*)')} AS freshness_score FROM raw""")
def _(t):
    return q.freshness(t.raw, "ingestion_time", 1440, as_of=t.message_as_of)


@query("dqa_13_row_tags", views="s_shipments", sql="""
SELECT CASE WHEN carrier_id IS NULL OR carrier_id = '' THEN 'Missing Carrier'
  WHEN tracking_number IS NULL OR tracking_number = '' THEN 'Missing Tracking'
  WHEN total_weight_kg <= 0 THEN 'Invalid Weight'
  WHEN actual_delivery_date IS NULL THEN 'Not Delivered' ELSE 'OK' END AS quality_check,
  count(*) AS row_count FROM s_shipments GROUP BY 1""")
def _(t):
    return q.tag_rows(t.shipments).groupBy("quality_check").agg(F.count("*").alias("row_count"))


SEVERITY = " ".join(f"WHEN '{d}' THEN '{level}'" for level, (d, _, _) in q.SEVERITY.items())
ALERT_ACTION = " ".join(f"WHEN '{d}' THEN '{a}'" for d, a, _ in q.SEVERITY.values())
RECIPIENTS = " ".join(f"WHEN '{d}' THEN '{w}'" for d, _, w in q.SEVERITY.values())


@query("dqa_14_severity", views=ALL_VIEWS, sql=f"""
WITH every AS ({' UNION ALL '.join(rule_sql(r) for r in EVERY_RULE)} UNION ALL {_INCOMING_SQL})
SELECT rule_id, dimension, failed_count, CASE dimension {SEVERITY} END AS severity,
  CASE dimension {ALERT_ACTION} END AS alert_action,
  CASE dimension {RECIPIENTS} END AS recipients
FROM every WHERE status = 'Fail' AND dimension IN ('Uniqueness', 'Completeness', 'Timeliness',
  'Validity') AND (dimension <> 'Completeness' OR failed_pct > 5)""")
def _(t):
    results = q.run_rules(Frames(stored(t)), EVERY_RULE, as_of=t.as_of).unionByName(
        q.run_rules({"lines": t.table("lineitem")}, [INCOMING], as_of=t.as_of))
    return q.severity_actions(results)


# ---------------------------------------------------------------- check groups

def threshold(rule: str, name: str, ok: str, limit: float) -> str:
    rate = pct(cnt(ok), "count(*)", 4)
    return (f"SELECT '{rule}' AS rule_id, '{name}' AS check_name, {rate} AS pass_pct, "
            f"{limit}::DOUBLE AS threshold, CASE WHEN {rate} >= {limit} THEN 'Pass' "
            f"ELSE 'Fail' END AS status FROM s_shipments")


@query("dq_thr_thresholds", views="s_shipments s_customers", sql=" UNION ALL ".join([
    threshold("THR-001", "shipment_number_present", "shipment_number IS NOT NULL", 100),
    threshold("THR-001", "customer_id_present", "customer_id IS NOT NULL", 100),
    threshold("THR-001", "ship_date_present", "actual_ship_date IS NOT NULL", 99.5),
    threshold("THR-001", "origin_present", "length(origin_country) > 0", 99),
    threshold("THR-002", "ship_date_not_future",
              f"actual_ship_date IS NULL OR actual_ship_date <= {NOW}", 100),
    threshold("THR-002", "delivery_after_ship",
              "actual_delivery_date IS NULL OR actual_delivery_date >= actual_ship_date", 99.9),
    threshold("THR-002", "planned_delivery_reasonable", "actual_ship_date IS NULL OR "
              "planned_delivery_date BETWEEN actual_ship_date AND "
              "actual_ship_date + INTERVAL 30 DAY", 98),
    threshold("THR-003", "valid_weight", "total_weight_kg > 0 AND total_weight_kg < 50000", 99.5),
    threshold("THR-003", "valid_status", "shipment_status IN ('Planned', 'In Transit', "
              "'Delivered', 'Delayed', 'Cancelled')", 100),
    threshold("THR-003", "customer_exists",
              "customer_id IN (SELECT customer_id FROM s_customers)", 100)]))
def _(t):
    flagged = q.with_known_flag(t.shipments, t.customers, "customer_id", "customer_id",
                                "customer_known")
    return q.shipment_thresholds(flagged, as_of=t.as_of)


def counted(source: str, checks: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) AS total_count, {cnt(bad)} AS failed_count, "
        f"CASE WHEN {cnt(bad)} = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {source}"
        for name, bad in checks.items())


@query("dq_lab_bronze", views="raw", sql=counted("raw", {
    "docnum_null": "docnum IS NULL", "idoc_type_null": "idoc_type IS NULL",
    "sap_system_null": "sap_system IS NULL", "timestamp_null": '"timestamp" IS NULL',
    "unknown_type": "message_type NOT IN ('ORDERS', 'DESADV', 'SHPMNT', 'INVOIC')"}))
def _(t):
    return q.failure_counts(t.raw, {
        **{f"{c}_null": C(c).isNull() for c in ("docnum", "idoc_type", "sap_system",
                                                "timestamp")},
        "unknown_type": ~C("message_type").isin("ORDERS", "DESADV", "SHPMNT", "INVOIC")})


@query("dq_lab_silver", views="s_orders", sql=counted("s_orders", {
    "order_number_missing": "order_number IS NULL", "order_date_missing": "order_date IS NULL",
    "customer_missing": "customer_id IS NULL", "amount_missing": "total_amount IS NULL",
    "negative_amount": "total_amount < 0", "future_order": f"order_date > {NOW}",
    "delivery_before_order": "actual_delivery_date < order_date",
    "unknown_currency": "currency NOT IN ('USD', 'EUR', 'JPY', 'CNY')",
    "unknown_status": "order_status NOT IN ('Pending', 'Shipped', 'Delivered', 'Cancelled')"}))
def _(t):
    return q.failure_counts(t.orders, {
        "order_number_missing": C("order_number").isNull(),
        "order_date_missing": C("order_date").isNull(),
        "customer_missing": C("customer_id").isNull(),
        "amount_missing": C("total_amount").isNull(),
        "negative_amount": C("total_amount") < 0,
        "future_order": C("order_date") > F.lit(t.as_of).cast("timestamp"),
        "delivery_before_order": C("actual_delivery_date") < C("order_date"),
        "unknown_currency": ~C("currency").isin("USD", "EUR", "JPY", "CNY"),
        "unknown_status": ~C("order_status").isin("Pending", "Shipped", "Delivered",
                                                  "Cancelled")})


@query("dq_lab_line_dates", sql=counted(
    "(SELECT * FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)", {
        "ship_before_order": "l_shipdate < o_orderdate", "unknown_order": "o_orderkey IS NULL"}))
def _(t):
    joined = t.table("lineitem").join(t.table("orders"), C("l_orderkey") == C("o_orderkey"),
                                      "left")
    return q.failure_counts(joined, {"ship_before_order": C("l_shipdate") < C("o_orderdate"),
                                     "unknown_order": C("o_orderkey").isNull()})


@query("dq_lab_orders_without_lines", sql="""
SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def _(t):
    return missing_keys(t.table("orders"), t.table("lineitem"),
                        {"o_orderkey": "l_orderkey"}).select("o_orderkey")


GOLD_ORDERS = f"(SELECT {ORDER_DAY} AS order_day, sap_system, sla_status, {BY_SLA}, " \
              "count(*) FILTER (WHERE order_status = 'Shipped') AS shipped_orders, " \
              "count(*) FILTER (WHERE order_status = 'Pending') AS pending_orders " \
              "FROM g_orders GROUP BY ALL)"


@query("dq_gold_orders", views="g_orders", sql=counted(GOLD_ORDERS, {
    "null_keys": "order_day IS NULL OR total_orders IS NULL OR total_revenue IS NULL",
    "compliance_range": "sla_compliance_pct < 0 OR sla_compliance_pct > 100",
    "delivery_range": "delivery_rate_pct < 0 OR delivery_rate_pct > 100",
    "status_sum": "delivered_orders + shipped_orders + pending_orders + cancelled_orders "
                  "<> total_orders",
    "sla_sum": "sla_good_count + sla_at_risk_count + sla_breached_count <> total_orders",
    "average_bounds": "avg_order_value < min_order_value OR avg_order_value > max_order_value",
    "negative_revenue": "total_revenue < 0"}))
def _(t):
    df = gold.orders_by_sla(t.gold_order_facts, shipped_and_pending=True)
    n = C("total_orders")
    return q.failure_counts(df, {
        "null_keys": C("order_day").isNull() | n.isNull() | C("total_revenue").isNull(),
        "compliance_range": ~C("sla_compliance_pct").between(0, 100),
        "delivery_range": ~C("delivery_rate_pct").between(0, 100),
        "status_sum": (C("delivered_orders") + C("shipped_orders") + C("pending_orders")
                       + C("cancelled_orders")) != n,
        "sla_sum": (C("sla_good_count") + C("sla_at_risk_count")
                    + C("sla_breached_count")) != n,
        "average_bounds": ~C("avg_order_value").between(C("min_order_value"),
                                                        C("max_order_value")),
        "negative_revenue": C("total_revenue") < 0})


@query("dq_gold_warehouse", views="s_warehouse", sql=counted(f"({WH_DAILY})", {
    "productivity_range": "quantity_per_hour < 0 OR quantity_per_hour > 500",
    "exception_range": "exception_rate_pct < 0 OR exception_rate_pct > 100"}))
def _(t):
    return q.failure_counts(gold.warehouse_productivity(t.warehouse), {
        "productivity_range": ~C("quantity_per_hour").between(0, 500),
        "exception_range": ~C("exception_rate_pct").between(0, 100)})


@query("dq_gold_revenue", views="s_invoices", sql=counted(f"({RECOGNITION})", {
    "collection_range": "collection_efficiency_pct < 0 OR collection_efficiency_pct > 100",
    "aging_sum": "abs(round((aging_current + aging_1_30 + aging_31_60 + aging_61_90 "
                 "+ aging_90_plus - total_outstanding) * 100)) > 1",
    "paid_plus_due": "abs(round((total_paid + total_due - total_revenue) * 100)) > 1"}))
def _(t):
    df = gold.revenue_recognition(t.invoices)
    aging = sum((C(a) for a in list(gold.AGING_COLUMNS)[1:]), C("aging_current"))
    cent = F.lit("0.01").cast("decimal(5,2)")
    return q.failure_counts(df, {
        "collection_range": ~C("collection_efficiency_pct").between(0, 100),
        "aging_sum": F.abs(aging - C("total_outstanding")) > cent,
        "paid_plus_due": F.abs(C("total_paid") + C("total_due") - C("total_revenue")) > cent})


@query("dq_gold_sla", views="g_orders", sql=counted(f"({SLA_DAILY})", {
    "score_range": "overall_performance_score < 0 OR overall_performance_score > 100"}))
def _(t):
    return q.failure_counts(gold.sla_daily(t.gold_order_facts), {
        "score_range": ~C("overall_performance_score").between(0, 100)})


# ---------------------------------------------------------------- locations, freshness, contract

def located(t):
    """Movements with a four-part location; movements with an exception lack the bin."""
    return t.warehouse.withColumns({
        "aisle": C("location_code"), "shelf": C("equipment_id"),
        "bin_location": F.when(C("exception_flag"), "").otherwise(C("operator_id"))})


def single(rule: q.Rule, source: str, bad: str) -> str:
    BAD[rule.id] = (source, bad)
    return rule_sql(rule)


@query("dq_whs_003", views="s_warehouse",
       sql=single(q.LOCATION_RULE, "s_warehouse", "exception_flag"))
def _(t):
    return q.run_rules({"warehouse": located(t)}, [q.LOCATION_RULE], as_of=t.as_of)


@query("dq_gld_001", views="raw", sql=single(
    q.GOLD_FRESH_RULE, "(SELECT sap_system, message_type, max(ingestion_time) AS newest FROM raw "
    "GROUP BY 1, 2)", f"date_diff('minute', newest, {MNOW}) > 5"))
def _(t):
    status = t.raw.groupBy("sap_system", "message_type").agg(
        F.max("ingestion_time").alias("processed_timestamp"))
    return q.run_rules({"gold_status": status}, [q.GOLD_FRESH_RULE], as_of=t.message_as_of)


MESSAGE_RESULTS = " UNION ALL ".join(rule_sql(r) for r in q.MESSAGE_RULES)
ORDER_RESULTS = " UNION ALL ".join(rule_sql(r) for r in q.ORDER_RULES)


@query("dqa_3_trend", views="raw s_orders g_orders", sql=f"""
WITH runs AS (SELECT '2024-01-30' AS day, {pct(cnt("status = 'Pass'"), 'count(*)')} AS s
    FROM ({MESSAGE_RESULTS})
  UNION ALL SELECT '2024-01-30', {pct(cnt("status = 'Pass'"), 'count(*)')} FROM ({ORDER_RESULTS})
  UNION ALL SELECT '2024-01-31', {pct(cnt("status = 'Pass'"), 'count(*)')}
    FROM ({MESSAGE_RESULTS} UNION ALL {ORDER_RESULTS}))
SELECT day, round(avg(s), 2) AS quality_score, min(s) AS min_score, max(s) AS max_score,
  count(*) AS runs FROM runs GROUP BY day""")
def _(t):
    def run(rules, at):
        return q.run_rules(Frames(t), rules, as_of=t.as_of).withColumn(
            "checked_at", F.lit(at).cast("timestamp"))

    history = run(q.MESSAGE_RULES, "2024-01-30 01:00:00").unionByName(
        run(q.ORDER_RULES, "2024-01-30 02:00:00")).unionByName(
        run((*q.MESSAGE_RULES, *q.ORDER_RULES), "2024-01-31 01:00:00"))
    return q.trend(history, "2024-01-01 00:00:00", "2024-02-01 00:00:00")


CONTRACT = (
    q.Field("shipment_number", "string", required=True, unique=True),
    q.Field("carrier_id", "string", required=True,
            values=tuple(f"CARRIER-{i}" for i in range(19))),
    q.Field("actual_ship_date", "timestamp", required=True, future_allowed=False),
    q.Field("total_weight_kg", "double"),
    q.Field("weight_unit", "string", required=True))


@query("dq_ctr_contract", views="s_shipments", sql=f"""
WITH m AS (SELECT {pct('count(shipment_number)', 'count(*)')} AS c1,
    {pct('count(carrier_id)', 'count(*)')} AS c2, {pct('count(actual_ship_date)', 'count(*)')} AS c3,
    {pct('count(DISTINCT shipment_number)', 'count(*)')} AS u1,
    {pct(cnt("carrier_id <> 'CARRIER-19'"), 'count(carrier_id)')} AS v1,
    {cnt(f'actual_ship_date > {NOW}')} AS f1,
    {pct('count(*) - ' + cnt('actual_delivery_date < actual_ship_date'), 'count(*)')} AS a1,
    {pct(cnt('total_weight_kg > 1'), 'count(*)')} AS a2,
    date_diff('minute', max(actual_ship_date), {NOW}) AS fresh FROM s_shipments)
SELECT v.* FROM m, LATERAL (VALUES
  ('schema', 'shipment_number', 'Pass'), ('schema', 'carrier_id', 'Pass'),
  ('schema', 'actual_ship_date', 'Pass'), ('schema', 'total_weight_kg', 'Fail'),
  ('schema', 'weight_unit', 'Fail'),
  ('completeness', 'shipment_number', CASE WHEN c1 >= 99.5 THEN 'Pass' ELSE 'Fail' END),
  ('completeness', 'carrier_id', CASE WHEN c2 >= 99.5 THEN 'Pass' ELSE 'Fail' END),
  ('completeness', 'actual_ship_date', CASE WHEN c3 >= 99.5 THEN 'Pass' ELSE 'Fail' END),
  ('uniqueness', 'shipment_number', CASE WHEN u1 >= 100 THEN 'Pass' ELSE 'Fail' END),
  ('values', 'carrier_id', CASE WHEN v1 >= 100 THEN 'Pass' ELSE 'Fail' END),
  ('future', 'actual_ship_date', CASE WHEN f1 <= 0 THEN 'Pass' ELSE 'Fail' END),
  ('accuracy', 'delivery after ship', CASE WHEN a1 >= 99 THEN 'Pass' ELSE 'Fail' END),
  ('accuracy', 'weight above one', CASE WHEN a2 >= 99 THEN 'Pass' ELSE 'Fail' END),
  ('freshness', 'actual_ship_date', CASE WHEN fresh <= 5 THEN 'Pass' ELSE 'Fail' END))
  AS v(part, subject, status)""")
def _(t):
    return q.check_contract(t.shipments, CONTRACT, {
        "delivery after ship": C("actual_delivery_date") >= C("actual_ship_date"),
        "weight above one": C("total_weight_kg") > 1}, as_of=t.as_of,
        fresh=("actual_ship_date", 5)).select("part", "subject", "status")
