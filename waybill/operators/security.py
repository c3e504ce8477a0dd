"""Row-level security and masking as DataFrame operators.

``secure`` is applied before masking and user filters; Catalyst then pushes its predicate to the
scan together with them. It is a convention for the code that hands out frames, not a boundary
against code that can read the files itself.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions import as_ts, is_filled
from waybill.operators.rows import top_by, union_all

C = F.col


@dataclass(frozen=True)
class Principal:
    """Who asks: roles, partner attributes (such as carrier_id) and the admin flag."""

    name: str
    roles: tuple[str, ...] = ()
    attributes: Mapping[str, str] = field(default_factory=dict)
    is_admin: bool = False


@dataclass(frozen=True)
class Policy:
    """role -> table -> filter. A filter is ``(column, value)``; the value ``"$name"`` is taken
    from the principal's attribute ``name``. Tables a role does not list stay closed to it."""

    grants: Mapping[str, Mapping[str, tuple[str, str]]]
    members: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def principal(self, name: str, **attributes: str) -> Principal:
        roles = tuple(sorted(r for r, who in self.members.items() if name in who))
        return Principal(name, roles, attributes)


def load_policy(text: str, known: Mapping[str, Sequence[str]] | None = None) -> Policy:
    """Policy from its JSON form. ``known`` lists valid values per column; others are refused."""
    doc = json.loads(text)
    grants: dict[str, dict[str, tuple[str, str]]] = {}
    for role in doc["roles"]:
        tables = grants.setdefault(role["name"], {})
        for item in role["tablePermissions"]:
            column, _, value = (p.strip() for p in item["filterExpression"].partition("="))
            value = value.strip("'")
            if not column.isidentifier() or not value:
                raise ValueError(f"only column = 'value' filters are allowed: {item}")
            if known and column in known and value not in known[column]:
                raise ValueError(f"unknown {column} {value!r} in role {role['name']!r}")
            tables[item["tableName"]] = (column, value)
    members = {a["role"]: tuple(m["id"] for m in a["members"])
               for a in doc.get("roleAssignments", [])}
    return Policy(grants, members)


def grant(principal: Principal, table: str, policy: Policy) -> Column:
    """Predicate of the rows the principal may see: roles combine by OR, none means no row."""
    if principal.is_admin:
        return F.lit(True)
    parts = []
    for role in principal.roles:
        rule = policy.grants.get(role, {}).get(table)
        if rule is None:
            continue
        column, value = rule
        if value.startswith("$"):
            value = principal.attributes.get(value[1:])
            if value is None:
                continue
        parts.append(C(column) == value)
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(False)


def secure(df: DataFrame, table: str, principal: Principal, policy: Policy) -> DataFrame:
    return df.filter(grant(principal, table, policy))


def organization_filter(principal: Principal, partner_column: str, org_column: str) -> Column:
    """Partner and organisation must match; organisation access ALL lifts the second part."""
    if principal.is_admin:
        return F.lit(True)
    a = principal.attributes
    partner = C(partner_column) == a.get("partner_id")
    if a.get("organization_access") == "ALL":
        return partner
    return partner & (C(org_column) == a.get("organization_id"))


def by_access_table(df: DataFrame, access: DataFrame, principal: Principal,
                    on: Mapping[str, str], bypass: Sequence[str] = ("OrganizationAdmin",)
                    ) -> DataFrame:
    """Rows whose keys occur among the principal's active entries of the access table."""
    if principal.is_admin or set(bypass) & set(principal.roles):
        return df
    mine = access.filter((C("user") == principal.name) & C("is_active")).select(
        *[C(v).alias(f"_{v}") for v in on.values()])
    cond = reduce(lambda a, b: a & b, [df[k] == mine[f"_{v}"] for k, v in on.items()])
    return df.join(mine, cond, "left_semi")


def recent_only(df: DataFrame, ts: str, days: int = 90, *, as_of) -> DataFrame:
    """Rows of the last days; access to older ones has ended."""
    return df.filter(F.to_date(ts) >= F.date_sub(F.to_date(as_ts(as_of)), days))


def region_filter(principal: Principal, column: str,
                  member_roles: Sequence[str] = ("DataProductOwner", "DataSteward")) -> Column:
    """Rows of the principal's region; the member roles see every region."""
    if principal.is_admin or set(member_roles) & set(principal.roles):
        return F.lit(True)
    return C(column) == principal.attributes.get("region")


def split_writes(df: DataFrame, table: str, principal: Principal,
                 policy: Policy) -> tuple[DataFrame, DataFrame]:
    """Rows the principal may write, and the rejected rest; null keys are rejected."""
    allowed = F.coalesce(grant(principal, table, policy), F.lit(False))
    return df.filter(allowed), df.filter(~allowed).withColumn(
        "reject_reason", F.lit(f"outside the scope of {principal.name}"))


def policy_table(spark: SparkSession, policy: Policy) -> DataFrame:
    rows = [(role, table, column, value) for role, tables in sorted(policy.grants.items())
            for table, (column, value) in sorted(tables.items())]
    return spark.createDataFrame(rows, "role string, table_name string, column_name string, "
                                       "value string")


def member_table(spark: SparkSession, policy: Policy) -> DataFrame:
    rows = [(role, who) for role, members in sorted(policy.members.items()) for who in members]
    return spark.createDataFrame(rows, "role string, principal string")


def audit_tables(tables: DataFrame, policies: DataFrame) -> DataFrame:
    """Filter count per table; zero means nobody but an admin is limited on purpose."""
    counts = policies.groupBy("table_name").agg(F.count("*").alias("filters"))
    return tables.join(counts, "table_name", "left").withColumn(
        "filters", F.coalesce("filters", F.lit(0))).orderBy("filters", "table_name")


def audit_members(members: DataFrame) -> DataFrame:
    """Principals with more than one role."""
    return members.groupBy("principal").agg(
        F.count_distinct(C("role")).alias("role_count"),
        F.array_join(F.sort_array(F.collect_set("role")), ",").alias("roles"),
    ).filter(C("role_count") > 1)


def access_without_partner(log: DataFrame, partner: str, *, as_of) -> DataFrame:
    """Accesses that carried no partner, for the audit table."""
    return log.filter(~is_filled(C(partner)) | C(partner).isNull()).withColumns({
        "audit_type": F.lit("INVALID_ACCESS"), "audited_at": as_ts(as_of)})


# ---------------------------------------------------------------- verification

def visible_counts(tables: Mapping[str, DataFrame], principals: Sequence[Principal],
                   policy: Policy) -> DataFrame:
    """Rows each principal sees per table; one pass per table for all principals."""
    parts = []
    for name, df in tables.items():
        cells = [F.count_if(F.coalesce(grant(p, name, policy), F.lit(False))).alias(f"_{i}")
                 for i, p in enumerate(principals)]
        rows = [F.struct(F.lit(p.name).alias("principal"), F.lit(name).alias("table_name"),
                         C(f"_{i}").alias("visible_rows"))
                for i, p in enumerate(principals)]
        parts.append(df.agg(*cells).select(F.inline(F.array(*rows))))
    return union_all(parts)


def checklist(counts: DataFrame) -> DataFrame:
    """One row: how many granted views show rows, and whether all do."""
    shown = F.count_if(C("visible_rows") > 0)
    return counts.agg(F.count("*").alias("checks"), shown.alias("with_rows"),
                      (shown == F.count("*")).alias("all_visible"))


def scopes(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("row_count")).orderBy(
        F.desc("row_count"), column)


def preview(df: DataFrame, table: str, principal: Principal, policy: Policy, n: int,
            *order: Column | str) -> DataFrame:
    return top_by(secure(df, table, principal, policy), n, *order)


# ---------------------------------------------------------------- masking

def mask_prefix(c: Column, label: str = "Customer-", keep: int = 3) -> Column:
    return F.concat(F.lit(label), F.substring(c, 1, keep))


def mask_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def mask_constant(c: Column, text: str = "CONFIDENTIAL") -> Column:
    return F.lit(text)


MASKS = {"prefix": mask_prefix, "hash": mask_hash, "constant": mask_constant}

# Columns hidden from each kind of partner, with the way they are hidden.
MASK_POLICY: dict[str, dict[str, str]] = {
    "carrier": {"customer_name": "constant", "customer_id": "prefix", "shipment_value": "drop",
                "total_amount": "drop", "internal_notes": "drop"},
    "warehouse": {"cost_per_unit": "drop", "labor_cost": "drop", "movement_cost": "drop",
                  "customer_name": "constant"},
    "customer": {"operator_id": "drop", "warehouse_id": "drop", "carrier_cost": "drop"},
}


def mask(df: DataFrame, partner_type: str,
         policy: Mapping[str, Mapping[str, str]] = MASK_POLICY) -> DataFrame:
    """Hides the columns the policy names for this kind of partner; absent ones are ignored."""
    rules = policy[partner_type]
    out = []
    for name in df.columns:
        how = rules.get(name)
        if how is None:
            out.append(C(name))
        elif how != "drop":
            out.append(MASKS[how](C(name)).alias(name))
    return df.select(*out)


def carrier_portal(shipments: DataFrame) -> DataFrame:
    """Shipments as a carrier sees them: no price, customer as reference and hash only."""
    rows = shipments.filter(is_filled(C("carrier_id"))
                            & C("shipment_status").isin("In Transit", "Delivered", "Picked Up"))
    return rows.select(
        "shipment_number", "tracking_number", "carrier_id", "carrier_name", "order_number",
        mask_prefix(C("customer_id")).alias("customer_reference"),
        mask_hash(C("customer_name")).alias("customer_name_hash"),
        "origin_country", "destination_country", "planned_ship_date", "actual_ship_date",
        "planned_delivery_date", "actual_delivery_date", "total_weight_kg", "shipment_status",
        F.when(C("actual_delivery_date") <= C("planned_delivery_date"), "On-Time")
        .otherwise("Delayed").alias("delivery_performance"))


def warehouse_portal(moves: DataFrame) -> DataFrame:
    """Movements of partner-operated warehouses without cost columns."""
    return moves.filter(is_filled(C("warehouse_partner_id"))).select(
        F.to_date("movement_timestamp").alias("movement_day"), "warehouse_id",
        "warehouse_partner_id", "material_id", "movement_type", "movement_timestamp", "quantity",
        "location_code", "operator_id", "processing_time_minutes", "sap_system")


def customer_portal(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Orders with each of their shipments and a delivery state, without internal columns."""
    moves = shipments.select("order_number", "shipment_number", "carrier_name",
                             "tracking_number", "shipment_status",
                             C("actual_ship_date").alias("shipped_at"),
                             C("actual_delivery_date").alias("delivered_at"))
    state = (F.when(C("delivered_at") <= C("requested_delivery_date"), "On-Time")
             .when(C("delivered_at").isNotNull(), "Delayed").otherwise("Pending"))
    return orders.filter(is_filled(C("customer_id"))).join(moves, "order_number", "left").select(
        "order_number", "customer_id", "customer_name", "order_date", "requested_delivery_date",
        "order_status", C("total_amount").alias("order_value"), "shipment_number", "carrier_name",
        "tracking_number", "shipment_status", "shipped_at", "delivered_at", "sla_status",
        state.alias("delivery_status"), "sap_system")
