"""Business thresholds and code tables, as parameters rather than literals in the jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.scalars import as_ts, diff_boundary

# Code tables of the message domain.
MESSAGE_TYPES = ("ORDERS", "SHPMNT", "DESADV", "WHSCON", "INVOIC")
AGING_BUCKETS = ("Current", "1-30", "31-60", "61-90", "90+")
SHIPMENT_STATUS_CODES = {"A": "In Transit", "B": "Delivered", "C": "Exception"}
SHIPMENT_STATUS_CODES_ALT = {"A": "Picked Up", "B": "In Transit", "C": "Delivered"}
MOVEMENT_LABELS = {
    "GR": "Receipt", "PI": "Picking", "PA": "Putaway", "GI": "Shipping",
    "TR": "Transfer", "CC": "Count", "RT": "Return",
}
MOVEMENT_CODES_STRICT = ("GR", "GI", "TR", "CC", "PI", "PA", "RT")
CATEGORY_PREFIXES = {
    "ORDERS": "Orders", "INVOIC": "Invoices", "WHSCON": "Warehouse Operations",
    "DESADV": "Delivery Advices", "SHPMNT": "Shipments",
}
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
DEFAULT_SCOPES = {
    "SHPMNT": "CARRIER_CUSTOMER", "DESADV": "CARRIER_CUSTOMER",
    "ORDERS": "CUSTOMER", "INVOIC": "CUSTOMER", "WHSCON": "WAREHOUSE_PARTNER",
}


def lookup(table: dict[str, str], key: Column, default: Column | None = None) -> Column:
    """Code table as an expression; unknown keys give ``default``."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, default)


@dataclass(frozen=True)
class SlaPolicy:
    """Classes by age: below ``good`` is Good, below ``limit`` is At Risk, else Breached.

    ``inclusive`` moves both limits into the better class. With ``met_missed`` a finished
    step is judged by its own duration and reads Met or Missed.
    """

    good: float
    limit: float
    inclusive: bool = False
    met_missed: bool = False
    unit: str = "hour"


# The named service-level variants.
SLA_PRESETS = {
    "default": SlaPolicy(20, 24, met_missed=True),
    "half_day": SlaPolicy(12, 24),
    "inclusive": SlaPolicy(20, 24, inclusive=True),
    "processing_days": SlaPolicy(1, 2, inclusive=True, unit="day"),
}


def sla_class(start: Column, done: Column | None, as_of: Column,
              policy: SlaPolicy = SLA_PRESETS["default"]) -> Column:
    """Service-level class of a step that began at ``start`` and, if given, ended at ``done``."""
    age = diff_boundary(policy.unit, as_of, start)
    if policy.inclusive:
        open_class = F.when(age <= policy.good, "Good").when(age <= policy.limit, "At Risk")
    else:
        open_class = F.when(age < policy.good, "Good").when(age < policy.limit, "At Risk")
    open_class = F.when(age.isNull(), F.lit(None)).otherwise(open_class.otherwise("Breached"))
    if done is None or not policy.met_missed:
        return open_class
    took = diff_boundary(policy.unit, done, start)
    return (F.when(done.isNotNull() & (took <= policy.limit), "Met")
            .when(done.isNotNull(), "Missed").otherwise(open_class))


def with_open_class(orders: DataFrame, as_of, policy: SlaPolicy) -> DataFrame:
    """Orders with the class of their age in ``sla_status``: Good, At Risk or Breached.

    A shipped order's age ends with its shipment, so the three classes add up to all orders and
    a finished order keeps its class.
    """
    until = F.coalesce(F.col("actual_ship_date"), as_ts(as_of))
    return orders.withColumn("sla_status", sla_class(F.col("order_date"), None, until, policy))


def remaining_days_class(due: Column, as_of: Column) -> Column:
    """Class by whole days left until ``due``: three or more, one or two, fewer."""
    left = F.datediff(due, as_of)
    return F.when(left >= 3, "Good").when(left >= 1, "At Risk").when(left.isNotNull(), "Breached")


def aging_bucket(days_overdue: Column, overdue: Column) -> Column:
    return (F.when(~overdue, AGING_BUCKETS[0]).when(days_overdue <= 30, AGING_BUCKETS[1])
            .when(days_overdue <= 60, AGING_BUCKETS[2]).when(days_overdue <= 90, AGING_BUCKETS[3])
            .otherwise(AGING_BUCKETS[4]))


def payment_status(total: Column, paid: Column, due: Column, as_of: Column,
                   grace_days: int = 0) -> Column:
    """Paid, Partial, Overdue or Pending, in this order of precedence."""
    return (F.when(paid >= total, "Paid").when(paid > 0, "Partial")
            .when(F.datediff(as_of, due) > grace_days, "Overdue").otherwise("Pending"))


def payment_efficiency(paid_on: Column, due: Column, invoiced: Column | None = None,
                       mode: str = "binary", terms_days: int = 30) -> Column:
    """``binary`` is 100 when paid by the due date, else 0. ``terms`` relates days to terms."""
    if mode == "binary":
        return F.when(paid_on <= due, F.lit(100)).otherwise(F.lit(0))
    if mode == "terms":
        return F.round(F.lit(100) * F.datediff(paid_on, invoiced).cast("decimal(10,0)")
                       / F.lit(terms_days), 2)
    raise ValueError(f"unknown mode {mode!r}")


def urgency(hours_left: Column) -> Column:
    return (F.when(hours_left < 0, "Overdue").when(hours_left <= 24, "Critical")
            .when(hours_left <= 48, "High").when(hours_left <= 72, "Medium").otherwise("Normal"))


URGENCY_RANK = {"Overdue": 0, "Critical": 1, "High": 2, "Medium": 3, "Normal": 4}
PRIORITY_RANK = {"High": 1, "Medium": 2, "Normal": 3}


def rank_of(order: dict[str, int], label: Column) -> Column:
    """Sort rank of a label; unknown labels last."""
    pairs = [F.lit(x) for item in order.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), label), F.lit(len(order) + 1))


def movement_label(code: Column) -> Column:
    return lookup(MOVEMENT_LABELS, code, code)


def category(message_type: Column, prefixes: dict[str, str] = CATEGORY_PREFIXES) -> Column:
    out = F.lit("Other")
    for prefix, label in prefixes.items():
        out = F.when(message_type.startswith(prefix), label).otherwise(out)
    return out
