"""Partner queries: filter trees, ordering, paging, presets, search and shipment metrics.

Filters are data (nested dicts); no text is ever parsed as SQL.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import as_ts, average, pct, week_start
from waybill.operators.rows import union_all

C = F.col
DEFAULT_LIMIT, MAX_LIMIT = 50, 100

OPERATORS = {
    "eq": lambda c, v: c == v,
    "ne": lambda c, v: c != v,
    "gt": lambda c, v: c > v,
    "ge": lambda c, v: c >= v,
    "lt": lambda c, v: c < v,
    "le": lambda c, v: c <= v,
}


def condition(df: DataFrame, where: Mapping[str, Any]) -> Column:
    """Filter tree to a predicate. Several entries on one level combine by AND.

    ``{"and": [...]}``, ``{"or": [...]}``, ``{"not": {...}}`` or ``{column: {operator: value}}``.
    Only columns of ``df`` may be named.
    """
    parts: list[Column] = []
    for name, node in where.items():
        if name in ("and", "or"):
            inner = [condition(df, n) for n in node]
            if not inner:
                raise ValueError(f"{name!r} needs at least one condition")
            parts.append(reduce((lambda a, b: a & b) if name == "and" else (lambda a, b: a | b),
                                inner))
        elif name == "not":
            parts.append(~condition(df, node))
        else:
            if name not in df.columns:
                raise ValueError(f"unknown column {name!r}")
            kind = df.schema[name].dataType
            for op, value in node.items():
                if op == "in":
                    parts.append(C(name).isin(*[F.lit(v).cast(kind) for v in value]))
                elif op == "contains":
                    parts.append(C(name).contains(value))
                elif op == "startsWith":
                    parts.append(C(name).startswith(value))
                elif op in OPERATORS:
                    parts.append(OPERATORS[op](C(name), F.lit(value).cast(kind)))
                else:
                    raise ValueError(f"unknown operator {op!r}")
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def ordering(df: DataFrame, order_by: Sequence[tuple[str, str]], key: str) -> list[Column]:
    """Sort columns with the key as tie-break, so the order is total; nulls come last."""
    out = []
    for name, direction in order_by:
        if name not in df.columns:
            raise ValueError(f"unknown column {name!r}")
        out.append(C(name).desc_nulls_last() if direction.upper() == "DESC"
                   else C(name).asc_nulls_last())
    return out if key in [n for n, _ in order_by] else [*out, C(key).asc_nulls_last()]


def query(df: DataFrame, where: Mapping[str, Any] | None = None,
          order_by: Sequence[tuple[str, str]] = (), *, key: str, limit: int = DEFAULT_LIMIT,
          offset: int = 0) -> DataFrame:
    """Filtered, ordered slice. ``limit`` is at most ``MAX_LIMIT``."""
    if not 0 < limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    rows = df.filter(condition(df, where)) if where else df
    out = rows.orderBy(*ordering(df, order_by, key))
    return (out.offset(offset) if offset else out).limit(limit)


def total_count(df: DataFrame, where: Mapping[str, Any] | None = None) -> DataFrame:
    """One row with the number of rows a query would have without its limit."""
    rows = df.filter(condition(df, where)) if where else df
    return rows.agg(F.count("*").alias("total_count"))


def encode_cursor(values: Sequence[Any]) -> str:
    """A null stays null, so it is never mistaken for a text."""
    return base64.urlsafe_b64encode(json.dumps(
        [None if v is None else str(v) for v in values]).encode()).decode()


def decode_cursor(cursor: str) -> list[str | None]:
    return json.loads(base64.urlsafe_b64decode(cursor.encode()).decode())


def beyond(df: DataFrame, order_by: Sequence[tuple[str, str]], *, key: str,
           after: str) -> Column:
    """Whether a row comes after the cursor, in the order of ``ordering`` with its nulls last."""
    steps = [*order_by] if key in [n for n, _ in order_by] else [*order_by, (key, "ASC")]
    later, same = F.lit(False), F.lit(True)
    for (name, direction), value in zip(steps, decode_cursor(after), strict=True):
        if value is None:  # nothing of this column comes after a null
            same = same & C(name).isNull()
            continue
        here = F.lit(value).cast(df.schema[name].dataType)
        past = C(name) < here if direction.upper() == "DESC" else C(name) > here
        later = later | (same & (past | C(name).isNull()))
        same = same & C(name).eqNullSafe(here)
    return F.coalesce(later, F.lit(False))


def page_rows(df: DataFrame, order_by: Sequence[tuple[str, str]], *, key: str,
              first: int = DEFAULT_LIMIT, after: str | None = None) -> DataFrame:
    """Up to ``first + 1`` rows after the cursor; the extra row tells whether more follow.

    The position is a filter on the sort columns, so a deep page costs no more than the first.
    Sort columns may be null; nulls come last in either direction.
    """
    if not 0 < first <= MAX_LIMIT:
        raise ValueError(f"first must be between 1 and {MAX_LIMIT}")
    rows = df if after is None else df.filter(beyond(df, order_by, key=key, after=after))
    return rows.orderBy(*ordering(df, order_by, key)).limit(first + 1)


@dataclass(frozen=True)
class Page:
    rows: list
    has_next: bool
    end_cursor: str | None


def page(df: DataFrame, order_by: Sequence[tuple[str, str]], *, key: str,
         first: int = DEFAULT_LIMIT, after: str | None = None) -> Page:
    """One page as rows; at most ``MAX_LIMIT + 1`` rows ever reach the caller."""
    got = page_rows(df, order_by, key=key, first=first, after=after).collect()
    rows = got[:first]
    names = [n for n, _ in order_by]
    names = names if key in names else [*names, key]
    cursor = encode_cursor([rows[-1][n] for n in names]) if rows else None
    return Page(rows, len(got) > first, cursor)


# ---------------------------------------------------------------- presets

def _filters(**conditions: tuple[str, str, Any]) -> dict[str, Any]:
    nodes = [{column: {op: value}} for column, op, value in conditions.values()
             if value is not None]
    return {"and": nodes} if nodes else {}


def shipments_query(status=None, date_from=None, date_to=None, tracking_number=None) -> dict:
    return _filters(a=("shipment_status", "eq", status), b=("planned_ship_date", "ge", date_from),
                    c=("planned_ship_date", "le", date_to),
                    d=("tracking_number", "eq", tracking_number))


def orders_query(status=None, date_from=None, date_to=None, sla_status=None) -> dict:
    return _filters(a=("order_status", "eq", status), b=("order_date", "ge", date_from),
                    c=("order_date", "le", date_to), d=("sla_status", "eq", sla_status))


def movements_query(warehouse_id=None, movement_type=None, date_from=None, date_to=None) -> dict:
    return _filters(a=("warehouse_id", "eq", warehouse_id),
                    b=("movement_type", "eq", movement_type),
                    c=("movement_timestamp", "ge", date_from),
                    d=("movement_timestamp", "le", date_to))


def invoices_query(period=None, status=None, aging_bucket=None) -> dict:
    """``period`` is YYYY-MM."""
    start = end = None
    if period:
        year, month = (int(x) for x in period.split("-"))
        start = f"{year}-{month:02d}-01 00:00:00"
        end = f"{year + month // 12}-{month % 12 + 1:02d}-01 00:00:00"
    return _filters(a=("invoice_date", "ge", start), b=("invoice_date", "lt", end),
                    c=("payment_status", "eq", status), d=("aging_bucket", "eq", aging_bucket))


def shipment_filters(customer_ids=None, statuses=None, origin_countries=None,
                     destination_countries=None, carrier_ids=None, shipment_numbers=None,
                     start=None, end=None, on_time=None, min_value=None, max_value=None) -> dict:
    return _filters(a=("customer_id", "in", customer_ids), b=("shipment_status", "in", statuses),
                    c=("origin_country", "in", origin_countries),
                    d=("destination_country", "in", destination_countries),
                    e=("carrier_id", "in", carrier_ids),
                    f=("shipment_number", "in", shipment_numbers),
                    g=("planned_ship_date", "ge", start), h=("planned_ship_date", "le", end),
                    i=("is_on_time", "eq", on_time), j=("shipment_value", "ge", min_value),
                    k=("shipment_value", "le", max_value))


# ---------------------------------------------------------------- metrics and search

UNITS = {
    "DAY": lambda c: F.to_date(c), "WEEK": week_start,
    "MONTH": lambda c: F.to_date(F.date_trunc("month", c)),
    "QUARTER": lambda c: F.to_date(F.date_trunc("quarter", c)),
    "YEAR": lambda c: F.to_date(F.date_trunc("year", c)),
}


def _in_range(df: DataFrame, start, end, ts: str = "actual_ship_date") -> DataFrame:
    return df.filter((C(ts) >= as_ts(start)) & (C(ts) < as_ts(end)))


def _metric_columns() -> list[Column]:
    done = C("actual_delivery_date").isNotNull()
    return [
        F.count("*").alias("total_shipments"),
        F.count_if(done & C("is_on_time")).alias("on_time_shipments"),
        F.count_if(done & ~C("is_on_time")).alias("late_shipments"),
        pct(F.count_if(done & C("is_on_time")), F.count_if(done)).alias("on_time_rate"),
        average(C("transit_time_hours")).alias("avg_transit_hours"),
        F.sum("shipment_value").alias("total_value"),
        F.sum("total_weight_kg").alias("total_weight"),
    ]


def shipment_metrics(shipments: DataFrame, start, end, group_by: str = "DAY",
                     where: Mapping[str, Any] | None = None) -> DataFrame:
    rows = _in_range(shipments, start, end)
    rows = rows.filter(condition(rows, where)) if where else rows
    period = UNITS[group_by](C("actual_ship_date")).alias("period")
    return rows.groupBy(period).agg(*_metric_columns())


def shipment_summary(shipments: DataFrame, start, end) -> DataFrame:
    return _in_range(shipments, start, end).agg(*_metric_columns())


def on_time_rate(shipments: DataFrame, start, end, customer_id=None,
                 carrier_id=None) -> DataFrame:
    rows = _in_range(shipments, start, end)
    where = _filters(a=("customer_id", "eq", customer_id), b=("carrier_id", "eq", carrier_id))
    done = C("actual_delivery_date").isNotNull()
    return rows.filter(condition(rows, where)).agg(
        pct(F.count_if(done & C("is_on_time")), F.count_if(done)).alias("on_time_rate"))


def average_delivery_time(shipments: DataFrame, start, end, customer_id=None) -> DataFrame:
    rows = _in_range(shipments, start, end)
    where = _filters(a=("customer_id", "eq", customer_id))
    return rows.filter(condition(rows, where)).agg(
        average(C("transit_time_hours")).alias("average_delivery_hours"))


def search(tables: Mapping[str, tuple[DataFrame, str, Sequence[str]]], text: str,
           types: Sequence[str], limit: int = 20) -> DataFrame:
    """Rows of the chosen entities with ``text`` in one of the searched columns.

    ``tables`` maps a type to (frame, key column, searched columns). Case does not matter. A page
    of ``limit`` rows; ``total`` tells how many there are in all.
    """
    needle = text.lower()
    parts = []
    for kind in types:
        df, key, columns = tables[kind]
        hit = reduce(lambda a, b: a | b, [F.lower(C(c)).contains(needle) for c in columns])
        parts.append(df.filter(F.coalesce(hit, F.lit(False))).select(
            F.lit(kind).alias("type"), C(key).cast("string").alias("id"),
            F.concat_ws(" | ", *columns).alias("label")))
    hits = union_all(parts)
    total = hits.agg(F.count("*")).scalar()
    return hits.orderBy("type", "id").limit(limit).withColumn("total", total)


def carrier_sla(shipments: DataFrame) -> DataFrame:
    """Delivered shipments per carrier: on time, late, share on time, mean delay in hours."""
    done = shipments.filter(C("actual_delivery_date").isNotNull())
    return done.groupBy("carrier_id").agg(
        F.count_if(C("is_on_time")).alias("ontime_shipments"),
        F.count_if(~C("is_on_time")).alias("late_shipments"),
        F.count("*").alias("total_shipments"),
        pct(F.count_if(C("is_on_time")), F.count("*")).alias("ontime_percentage"),
        average(C("delivery_delay_hours")).alias("avg_delay_hours"))
