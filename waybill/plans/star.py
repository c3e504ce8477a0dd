"""Star schema: dimensions with surrogate keys and history, facts, and metrics over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.functions import as_ts, average, pct
from waybill.operators.rows import missing_keys

C = F.col


def number_rows(df: DataFrame, key: str, name: str, start: Column | int = 0,
                digits: int = 2) -> DataFrame:
    """Dense numbers from ``start + 1``, the same for the same set of keys on every run.

    Rows are spread over 16^digits buckets by a hash of the key and numbered inside their bucket;
    an offset per bucket makes the numbers dense. No task sees more than one bucket, and only
    the bucket counts are ordered together. Raise ``digits`` for very large sets.
    """
    from pyspark.sql import Window

    bucketed = df.withColumn("_bucket", F.substring(F.md5(C(key)), 1, digits))
    counts = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # at most 16^digits rows by construction
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0))
                            .alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    base = F.lit(start) if isinstance(start, int) else start
    return (bucketed.withColumn("_pos", inside).join(offsets, "_bucket")
            .withColumn(name, (base + C("_offset") + C("_pos")).cast("bigint"))
            .drop("_bucket", "_pos", "_offset"))


def members(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """One row per non-null key with the greatest attribute values seen."""
    last = F.max(F.struct(*attributes)).alias("_a")
    return df.filter(C(key).isNotNull()).groupBy(key).agg(last).select(key, "_a.*")


def empty_dimension(source: DataFrame, key: str, attributes: Sequence[str],
                    surrogate: str) -> DataFrame:
    schema = T.StructType(
        [T.StructField(surrogate, T.LongType()), source.schema[key]]
        + [source.schema[a] for a in attributes]
        + [T.StructField("valid_from", T.DateType()), T.StructField("valid_to", T.DateType()),
           T.StructField("is_current", T.BooleanType())])
    return source.sparkSession.createDataFrame([], schema)


def load_dimension(source: DataFrame, key: str, attributes: Sequence[str], surrogate: str, *,
                   as_of, existing: DataFrame | None = None) -> DataFrame:
    """Dimension after loading ``source``: new members added, changed members versioned.

    ``source`` has one row per key (see ``members``). A changed member's current row is closed
    at ``as_of`` and a new current row opened; unchanged rows and history stay as they are.
    """
    today = F.to_date(as_ts(as_of))
    opened = {"valid_from": today, "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)}
    if existing is None:  # the first load compares with nothing
        columns = empty_dimension(source, key, attributes, surrogate).columns
        return number_rows(source, key, surrogate).withColumns(opened).select(*columns)
    dim = existing
    incoming = source.select(C(key).alias("_k"), F.struct(*attributes).alias("_new"))
    seen = dim.join(incoming, (C(key) == C("_k")) & C("is_current"), "left")
    changed = C("_k").isNotNull() & ~C("_new").eqNullSafe(F.struct(*attributes))
    kept = seen.withColumns({
        "valid_to": F.when(changed, today).otherwise(C("valid_to")),
        "is_current": C("is_current") & ~changed,
    }).select(*dim.columns)

    current = dim.filter("is_current").select(
        C(key).alias("_k"), F.struct(*attributes).alias("_old"))
    fresh = source.join(current, (C(key) == C("_k"))
                        & F.struct(*attributes).eqNullSafe(C("_old")), "left_anti")
    top = F.coalesce(dim.agg(F.max(surrogate)).scalar(), F.lit(0))
    added = number_rows(fresh, key, surrogate, top).withColumns(opened)
    return kept.unionByName(added.select(*dim.columns))


def new_members(source: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct source keys that have no current row in ``dim``; null keys are left out."""
    candidates = source.filter(C(key).isNotNull()).select(key).distinct()
    return missing_keys(candidates, dim.filter("is_current"), {key: key})


def date_key(ts: str) -> Column:
    return F.date_format(ts, "yyyyMMdd").cast("int")


def _current(dim: DataFrame, key: str, surrogate: str) -> DataFrame:
    return dim.filter("is_current").select(key, surrogate)


def fact_shipment(shipments: DataFrame, customers: DataFrame, carriers: DataFrame, *,
                  on_time_days: int = 7) -> DataFrame:
    """Shipments with surrogate keys, date keys, on-time flag and days from ship to delivery."""
    limit = C("actual_ship_date") + F.make_dt_interval(F.lit(on_time_days))
    return (shipments.join(_current(customers, "customer_id", "customer_key"),
                           "customer_id", "left")
            .join(_current(carriers, "carrier_id", "carrier_key"), "carrier_id", "left")
            .select("shipment_number", "customer_key", "carrier_key",
                    date_key("actual_ship_date").alias("ship_date_key"),
                    date_key("actual_delivery_date").alias("delivery_date_key"),
                    C("total_weight_kg").alias("total_weight"),
                    C("shipment_value").alias("total_value"),
                    F.coalesce(C("actual_delivery_date") <= limit, F.lit(False))
                    .alias("on_time_delivery_flag"),
                    F.datediff("actual_delivery_date", "actual_ship_date")
                    .alias("delivery_delay_days"),
                    F.to_date("actual_ship_date").alias("ship_day"),
                    C("shipment_status").alias("status"),
                    "origin_country", "destination_country"))


def fact_order(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return (orders.join(_current(customers, "customer_id", "customer_key"), "customer_id", "left")
            .select("order_number", "customer_key", date_key("order_date").alias("order_date_key"),
                    C("total_amount").alias("total_value"), C("order_status").alias("status"),
                    "order_date"))


def _on_time_rate() -> Column:
    return pct(F.count_if(C("on_time_delivery_flag")), F.count("*"))


def shipments_daily(fact: DataFrame, customers: DataFrame, carriers: DataFrame) -> DataFrame:
    """Shipments per ship day, customer and carrier over the star."""
    c = customers.select("customer_key", "customer_id", "customer_name")
    r = carriers.select("carrier_key", "carrier_id", "carrier_name")
    return (fact.join(c, "customer_key").join(r, "carrier_key")
            .groupBy("ship_day", "customer_id", "customer_name", "carrier_id", "carrier_name")
            .agg(F.count("*").alias("shipment_count"),
                 F.sum("total_weight").alias("total_weight"),
                 F.count_if(C("on_time_delivery_flag")).alias("on_time_count"),
                 _on_time_rate().alias("on_time_rate"),
                 average(C("delivery_delay_days")).alias("avg_delay_days")))


def shipments_by_route(fact: DataFrame, locations: DataFrame) -> DataFrame:
    """Shipments per origin and destination region; the location dimension in two roles."""
    origin = locations.select(C("country").alias("origin_country"),
                              C("region").alias("origin_region"))
    target = locations.select(C("country").alias("destination_country"),
                              C("region").alias("destination_region"))
    return (fact.join(origin, "origin_country").join(target, "destination_country")
            .groupBy("origin_region", "destination_region")
            .agg(F.count("*").alias("shipment_count"), F.sum("total_value").alias("total_value")))


def customer_metrics(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Aggregates on the surrogate key first, then joins the dimension to the small result."""
    per_key = fact.groupBy("customer_key").agg(
        F.count_distinct(C("shipment_number")).alias("total_shipments"),
        F.sum("total_weight").alias("total_weight"),
        F.sum("total_value").alias("total_value"),
        _on_time_rate().alias("on_time_rate"),
        F.max("ship_day").alias("last_shipment_day"))
    return per_key.join(customers.select("customer_key", "customer_id", "customer_name",
                                         "customer_type"), "customer_key").drop("customer_key")


def carrier_metrics(fact: DataFrame, carriers: DataFrame) -> DataFrame:
    per_key = fact.groupBy("carrier_key").agg(
        F.count_distinct(C("shipment_number")).alias("total_shipments"),
        F.sum("total_weight").alias("total_weight"),
        _on_time_rate().alias("on_time_rate"),
        average(C("delivery_delay_days")).alias("avg_delay_days"),
        F.max("ship_day").alias("last_shipment_day"))
    return per_key.join(carriers.select("carrier_key", "carrier_id", "carrier_name"),
                        "carrier_key").drop("carrier_key")


def carrier_performance(shipments: DataFrame, on_time_days: int = 7) -> DataFrame:
    """Shipments, weight, on-time rate and days to deliver per carrier, on silver."""
    limit = C("actual_ship_date") + F.make_dt_interval(F.lit(on_time_days))
    on_time = F.count_if(C("actual_delivery_date") <= limit)
    return shipments.groupBy("carrier_id").agg(
        F.count("*").alias("total_deliveries"),
        average(C("total_weight_kg")).alias("avg_weight"),
        on_time.alias("on_time_deliveries"),
        average(F.datediff("actual_delivery_date", "actual_ship_date")).alias("avg_delay_days"),
        pct(on_time, F.count("*")).alias("on_time_rate"))
