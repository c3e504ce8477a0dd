"""Shapes the given tables as raw messages and silver entities.

Every operator of the library runs over frames with these columns, whether they come from
parsed messages (``operators.extract``) or, as here, from the TPC-H-like tables. No row is left
out: the reference times lie at the end of the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions import (
    SLA_PRESETS,
    aging_bucket,
    as_ts,
    diff_boundary,
    payment_efficiency,
    payment_status,
    sla_class,
    with_open_class,
)
from waybill.operators.rows import dedupe_latest
from waybill.session import configure

# Reference times at the end of the given data.
ENTITY_AS_OF = "2001-08-01 23:00:00"
MESSAGE_AS_OF = "2024-01-31 00:00:00"

MONEY = "decimal(18,2)"
# Declared columns, so reading a table needs no look into its files first.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp",
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double, "
              "props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}
LINE_KEYS = ["l_orderkey", "l_linenumber"]


def _volume(part: Column) -> Column:
    """Cubic metres of a line, in litres of its part."""
    return (F.col("l_quantity").cast("decimal(15,3)") * (part % 40 + 1) / 1000).cast(
        "decimal(15,3)")


def _pick(key: Column, *labels: str) -> Column:
    """Label by remainder of ``key``."""
    out = F.lit(labels[-1])
    for i, label in enumerate(labels[:-1]):
        out = F.when(key % len(labels) == i, label).otherwise(out)
    return out


def _plus(ts: Column, hours: Column | None = None, days: Column | None = None) -> Column:
    d = F.lit(0) if days is None else days.cast("int")
    h = F.lit(0) if hours is None else hours.cast("int")
    return ts + F.make_dt_interval(d, h)


class Tables:
    """Lazy frames over one data folder."""

    def __init__(self, spark: SparkSession, folder: str,
                 as_of: str = ENTITY_AS_OF, message_as_of: str = MESSAGE_AS_OF):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")
        self.as_of = as_of
        self.message_as_of = message_as_of

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        """The table's file as a stream source."""
        return (self.spark.readStream.schema(SCHEMAS[name])
                .option("pathGlobFilter", f"{name}.parquet").parquet(self.folder))

    @cached_property
    def raw(self) -> DataFrame:
        """Raw messages from the event table."""
        return self.as_messages(self.table("events"))

    @cached_property
    def raw_stream(self) -> DataFrame:
        return self.as_messages(self.stream("events"))

    @staticmethod
    def as_messages(events: DataFrame) -> DataFrame:
        kind = F.col("event_type")
        message_type = (F.when(kind == "purchase", "ORDERS").when(kind == "click", "WHSCON")
                        .when(kind == "view", "SHPMNT").when(kind == "signup", "INVOIC")
                        .otherwise("DESADV"))
        idoc_type = (F.when(kind == "purchase", "ORDERS05").when(kind == "click", "WHSCON01")
                     .when(kind == "view", "SHPMNT05").when(kind == "signup", "INVOIC02")
                     .otherwise("DESADV01"))
        ts = F.col("ts")
        status = F.when((kind == "error") & (F.col("event_id") % 2 == 0), "51").otherwise("03")
        docnum = F.col("event_id").cast("string")
        return events.select(
            docnum.alias("docnum"),
            message_type.alias("message_type"),
            idoc_type.alias("idoc_type"),
            _pick(F.col("user_id"), "PRD", "QAS", "DEV").alias("sap_system"),
            status.alias("status"),
            F.struct(docnum.alias("docnum"), status.alias("status"),
                     F.date_format(ts, "yyyyMMdd").alias("credat")).alias("control"),
            ts.alias("timestamp"),
            (ts + F.make_dt_interval(secs=(F.col("event_id") % 400).cast("int")))
            .alias("ingestion_time"),
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            F.col("props").alias("data"),
            F.col("user_id").cast("string").alias("sender"),
            F.col("value").cast(MONEY).alias("value"),
        )

    @cached_property
    def _orders_timed(self) -> DataFrame:
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        out = self.table("orders").withColumn(
            "order_date", _plus(F.col("o_orderdate"), hours=key % 24))
        return out.select(
            "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice",
            "order_date",
            _plus(F.col("order_date"), hours=12 + key % 60).alias("ship_ts"),
            _plus(F.col("order_date"), hours=12 + key % 60, days=1 + cust % 6).alias("del_ts"),
        )

    @cached_property
    def _orders_moved(self) -> DataFrame:
        now = as_ts(self.as_of)
        key = F.col("o_orderkey")
        moves = (key % 7 != 0) & (key % 20 != 0)
        return self._orders_timed.withColumns({
            "actual_ship_date": F.when((F.col("ship_ts") <= now) & moves, F.col("ship_ts")),
            "actual_delivery_date": F.when((F.col("del_ts") <= now) & moves, F.col("del_ts"))})

    def _order_cells(self) -> list[Column]:
        now = as_ts(self.as_of)
        key = F.col("o_orderkey")
        priority = (F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "High")
                    .when(F.col("o_orderpriority") == "3-MEDIUM", "Medium").otherwise("Low"))
        status = (F.when(key % 20 == 0, "Cancelled")
                  .when(F.col("actual_delivery_date").isNotNull(), "Delivered")
                  .when(F.col("actual_ship_date").isNotNull(), "Shipped").otherwise("Pending"))
        age = diff_boundary("hour", now, F.col("order_date"))
        return [
            key.cast("string").alias("order_number"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("order_date"),
            _plus(F.col("order_date"), days=F.lit(7)).alias("requested_delivery_date"),
            _plus(F.col("order_date"), days=3 + key % 5).alias("promised_delivery_date"),
            F.col("actual_ship_date"),
            F.col("actual_delivery_date"),
            priority.alias("priority"),
            F.col("o_totalprice").cast(MONEY).alias("total_amount"),
            status.alias("order_status"),
            age.alias("order_age_hours"),
            (age > 24).alias("is_delayed"),
            sla_class(F.col("order_date"), F.col("actual_ship_date"), now,
                      SLA_PRESETS["default"]).alias("sla_status"),
            _pick(key, "PRD", "QAS", "DEV").alias("sap_system"),
            F.lit("CUSTOMER").alias("partner_access_scope"),
        ]

    @cached_property
    def order_facts(self) -> DataFrame:
        """Silver orders without customer name and currency; needs no join."""
        return self._orders_moved.select(*self._order_cells())

    @cached_property
    def orders(self) -> DataFrame:
        """Silver orders: the order table joined to its customers."""
        customers = self.table("customer").select("c_custkey", "c_name", "c_nationkey")
        return self._orders_moved.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
            *self._order_cells(), F.col("c_name").alias("customer_name"),
            _pick(F.col("c_nationkey"), "USD", "EUR", "GBP").alias("currency"))

    def _gold(self, orders: DataFrame, preset: str = "inclusive") -> DataFrame:
        return with_open_class(orders, self.as_of, SLA_PRESETS[preset])

    @cached_property
    def gold_order_facts(self) -> DataFrame:
        """Order facts with the three service-level classes that the daily tables count."""
        return self._gold(self.order_facts)

    @cached_property
    def gold_orders(self) -> DataFrame:
        return self._gold(self.orders)

    @cached_property
    def gold_orders_with_lines(self) -> DataFrame:
        return self._gold(self.orders_with_lines)

    @cached_property
    def half_day_order_facts(self) -> DataFrame:
        """Order facts classified by half a day and a day, limits excluded."""
        return self._gold(self.order_facts, "half_day")

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with repeated (order, line) pairs reduced to the latest one."""
        return dedupe_latest(self.table("lineitem"), LINE_KEYS,
                             ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice",
                              "l_quantity", "l_discount", "l_tax", "l_returnflag",
                              "l_linestatus"])

    @cached_property
    def order_lines(self) -> DataFrame:
        """Lines as order items."""
        return self.lines.select(
            F.col("l_orderkey").cast("string").alias("order_number"),
            F.col("l_linenumber").alias("item_number"),
            F.col("l_partkey").cast("string").alias("material_id"),
            F.col("l_quantity").cast("decimal(15,3)").alias("quantity"),
            F.col("l_extendedprice").cast(MONEY).alias("net_amount"),
        )

    @cached_property
    def orders_with_lines(self) -> DataFrame:
        """Silver orders plus line totals; orders without lines have zero totals."""
        totals = self.order_lines.groupBy("order_number").agg(
            F.count("*").alias("total_lines"), F.sum("quantity").alias("total_quantity"))
        return self.orders.join(totals, "order_number", "left").withColumns({
            "total_lines": F.coalesce("total_lines", F.lit(0)),
            "total_quantity": F.coalesce("total_quantity", F.lit(0).cast("decimal(15,3)")),
            "total_weight_kg": F.coalesce("total_quantity", F.lit(0).cast("decimal(15,3)")),
        })

    @cached_property
    def shipments(self) -> DataFrame:
        """Silver shipments: one per distinct order line."""
        return self.measured_shipments.drop("origin_location", "destination_location",
                                            "transport_mode", "total_packages", "total_volume_m3")

    @cached_property
    def measured_shipments(self) -> DataFrame:
        """Silver shipments with places, mode, packages and volume."""
        now = as_ts(self.as_of)
        okey, line = F.col("l_orderkey"), F.col("l_linenumber")
        part, supp = F.col("l_partkey"), F.col("l_suppkey")
        orders = self._orders_timed.select("o_orderkey", "o_custkey", "order_date")
        customers = self.table("customer").select("c_custkey", "c_name", "c_nationkey")
        nations = self.table("nation").select("n_nationkey", "n_name")
        left = _plus(F.col("order_date"), hours=12 + (okey + line) % 96)
        base = (self.lines.join(orders, okey == F.col("o_orderkey"))
                .join(customers, F.col("o_custkey") == F.col("c_custkey"))
                .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
                .withColumn("left_ts", left)
                .withColumn("arrived_ts", _plus(left, days=1 + supp % 8)))
        shipped = F.when(F.col("left_ts") <= now, F.col("left_ts"))
        arrived = F.when((F.col("arrived_ts") <= now) & (supp % 25 != 0), F.col("arrived_ts"))
        base = base.withColumns({
            "planned_ship_date": _plus(F.col("order_date"), days=F.lit(1)),
            "actual_ship_date": shipped,
            "planned_delivery_date": _plus(F.col("left_ts"), days=2 + part % 5),
            "actual_delivery_date": arrived,
        })
        late_by = diff_boundary("hour", F.col("actual_delivery_date"),
                                F.col("planned_delivery_date"))
        in_transit = F.col("actual_ship_date").isNotNull() & F.col("actual_delivery_date").isNull()
        status = (F.when(F.col("actual_delivery_date").isNotNull(), "Delivered")
                  .when(F.col("actual_ship_date").isNotNull(), "In Transit")
                  .otherwise("Planned"))
        carrier = F.concat(F.lit("CARRIER-"), (supp % 20).cast("string"))
        return base.select(
            F.concat_ws("-", okey.cast("string"), line.cast("string")).alias("shipment_number"),
            F.concat(F.lit("TRK"), okey.cast("string"), F.lit("x"), line.cast("string"))
            .alias("tracking_number"),
            okey.cast("string").alias("order_number"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            carrier.alias("carrier_id"),
            F.concat(F.lit("Carrier "), (supp % 20).cast("string")).alias("carrier_name"),
            _pick(part, "STANDARD", "EXPRESS").alias("service_level"),
            F.concat(F.lit("NATION_"), (supp % 25).cast("string")).alias("origin_country"),
            F.col("n_name").alias("destination_country"),
            "planned_ship_date", "actual_ship_date", "planned_delivery_date",
            "actual_delivery_date",
            status.alias("shipment_status"),
            diff_boundary("hour", F.col("actual_ship_date"), F.col("planned_ship_date"))
            .alias("ship_delay_hours"),
            late_by.alias("delivery_delay_hours"),
            diff_boundary("hour", F.col("actual_delivery_date"), F.col("actual_ship_date"))
            .alias("transit_time_hours"),
            (F.col("actual_delivery_date") <= F.col("planned_delivery_date")).alias("is_on_time"),
            in_transit.alias("is_in_transit"),
            F.col("l_extendedprice").cast(MONEY).alias("shipment_value"),
            F.col("l_quantity").cast("decimal(15,3)").alias("total_weight_kg"),
            _pick(okey, "PRD", "QAS", "DEV").alias("sap_system"),
            F.concat(F.lit("ORG-"), (supp % 4).cast("string")).alias("organization_id"),
            F.concat(F.lit("DEPT-"), (part % 3).cast("string")).alias("department"),
            F.lit("CARRIER_CUSTOMER").alias("partner_access_scope"),
            F.concat(F.lit("LOC-"), (supp % 25).cast("string")).alias("origin_location"),
            F.concat(F.lit("LOC-"), F.col("c_nationkey").cast("string"))
            .alias("destination_location"),
            _pick(supp, "Road", "Rail", "Air", "Sea").alias("transport_mode"),
            (1 + F.col("l_quantity").cast("bigint") % 7).alias("total_packages"),
            _volume(part).alias("total_volume_m3"),
        )

    @cached_property
    def warehouse(self) -> DataFrame:
        """Silver warehouse movements, one per distinct order line; needs no join."""
        return self.measured_warehouse.drop("volume_m3")

    @cached_property
    def measured_warehouse(self) -> DataFrame:
        """Silver warehouse movements with their volume."""
        okey, line = F.col("l_orderkey"), F.col("l_linenumber")
        part, supp = F.col("l_partkey"), F.col("l_suppkey")
        number = supp % 5 + 1
        warehouse_id = F.concat(F.lit("WH00"), number.cast("string"))
        flagged = F.col("l_returnflag") == "R"
        return self.lines.select(
            F.concat_ws("-", F.lit("MV"), okey.cast("string"), line.cast("string"))
            .alias("movement_id"),
            warehouse_id.alias("warehouse_id"),
            F.when(number >= 3, F.concat(F.lit("PARTNER-"), warehouse_id)).otherwise("")
            .alias("warehouse_partner_id"),
            _pick(line, "GR", "GI", "TR", "CC").alias("movement_type"),
            _plus(F.col("l_shipdate"), hours=part % 24)
            .alias("movement_timestamp"),
            F.col("l_quantity").cast("decimal(15,3)").alias("quantity"),
            F.col("l_quantity").cast("decimal(15,3)").alias("weight_kg"),
            part.cast("string").alias("material_id"),
            F.concat(F.lit("OP-"), (part % 50).cast("string")).alias("operator_id"),
            F.concat(F.lit("EQ-"), (part % 20).cast("string")).alias("equipment_id"),
            F.concat(F.lit("Z"), (part % 4).cast("string")).alias("zone"),
            F.concat_ws("-", F.lit("LOC"), (part % 4).cast("string"), (supp % 9).cast("string"))
            .alias("location_code"),
            (part % 500).alias("processing_time_minutes"),
            flagged.alias("exception_flag"),
            F.when(flagged, _pick(supp, "Damage", "Shortage", "Quality")).alias("exception_type"),
            (F.col("l_linestatus") == "O").alias("inspection_required"),
            F.when(F.col("l_returnflag") == "A", "OK").when(F.col("l_returnflag") == "N", "Hold")
            .otherwise("Rejected").alias("quality_status"),
            okey.cast("string").alias("order_number"),
            _pick(okey, "PRD", "QAS", "DEV").alias("sap_system"),
            F.lit("WAREHOUSE_PARTNER").alias("partner_access_scope"),
            _volume(part).alias("volume_m3"),
        )

    @cached_property
    def invoices(self) -> DataFrame:
        """Silver invoices: one per order that has lines."""
        return self.measured_invoices.drop("gross_margin_pct")

    @cached_property
    def measured_invoices(self) -> DataFrame:
        """Silver invoices with their gross margin."""
        now = as_ts(self.as_of)
        price = F.col("l_extendedprice").cast(MONEY)
        off, rate = F.col("l_discount").cast("decimal(4,2)"), F.col("l_tax").cast("decimal(4,2)")
        sums = self.lines.groupBy("l_orderkey").agg(
            F.sum(price).cast(MONEY).alias("subtotal_amount"),
            F.sum((price * off).cast(MONEY)).cast(MONEY).alias("discount_amount"),
            F.sum((price * (F.lit(1).cast("decimal(4,2)") - off) * rate).cast(MONEY)).cast(MONEY)
            .alias("tax_amount"),
            F.count("*").alias("total_line_items"),
        )
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        key = F.col("o_orderkey")
        base = orders.join(sums, key == F.col("l_orderkey")).withColumns({
            "invoice_date": F.col("o_orderdate"),
            "shipping_charges": F.lit(0).cast(MONEY),
            "total_amount": (F.col("subtotal_amount") + F.col("tax_amount")
                             - F.col("discount_amount")).cast(MONEY),
        })
        base = base.withColumn("due_date", _plus(F.col("invoice_date"), days=F.lit(30)))
        paid_ts = _plus(F.col("invoice_date"), days=key % 60)
        base = base.withColumn("payment_date", F.when((key % 4 >= 2) & (paid_ts <= now), paid_ts))
        paid = (F.when(key % 4 == 1, F.round(F.col("total_amount") / 2, 2).cast(MONEY))
                .when(F.col("payment_date").isNotNull(), F.col("total_amount"))
                .otherwise(F.lit(0).cast(MONEY)))
        base = base.withColumn("amount_paid", paid)
        base = base.withColumns({
            "amount_due": (F.col("total_amount") - F.col("amount_paid")).cast(MONEY),
            "payment_status": payment_status(F.col("total_amount"), F.col("amount_paid"),
                                             F.col("due_date"), now),
            "days_overdue": F.datediff(now, F.col("due_date")),
        })
        overdue = (F.col("days_overdue") > 0) & (F.col("payment_status") != "Paid")
        return base.select(
            F.concat(F.lit("INV-"), key.cast("string")).alias("invoice_number"),
            key.cast("string").alias("order_number"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            _pick(key, "Standard", "Credit", "Debit", "Pro-forma", "Standard")
            .alias("invoice_type"),
            "invoice_date", "due_date", "payment_date",
            "subtotal_amount", "tax_amount", "discount_amount", "shipping_charges",
            "total_amount", "amount_paid", "amount_due", "total_line_items",
            "payment_status", "days_overdue",
            overdue.alias("is_overdue"),
            aging_bucket(F.col("days_overdue"), overdue).alias("aging_bucket"),
            payment_efficiency(F.col("payment_date"), F.col("due_date"))
            .alias("payment_efficiency"),
            _pick(key, "Storage", "Transportation", "Handling").alias("service_type"),
            (key % 17 == 0).alias("is_disputed"),
            F.year("invoice_date").alias("fiscal_year"),
            F.month("invoice_date").alias("fiscal_period"),
            _pick(F.col("o_custkey"), "USD", "EUR", "GBP").alias("currency"),
            _pick(key, "PRD", "QAS", "DEV").alias("sap_system"),
            F.lit("CUSTOMER").alias("partner_access_scope"),
            # every seventh invoice has no cost yet, so no margin
            F.when(key % 7 != 0, (key % 45 - 5).cast("decimal(5,2)")).alias("gross_margin_pct"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        """Customer master data with country and region."""
        return (self.table("customer")
                .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
                .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
                .select(F.col("c_custkey").cast("string").alias("customer_id"),
                        F.col("c_name").alias("customer_name"),
                        F.col("c_mktsegment").alias("segment"),
                        F.col("n_name").alias("country"),
                        F.col("r_name").alias("region")))

    @cached_property
    def carriers(self) -> DataFrame:
        """Carrier master data: the distinct carriers behind the suppliers."""
        n = (F.col("s_suppkey") % 20).cast("string")
        return (self.table("supplier").select(
            F.concat(F.lit("CARRIER-"), n).alias("carrier_id"),
            F.concat(F.lit("Carrier "), n).alias("carrier_name"),
            F.concat(F.lit("SC"), n).alias("scac")).distinct())

    @cached_property
    def locations(self) -> DataFrame:
        """Location master data: countries with their region."""
        return (self.table("nation")
                .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
                .select(F.concat(F.lit("LOC-"), F.col("n_nationkey").cast("string"))
                        .alias("location_id"),
                        F.col("n_name").alias("country"), F.col("r_name").alias("region")))

    @cached_property
    def warehouses(self) -> DataFrame:
        """Warehouse master data seen in the lines' suppliers."""
        number = F.col("s_suppkey") % 5 + 1
        wid = F.concat(F.lit("WH00"), number.cast("string"))
        return self.table("supplier").select(
            wid.alias("warehouse_id"),
            F.concat(F.lit("Warehouse "), number.cast("string")).alias("warehouse_name"),
            F.when(number >= 3, F.concat(F.lit("PARTNER-"), wid)).otherwise("")
            .alias("partner_id"),
            (number >= 3).alias("is_partner_operated")).distinct()


class StoredTables(Tables):
    """Silver read from tables instead of derived from the raw ones in every query.

    ``path`` is a folder that all executors share; a table is written when it is first read, with
    all its columns or those that ``columns`` names for it.
    """

    SILVER = ("orders", "order_facts", "orders_with_lines", "lines", "order_lines", "shipments",
              "warehouse", "invoices", "customers", "carriers", "warehouses")

    def __init__(self, spark: SparkSession, folder: str, path: str,
                 columns: Mapping[str, Sequence[str]] | None = None, **times):
        super().__init__(spark, folder, **times)
        self.path = path
        self.columns = columns or {}
        self._lock = RLock()


def _stored(name: str) -> cached_property:
    derive = getattr(Tables, name).func

    def read(self) -> DataFrame:
        path = f"{self.path}/{name}"
        with self._lock:  # jobs that run at once write it once
            if name not in self.__dict__:
                made = derive(self)
                made.select(*self.columns.get(name, made.columns)).write.mode("overwrite").parquet(
                    path)
                self.__dict__[name] = self.spark.read.parquet(path)
            return self.__dict__[name]

    prop = cached_property(read)
    prop.__set_name__(StoredTables, name)
    return prop


for _name in StoredTables.SILVER:
    setattr(StoredTables, _name, _stored(_name))
