"""Message analytics over raw messages.

``raw`` has docnum, message_type, idoc_type, sap_system, status, control, timestamp,
ingestion_time and data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import (
    as_ts,
    average,
    bin_floor,
    day_of_week,
    diff_boundary,
    pct,
    pct_change,
    ratio,
)
from waybill.functions.payload import field, head, moment, number, only, parsed
from waybill.functions.policies import DAY_NAMES, category, lookup
from waybill.operators.rows import business_hours, newer_than, top_by
from waybill.operators.series import gap_fill, period_change

C = F.col
OK_STATUS = "03"
VALID_STATUS = ("03", "30", "31")
# Document names by message kind.
DOC_TYPES = {"ORDERS05": "Purchase Order", "WHSCON01": "Warehouse Confirmation",
             "DESADV01": "Delivery Note", "SHPMNT05": "Shipment", "INVOIC02": "Invoice"}


def latency(unit: str = "second") -> Column:
    return diff_boundary(unit, C("ingestion_time"), C("timestamp"))


def failed_status() -> Column:
    return C("control.status") != OK_STATUS


def totals(raw: DataFrame) -> DataFrame:
    return raw.agg(F.min("timestamp").alias("first_message"),
                   F.max("timestamp").alias("last_message"),
                   F.count("*").alias("total_messages"))


def most_recent(raw: DataFrame, n: int = 10) -> DataFrame:
    rows = raw.select("timestamp", "idoc_type", "message_type", "sap_system",
                      C("control.docnum").alias("docnum"))
    return top_by(rows, n, F.desc("timestamp"), "docnum")


def count_by(raw: DataFrame, *by: Column | str, name: str = "total") -> DataFrame:
    return raw.groupBy(*by).agg(F.count("*").alias(name))


def by_category(raw: DataFrame) -> DataFrame:
    return count_by(raw, category(C("message_type")).alias("category"))


def volume(raw: DataFrame, seconds: int, window: str | None = None, *, as_of) -> DataFrame:
    rows = newer_than(raw, "timestamp", window, as_of=as_of) if window else raw
    return count_by(rows, bin_floor(C("timestamp"), seconds).alias("bin"))


def hourly_by_type(raw: DataFrame, n: int = 50, *, as_of) -> DataFrame:
    rows = newer_than(raw, "timestamp", "7 days", as_of=as_of)
    counts = count_by(rows, "message_type", bin_floor(C("timestamp"), 3600).alias("hour"))
    return top_by(counts, n, F.desc("hour"), F.desc("total"), "message_type")


def by_hour_of_day(raw: DataFrame) -> DataFrame:
    return count_by(raw, F.hour("timestamp").alias("hour")).orderBy("hour")


def by_weekday(raw: DataFrame) -> DataFrame:
    counts = count_by(raw, day_of_week(C("timestamp")).alias("day_number"))
    names = F.array(*[F.lit(d) for d in DAY_NAMES])
    return counts.withColumn("day_name", F.get(names, C("day_number"))).orderBy("day_number")


def peak_hour(raw: DataFrame, *, as_of) -> DataFrame:
    rows = newer_than(raw, "timestamp", "7 days", as_of=as_of)
    return top_by(count_by(rows, F.hour("timestamp").alias("hour")), 1, F.desc("total"), "hour")


def top_types(raw: DataFrame, n: int = 5) -> DataFrame:
    return top_by(count_by(raw, "message_type"), n, F.desc("total"), "message_type")


def weekly_orders(raw: DataFrame, *, as_of, approx: bool = False) -> DataFrame:
    rows = newer_than(raw, "timestamp", "7 days", as_of=as_of).filter(
        C("message_type").startswith("ORDERS"))
    systems = F.approx_count_distinct("sap_system") if approx else F.count_distinct("sap_system")
    return rows.agg(F.count("*").alias("total_orders"), systems.alias("systems"),
                    ratio(F.count("*"), F.lit(7)).alias("orders_per_day"))


def processed_orders(raw: DataFrame, *, as_of) -> DataFrame:
    rows = newer_than(raw, "timestamp", "24 hours", as_of=as_of)
    return rows.filter((C("message_type") == "ORDERS") & (C("control.status") == OK_STATUS)).select(
        "timestamp", C("control.docnum").alias("order_number"), "sap_system",
        C("control.status").alias("status")).orderBy(F.desc("timestamp"), "order_number")


def growth_by_type(raw: DataFrame, *, as_of) -> DataFrame:
    return period_change(raw, "timestamp", 7 * 86400, ["message_type"], as_of=as_of).filter(
        C("current") > 0).orderBy(F.desc("current"), "message_type")


def latency_percentiles(raw: DataFrame, by: Sequence[str] = (), *, approx: bool = False,
                        points: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Latency statistics. Equal latencies are counted first, so the exact percentile works on
    distinct values with a frequency and stays small however many messages there are."""
    seconds = raw.select(*by, latency().alias("s"))
    if approx:
        stats = seconds.groupBy(*by).agg(
            F.count("s").alias("messages"), average(C("s")).alias("avg_latency"),
            F.max("s").alias("max_latency"),
            *[F.percentile_approx("s", p).cast("double").alias(f"p{round(p * 100)}")
              for p in points])
        return stats
    counts = seconds.groupBy(*by, "s").agg(F.count("*").alias("n"))
    return counts.groupBy(*by).agg(
        F.sum("n").alias("messages"),
        ratio(F.sum(C("s") * C("n")), F.sum("n")).alias("avg_latency"),
        F.max("s").alias("max_latency"),
        *[F.round(F.percentile("s", p, C("n")), 4).alias(f"p{round(p * 100)}") for p in points])


def latency_by_type(raw: DataFrame, *, as_of, window: str = "1 hour") -> DataFrame:
    rows = newer_than(raw, "timestamp", window, as_of=as_of)
    return rows.groupBy("message_type").agg(average(latency()).alias("avg_latency"))


def latency_by_bin(raw: DataFrame, seconds: int = 300, *, as_of,
                   window: str = "1 hour") -> DataFrame:
    rows = newer_than(raw, "timestamp", window, as_of=as_of)
    return rows.groupBy(bin_floor(C("timestamp"), seconds).alias("bin")).agg(
        average(latency()).alias("avg_latency"))


def data_size(payload: Column) -> Column:
    """Bytes of the payload's JSON text; the hosted engine's estimate is not defined."""
    return F.octet_length(payload)


def sizes(raw: DataFrame) -> DataFrame:
    size = data_size(C("data"))
    return raw.groupBy("message_type").agg(
        ratio(F.sum(size), F.count(size) * 1024, 4).alias("avg_size_kb"),
        ratio(F.min(size), F.lit(1024), 4).alias("min_size_kb"),
        ratio(F.max(size), F.lit(1024), 4).alias("max_size_kb"),
        ratio(F.sum(size), F.lit(1024 * 1024), 4).alias("total_size_mb"))


def health(raw: DataFrame, hours: int = 1, *, as_of) -> DataFrame:
    """One row for the last hours; it reads NO DATA when nothing came in."""
    rows = newer_than(raw, "timestamp", f"{hours} hours", as_of=as_of)
    stats = rows.agg(F.count("*").alias("messages_received"),
                     average(latency()).alias("avg_latency_sec"),
                     F.count_distinct("message_type").alias("different_types"),
                     F.count_distinct("sap_system").alias("active_systems"),
                     F.max("timestamp").alias("last_message"))
    n, lag = C("messages_received"), C("avg_latency_sec")
    return stats.withColumn("status", F.when(n == 0, "NO DATA").when(lag < 60, "HEALTHY")
                            .when(lag < 300, "DEGRADED").otherwise("WARNING"))


def health_summary(raw: DataFrame, hours_back: int = 1, *, as_of) -> DataFrame:
    rows = newer_than(raw, "timestamp", f"{hours_back} hours", as_of=as_of)
    errors = F.count_if(failed_status())
    stats = rows.agg(F.count("*").alias("message_count"),
                     F.count_distinct("message_type").alias("distinct_types"),
                     average(latency()).alias("avg_latency_sec"),
                     errors.alias("error_count"),
                     pct(errors, F.count("*")).alias("error_rate"))
    state = (F.when(C("message_count") == 0, "CRITICAL - No Data")
             .when(C("error_rate") > 10, "WARNING - High Error Rate")
             .when(C("avg_latency_sec") > 120, "WARNING - High Latency").otherwise("HEALTHY"))
    return stats.withColumn("health_status", state)


def errors(raw: DataFrame) -> DataFrame:
    return raw.filter(failed_status()).select(
        "timestamp", "message_type", C("control.docnum").alias("docnum"),
        C("control.status").alias("status"), "sap_system").orderBy(F.desc("timestamp"), "docnum")


def error_counts(raw: DataFrame) -> DataFrame:
    return raw.filter(failed_status()).groupBy(
        "message_type", C("control.status").alias("status_code")).agg(
        F.count("*").alias("errors")).orderBy(F.desc("errors"), "message_type", "status_code")


def spikes(raw: DataFrame, factor: float = 2, *, as_of) -> DataFrame:
    """Hours of the last day above ``factor`` times the mean hourly count of the last week."""
    week = volume(raw, 3600, "7 days", as_of=as_of)
    mean = week.agg(ratio(F.sum("total"), F.count("total"), 4)).scalar()
    day = volume(raw, 3600, "24 hours", as_of=as_of).withColumn("average", mean)
    return day.filter(C("total") > C("average") * F.lit(str(factor)).cast("decimal(6,3)")).select(
        "bin", "total", "average", ratio(C("total"), C("average")).alias("ratio"))


def gaps(raw: DataFrame, seconds: int = 300, hours: int = 24, *, as_of) -> DataFrame:
    """Empty bins in the last hours."""
    start = as_ts(as_of) - F.expr(f"INTERVAL {hours} HOURS")
    return gap_fill(raw, "timestamp", seconds, start, as_of).filter(C("count") == 0).select("ts")


def late(raw: DataFrame, minutes: int = 5, window: str = "1 hour", *, as_of) -> DataFrame:
    rows = newer_than(raw, "timestamp", window, as_of=as_of).withColumn(
        "latency_minutes", latency("minute"))
    return rows.filter(C("latency_minutes") > minutes).select(
        "timestamp", "message_type", "latency_minutes", C("control.docnum").alias("docnum"))


def late_orders(raw: DataFrame, minutes: int = 30) -> DataFrame:
    """Orders of business hours that arrived later than ``minutes``."""
    rows = raw.filter(C("message_type").startswith("ORDERS") & business_hours(C("timestamp")))
    return rows.withColumn("latency_minutes", latency("minute")).filter(
        C("latency_minutes") > minutes).select(
        "timestamp", C("control.docnum").alias("order_number"), "latency_minutes",
        F.hour("timestamp").alias("hour"))


def daily_report(raw: DataFrame, *, as_of) -> DataFrame:
    rows = newer_than(raw, "timestamp", "24 hours", as_of=as_of)
    stats = rows.agg(F.count("*").alias("total_messages"),
                     F.count_distinct("message_type").alias("distinct_types"),
                     F.count_distinct("sap_system").alias("sap_systems"),
                     F.min("timestamp").alias("first_message"),
                     F.max("timestamp").alias("last_message"))
    hours = diff_boundary("hour", C("last_message"), C("first_message"))
    return stats.withColumns({"duration_hours": hours,
                              "rate_per_hour": ratio(C("total_messages"), hours)})


def executive_metrics(raw: DataFrame, *, as_of) -> DataFrame:
    rows = newer_than(raw, "timestamp", "1 hour", as_of=as_of)
    return rows.agg(F.count("*").alias("messages_last_hour"),
                    ratio(F.count("*"), F.lit(60)).alias("messages_per_minute"),
                    F.count_distinct("idoc_type").alias("idoc_types"),
                    F.count_distinct("sap_system").alias("source_systems"))


def average_per_hour(raw: DataFrame, *, as_of) -> DataFrame:
    return volume(raw, 3600, "7 days", as_of=as_of).agg(
        ratio(F.sum("total"), F.count("total")).alias("average_messages_per_hour"))


def daily_outliers(raw: DataFrame, limit: int = 50, *, as_of) -> DataFrame:
    """Days of the last week that deviate by more than ``limit`` percent from the daily mean."""
    rows = newer_than(raw, "timestamp", "7 days", as_of=as_of)
    days = count_by(rows, F.to_date("timestamp").alias("day"), name="daily_count")
    whole = days.agg(F.sum("daily_count")).scalar()
    out = days.withColumns({
        "average": ratio(whole, F.lit(7), 4),
        "deviation_percent": pct_change(C("daily_count") * 7, whole)})
    return out.filter(F.abs("deviation_percent") > limit).orderBy(
        F.desc(F.abs("deviation_percent")), "day")


def business_hours_share(raw: DataFrame) -> DataFrame:
    inside = F.count_if(business_hours(C("timestamp")))
    return raw.agg(inside.alias("messages_business_hours"), F.count("*").alias("total_messages"),
                   pct(inside, F.count("*")).alias("percent_business_hours"))


def busiest_slices(raw: DataFrame, n: int = 20, *, as_of) -> DataFrame:
    """Type, system and hour of day with the most messages of the week and their share."""
    rows = newer_than(raw, "timestamp", "7 days", as_of=as_of)
    counts = count_by(rows, "message_type", "sap_system", F.hour("timestamp").alias("hour"))
    whole = counts.agg(F.sum("total")).scalar()
    return top_by(counts.withColumn("percent_of_total", pct(C("total"), whole)), n,
                  F.desc("total"), "message_type", "sap_system", "hour")


def quality_line(raw: DataFrame, *, as_of) -> DataFrame:
    rows = newer_than(raw, "timestamp", "24 hours", as_of=as_of)
    out = rows.agg(F.count("*").alias("total_messages"),
                   F.count_if(C("control").isNull()).alias("missing_control"),
                   F.count_if(failed_status()).alias("error_status"),
                   F.count_if(latency("minute") > 5).alias("high_latency"))
    issues = C("missing_control") + C("error_status") + C("high_latency")
    return out.withColumns({
        "total_issues": issues,
        "quality_score": pct(C("total_messages") - issues, C("total_messages"))})


def alerts(raw: DataFrame, *, as_of, spike_factor: int = 3, silence_minutes: int = 10,
           error_percent: int = 5, latency_seconds: int = 120) -> DataFrame:
    """Volume, silence, error-rate and latency checks of the last hour, one row each.

    One pass gives the numbers of the hour; the weekly mean and the newest message of all are
    scalar subqueries. Silence counts from that message, however old it is; a system without any
    message is silent. Latencies are counted per value before the percentile.
    """
    newest = raw.filter(C("timestamp") <= as_ts(as_of)).agg(F.max("timestamp")).scalar()
    mean = volume(raw, 3600, "7 days", as_of=as_of).agg(
        ratio(F.sum("total"), F.count("total"), 4)).scalar()
    hour = newer_than(raw, "timestamp", "1 hour", as_of=as_of)
    counts = hour.groupBy(latency().alias("s")).agg(
        F.count("*").alias("n"), F.count_if(failed_status()).alias("bad"))
    checks = _thresholds(spike_factor, error_percent, latency_seconds)
    checks.insert(1, _check("Silence", C("silent"), F.lit(silence_minutes), "Prolonged Silence",
                            unknown=True))
    one = _measured(counts, mean, spike_factor).withColumn(
        "silent", diff_boundary("minute", as_ts(as_of), newest))
    return one.select(F.inline(F.array(*checks)))


def thresholds(counts: DataFrame, mean: Column, *, spike_factor: int = 3, error_percent: int = 5,
               latency_seconds: int = 120) -> DataFrame:
    """Volume, error-rate and latency checks from the hour's latencies (s, n, bad) and the mean
    hourly volume, one row each."""
    return _measured(counts, mean, spike_factor).select(
        F.inline(F.array(*_thresholds(spike_factor, error_percent, latency_seconds))))


def _measured(counts: DataFrame, mean: Column, spike_factor: int) -> DataFrame:
    one = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                     pct(F.sum("bad"), F.sum("n")).cast("double").alias("rate"),
                     F.percentile("s", 0.95, C("n")).alias("p95"))
    return one.withColumn("spike", (mean * spike_factor).cast("double"))


def _check(kind: str, value: Column, limit: Column, text: str, unknown: bool = False) -> Column:
    hit = F.coalesce(value > limit, F.lit(unknown))
    return F.struct(F.lit(kind).alias("type"), F.when(hit, text).otherwise("Normal").alias("alert"),
                    F.round(value.cast("double"), 4).alias("value"),
                    F.round(limit.cast("double"), 4).alias("threshold"))


def _thresholds(spike_factor: int, error_percent: int, latency_seconds: int) -> list[Column]:
    return [_check("Volume", C("n"), C("spike"), "Volume Spike"),
            _check("Error Rate", C("rate"), F.lit(error_percent), "High Error Rate"),
            _check("P95 Latency", C("p95"), F.lit(latency_seconds), "High Latency")]


def order_to_ship(raw: DataFrame) -> DataFrame:
    """Hours from the mean order time to the mean shipment time, per system, in one pass."""
    epoch = F.unix_seconds("timestamp")
    order, ship = C("message_type").startswith("ORDERS"), C("message_type").startswith("SHPMNT")

    def mean_hour(cond: Column) -> Column:
        total = F.sum(F.when(cond, epoch)).cast("decimal(30,0)")
        return F.floor(F.try_divide(total, F.count_if(cond) * 3600))

    return raw.filter(order | ship).groupBy("sap_system").agg(
        F.count_if(order).alias("_o"), F.count_if(ship).alias("_s"),
        mean_hour(ship).alias("_ship"), mean_hour(order).alias("_order"),
    ).filter((C("_o") > 0) & (C("_s") > 0)).select(
        "sap_system", (C("_ship") - C("_order")).cast("bigint").alias("avg_order_to_ship_hours"))


def cardinality(raw: DataFrame, *columns: str) -> DataFrame:
    return raw.agg(*[F.count_distinct(C(c)).alias(f"unique_{c}") for c in columns])


def null_counts(raw: DataFrame, *columns: str) -> DataFrame:
    return raw.agg(F.count("*").alias("total_rows"),
                   *[F.count_if(C(c).isNull()).alias(f"{c}_nulls") for c in columns])


def freshness(raw: DataFrame, *, as_of) -> DataFrame:
    return raw.agg(F.max("timestamp").alias("last_message")).withColumn(
        "minutes_since", diff_boundary("minute", as_ts(as_of), C("last_message")))


def bi_daily(raw: DataFrame, *, as_of) -> DataFrame:
    rows = newer_than(raw, "timestamp", "30 days", as_of=as_of)
    size = data_size(C("data"))
    return rows.groupBy(F.to_date("timestamp").alias("day"), "message_type", "sap_system").agg(
        F.count("*").alias("total"), average(size).alias("avg_size"))


def partner_coverage(summary: DataFrame) -> DataFrame:
    """Share of messages that carry partner fields, over a message summary."""
    filled = lambda c: (C(c).isNotNull()) & (C(c) != "")
    n = F.count("*")
    kinds = C("message_type")
    return summary.agg(
        n.alias("total_messages"),
        pct(F.count_if(filled("carrier_id")), n).alias("carrier_coverage"),
        pct(F.count_if(filled("customer_id") & kinds.isin("ORDERS", "INVOIC")), n)
        .alias("customer_coverage"),
        pct(F.count_if(filled("warehouse_partner_id") & (kinds == "WHSCON")), n)
        .alias("warehouse_coverage"))


def recent(raw: DataFrame, hours: int = 24, *, as_of) -> DataFrame:
    return newer_than(raw, "timestamp", f"{hours} hours", as_of=as_of)


def of_type(raw: DataFrame, idoc_type: str) -> DataFrame:
    return raw.filter(C("idoc_type") == idoc_type)


def failed(raw: DataFrame, states: Sequence[str] = ("ERROR", "FAILED")) -> DataFrame:
    return raw.filter(C("status").isin(*states))


def stream_columns(raw: DataFrame) -> DataFrame:
    """Columns added while routing: document type, number, creation date, status."""
    return raw.withColumns({
        "doc_type": lookup(DOC_TYPES, C("idoc_type"), F.lit("Unknown")),
        "document_number": C("control.docnum"), "created_date": C("control.credat"),
        "document_status": C("control.status")})


def routable(raw: DataFrame, statuses: Sequence[str] = VALID_STATUS,
             test_system: str = "TESTENV") -> DataFrame:
    return raw.filter(C("control.status").isin(*statuses) & (C("sap_system") != test_system))


def export_rows(raw: DataFrame, window: str = "7 days", n: int | None = None, *,
                as_of) -> DataFrame:
    """Flat rows for a spreadsheet, newest first; all of them unless ``n`` is given."""
    rows = newer_than(raw, "timestamp", window, as_of=as_of).select(
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("date"),
        C("message_type").alias("type"), C("sap_system").alias("system"),
        C("control.docnum").alias("document"), C("control.status").alias("status"))
    order = (F.desc("date"), "document")
    return rows.orderBy(*order) if n is None else top_by(rows, n, *order)


# ---------------------------------------------------------------- extracts from the payload

def order_extract(raw: DataFrame) -> DataFrame:
    """Order messages with number, date, customer and value, read from control and payload."""
    rows = parsed(raw.filter(C("message_type").startswith("ORDERS")),
                  E1EDK01="customer_id", E1EDP01="segnam matnr")
    item = F.get(only("E1EDP01", "E1EDP01"), F.lit(0))
    return rows.select("timestamp", C("_c.docnum").alias("order_number"),
                       moment(C("_c.credat")).cast("date").alias("order_date"),
                       field(head("E1EDK01"), "customer_id").alias("customer_id"),
                       field(item, "matnr").alias("first_material"), "sap_system")


def warehouse_operations(raw: DataFrame) -> DataFrame:
    """Confirmations per warehouse and operation, with the quantity of their items."""
    rows = parsed(raw.filter(C("message_type").startswith("WHSCON")),
                  E1WHC00="lgnum whstype", E1WHC10="segnam confqty")
    items = F.transform(only("E1WHC10", "E1WHC10"), lambda i: number(
        i.getField("confqty"), "decimal(15,3)"))
    quantity = F.aggregate(items, F.lit(0).cast("decimal(25,3)"), lambda a, x: (
        a + F.coalesce(x, F.lit(0))).cast("decimal(25,3)"))
    return rows.select(field(head("E1WHC00"), "lgnum").alias("warehouse_id"),
                       field(head("E1WHC00"), "whstype").alias("operation"),
                       quantity.alias("q")).groupBy("warehouse_id", "operation").agg(
        F.count("*").alias("operations"), F.sum("q").alias("quantity"))


def top_payload_invoices(raw: DataFrame, n: int = 10) -> DataFrame:
    """The largest invoices by the amount in their payload."""
    rows = parsed(raw.filter(C("message_type").startswith("INVOIC")),
                  E1EDK01="belnr customer_id total_amount")
    bills = rows.select(field(head("E1EDK01"), "belnr").alias("invoice_number"),
                        field(head("E1EDK01"), "customer_id").alias("customer_id"),
                        number(field(head("E1EDK01"), "total_amount")).alias("amount"))
    return top_by(bills, n, F.desc("amount"), "invoice_number")
