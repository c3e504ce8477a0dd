import datetime as dt

from pyspark.sql import functions as F

from waybill.plans import gold, messages, star

NOW = "2024-01-10 00:00:00"


def frame(spark, rows, names, times):
    df = spark.createDataFrame(rows, names)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in times})


def test_several_shipments_do_not_repeat_an_order(spark):
    orders = frame(spark, [("1", "C", "P", "2024-01-01 10:00:00", "2024-01-08 00:00:00",
                            "2024-01-06 00:00:00", "2024-01-03 00:00:00", None, "Shipped",
                            "Breached", 20000.0)],
                   "order_number string, customer_id string, sap_system string, order_date string, "
                   "requested_delivery_date string, promised_delivery_date string, "
                   "actual_ship_date string, actual_delivery_date string, order_status string, "
                   "sla_status string, total_amount double",
                   ["order_date", "requested_delivery_date", "promised_delivery_date",
                    "actual_ship_date", "actual_delivery_date"])
    names = "order_number string, carrier_name string, shipment_status string, " \
            "actual_ship_date string, actual_delivery_date string"
    times = ["actual_ship_date", "actual_delivery_date"]

    def run(second):
        ships = frame(spark, [("1", "A", "x", "2024-01-02 00:00:00", "2024-01-05 00:00:00"),
                              ("1", "B", "x", "2024-01-03 00:00:00", second)], names, times)
        return gold.sla_per_order(orders, ships, as_of=NOW).collect()

    rows = run("2024-01-07 00:00:00")
    assert len(rows) == 1 and rows[0].on_time_delivery is False and rows[0].is_critical
    assert (rows[0].processing_days, rows[0].sla_compliance) == (2, "At Risk")
    assert rows[0].sla_variance_hours == 24 and rows[0].total_cycle_days == 6
    # part of the order is still on its way: not known yet
    assert run(None)[0].on_time_delivery is None


def test_zero_totals(spark):
    df = frame(spark, [("1", "C1", "2024-01-01 00:00:00", "P", 0.0)],
               "invoice_number string, customer_id string, invoice_date string, sap_system string, "
               "total_amount double", ["invoice_date"]).withColumns({
        "amount_paid": F.lit(0.0), "amount_due": F.lit(0.0), "payment_status": F.lit("Paid"),
        "aging_bucket": F.lit("Current"), "payment_date": F.lit(None).cast("timestamp")})
    row = gold.revenue_recognition(df).first()
    assert row.collection_efficiency_pct == 0 and row.avg_days_to_payment is None
    assert row.collection_risk == "Low"


def test_dimension_history(spark):
    def load(day, rows, old=None):
        src = spark.createDataFrame(rows, "customer_id string, name string")
        return star.load_dimension(src, "customer_id", ["name"], "customer_key",
                                   as_of=f"{day} 00:00:00", existing=old)

    first = load("2024-01-01", [("a", "Ann"), ("b", "Bob")])
    second = load("2024-02-01", [("a", "Anna"), ("b", "Bob"), ("c", "Cy")], first)
    rows = {(r.customer_id, r.name): r for r in second.collect()}
    assert len(rows) == 4 and len({r.customer_key for r in rows.values()}) == 4
    assert rows["a", "Ann"].valid_to == dt.date(2024, 2, 1) and not rows["a", "Ann"].is_current
    assert rows["a", "Anna"].is_current and rows["b", "Bob"].valid_from == dt.date(2024, 1, 1)
    assert {rows["a", "Anna"].customer_key, rows["c", "Cy"].customer_key} == {3, 4}
    # nothing new: nothing changes; absent members stay
    third = load("2024-03-01", [("a", "Anna")], second)
    assert sorted(map(tuple, third.collect()), key=str) == sorted(map(tuple, second.collect()),
                                                                  key=str)


def test_numbers_are_dense(spark):
    df = star.number_rows(spark.range(1000).select(F.col("id").cast("string").alias("k")), "k",
                          "n", start=10)
    assert sorted(r.n for r in df.collect()) == list(range(11, 1011))


def test_health_without_messages(spark):
    raw = spark.createDataFrame([], "docnum string, message_type string, sap_system string, "
                                    "control struct<status:string>, timestamp timestamp, "
                                    "ingestion_time timestamp")
    assert messages.health(raw, as_of=NOW).first().status == "NO DATA"
    assert messages.health_summary(raw, as_of=NOW).first().health_status == "CRITICAL - No Data"
    rows = {r.type: r.alert for r in messages.alerts(raw, as_of=NOW).collect()}
    assert set(rows) == {"Volume", "Silence", "Error Rate", "P95 Latency"}


def test_revenue_by_service_map(spark):
    rows = [("Storage", 1.0), ("Storage", 2.0), ("Handling", 5.0)]
    df = spark.createDataFrame(rows, "service_type string, total_amount double").withColumns({
        "invoice_date": F.lit(NOW).cast("timestamp"), "sap_system": F.lit("P")})
    assert gold.revenue_by_service(df).first().revenue_by_service == {"Handling": 5.0,
                                                                     "Storage": 3.0}


def test_service_classes_add_up(spark):
    from waybill.functions import SLA_PRESETS, with_open_class

    rows = [("good", "2024-01-01 00:00:00", "2024-01-01 20:00:00"),
            ("risk", "2024-01-01 00:00:00", "2024-01-02 00:00:00"),
            ("late", "2024-01-01 00:00:00", "2024-01-02 01:00:00"),
            ("open", "2024-01-09 12:00:00", None), ("old", "2024-01-01 00:00:00", None)]
    df = spark.createDataFrame(rows, "id string, order_date string, actual_ship_date string")
    for c in ("order_date", "actual_ship_date"):
        df = df.withColumn(c, F.col(c).cast("timestamp"))
    got = {r.id: r.sla_status for r in with_open_class(
        df, "2024-01-10 00:00:00", SLA_PRESETS["inclusive"]).collect()}
    assert got == {"good": "Good", "risk": "At Risk", "late": "Breached", "open": "Good",
                   "old": "Breached"}


def test_carrier_is_that_of_the_last_shipment(spark):
    rows = [("1", "A", "Delivered", "2024-01-01 00:00:00", "2024-01-05 00:00:00"),
            ("1", "B", "Delivered", "2024-01-01 00:00:00", "2024-01-03 00:00:00"),
            ("2", "A", "Delivered", "2024-01-01 00:00:00", "2024-01-05 00:00:00"),
            ("2", "C", "In Transit", "2024-01-01 00:00:00", None)]
    df = spark.createDataFrame(rows, "order_number string, carrier_name string, "
                                     "shipment_status string, actual_ship_date string, "
                                     "actual_delivery_date string")
    got = {r.order_number: (r.carrier_name, r.shipment_status)
           for r in gold.one_shipment_per_order(df).collect()}
    assert got == {"1": ("A", "Delivered"), "2": ("C", "In Transit")}


def test_silence_counts_from_the_newest_message_of_all(spark):
    kind = ("docnum string, message_type string, status string, timestamp timestamp, "
            "ingestion_time timestamp, control struct<docnum:string,status:string>")
    old = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("1", "ORDERS", "03", old, old, ("1", "03"))], kind)
    for rows, value in ((df, 9 * 24 * 60.0), (df.limit(0), None)):
        got = {r.type: r for r in messages.alerts(rows, as_of=NOW).collect()}
        assert (got["Silence"].alert, got["Silence"].value) == ("Prolonged Silence", value)
        assert got["Error Rate"].alert == "Normal"
