import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from waybill.operators import quality as q

NOW = "2024-01-10 00:00:00"


def by_id(df):
    return {r.rule_id: r for r in df.collect()}


@pytest.fixture(scope="module")
def raw(spark):
    rows = [("1", "ORDERS", "{}", "{}", 0), ("1", "SHPMNT", "{}", None, 10),
            ("2", "WEIRD", None, "{}", 31), ("3", None, "{}", "{}", 5)]
    return spark.createDataFrame(rows, "docnum string, message_type string, control string, "
                                       "data string, lag int").withColumn(
        "timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp")).withColumn(
        "ingestion_time", F.col("timestamp") + F.make_dt_interval(secs=F.col("lag")))


def test_message_rules(spark, raw):
    got = by_id(q.run_rules({"raw": raw}, q.MESSAGE_RULES, as_of=NOW))
    assert [got[f"BRZ-00{i}"].failed_count for i in (1, 2, 3, 4)] == [2, 2, 1, 1]
    assert {r.status for r in got.values()} == {"Fail"}
    assert got["BRZ-004"].failed_pct == Decimal("25.00")
    assert got["BRZ-001"].message == "2 messages missing structure"


def test_no_rows_pass(spark, raw):
    got = by_id(q.run_rules({"raw": raw.filter("false")}, q.MESSAGE_RULES, as_of=NOW))
    assert {r.status for r in got.values()} == {"Pass"}
    assert {r.failed_count for r in got.values()} == {0}


def test_total_within_a_cent(spark):
    rows = [("1", "100.01"), ("2", "100.02"), ("3", "100.00"), ("4", "99.98")]
    df = spark.createDataFrame(rows, "invoice_number string, t string").select(
        "invoice_number", F.col("t").cast("decimal(18,2)").alias("total_amount"),
        F.lit("95.00").cast("decimal(18,2)").alias("subtotal_amount"),
        F.lit("8.00").cast("decimal(18,2)").alias("tax_amount"),
        F.lit("3.00").cast("decimal(18,2)").alias("discount_amount"),
        F.lit(None).cast("decimal(18,2)").alias("shipping_charges"))
    got = by_id(q.run_rules({"invoices": df}, [q.INVOICE_RULES[1]], as_of=NOW))
    assert got["SLV-INV-002"].failed_count == 2


def test_share_limit_is_exact(spark):
    rule = q.Rule("X", "x", "Validity", "High", "Silver", "t", "bad",
                  failing=lambda now: F.col("id") < 5, max_pct=5)
    def status(n):
        return q.run_rules({"t": spark.range(n)}, [rule], as_of=NOW).first().status
    assert status(100) == "Pass" and status(99) == "Fail"


def test_orphans_and_null_keys(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "order_number string")
    parent = spark.createDataFrame([("a",)], "order_number string")
    rule = q.Rule("FK", "fk", "Consistency", "High", "Silver", "child", "orphans",
                  parent=("parent", {"order_number": "order_number"}))
    row = q.run_rules({"child": child, "parent": parent}, [rule], as_of=NOW).first()
    assert (row.total_count, row.failed_count) == (4, 2)


def test_location_and_gold_freshness(spark):
    moves = spark.createDataFrame([("Z", "A", "S", "B"), ("Z", "", "S", "B")],
                                  "zone string, aisle string, shelf string, bin_location string")
    status = spark.createDataFrame([(dt.datetime(2024, 1, 9, 23, 56),),
                                    (dt.datetime(2024, 1, 9, 23, 54),)],
                                   "processed_timestamp timestamp")
    got = by_id(q.run_rules({"warehouse": moves, "gold_status": status},
                            [q.LOCATION_RULE, q.GOLD_FRESH_RULE], as_of=NOW))
    assert got["SLV-WHS-003"].failed_count == 1 and got["GLD-001"].failed_count == 1


def test_roll_ups(spark, raw):
    results = q.run_rules({"raw": raw}, q.MESSAGE_RULES[1:], as_of=NOW)
    row = q.score(results).first()
    assert (row.total_rules, row.failed, row.critical_failures) == (3, 3, 2)
    assert row.health_status == "Critical" and row.quality_score == 0
    bag = q.dimension_bag(results).first().by_dimension
    assert bag == {"Validity": "Fail", "Uniqueness": "Fail", "Timeliness": "Fail"}
    assert q.critical_alerts(results, threshold=1).count() == 1


def test_trend_from_history(spark, raw):
    rules = [q.MESSAGE_RULES[1]]
    bad = q.run_rules({"raw": raw}, rules, as_of=NOW)
    ok = q.run_rules({"raw": raw.filter("message_type = 'ORDERS'")}, rules, as_of=NOW)
    history = bad.withColumn("checked_at", F.lit("2024-01-01 01:00:00").cast("timestamp")) \
        .unionByName(ok.withColumn("checked_at", F.lit("2024-01-01 09:00:00").cast("timestamp")))
    row = q.trend(history, "2024-01-01 00:00:00", "2024-01-02 00:00:00").first()
    assert (row.runs, float(row.quality_score), float(row.min_score)) == (2, 50.0, 0.0)


def test_contract(spark):
    df = spark.createDataFrame([("S1", "UPS", dt.datetime(2024, 1, 9), 5.0),
                                ("S1", "XXX", dt.datetime(2024, 2, 1), -1.0)],
                               "shipment_id string, carrier_id string, ship_date timestamp, kg double")
    fields = [q.Field("shipment_id", "string", required=True, unique=True),
              q.Field("carrier_id", "string", required=True, values=("UPS", "DHL")),
              q.Field("ship_date", "timestamp", required=True, future_allowed=False),
              q.Field("kg", "decimal(10,2)"), q.Field("gone", "string", required=True)]
    got = {(r.part, r.subject): r.status for r in q.check_contract(
        df, fields, {"kg positive": F.col("kg") > 0}, as_of=NOW, fresh=("ship_date", 5)).collect()}
    assert got == {
        ("schema", "shipment_id"): "Pass", ("schema", "carrier_id"): "Pass",
        ("schema", "ship_date"): "Pass", ("schema", "kg"): "Fail", ("schema", "gone"): "Fail",
        ("completeness", "shipment_id"): "Pass", ("completeness", "carrier_id"): "Pass",
        ("completeness", "ship_date"): "Pass", ("uniqueness", "shipment_id"): "Fail",
        ("values", "carrier_id"): "Fail", ("future", "ship_date"): "Fail",
        ("accuracy", "kg positive"): "Fail", ("freshness", "ship_date"): "Pass"}


def test_checker(spark):
    df = spark.createDataFrame([("1", "USD"), ("1", "XXX"), (None, "EUR")], "k string, c string")
    rows = {(r.check_name, r.field): (float(r.value_pct), r.status) for r in q.check_table(
        df, [q.Check("completeness", "k"), q.Check("uniqueness", "k"),
             q.Check("validity", "c", allowed=("USD", "EUR"))], as_of=NOW).collect()}
    assert rows == {("Completeness", "k"): (66.67, "FAIL"), ("Uniqueness", "k"): (33.33, "FAIL"),
                    ("Validity", "c"): (66.67, "FAIL")}


def test_contract_of_plain_fields_and_wrong_types(spark):
    df = spark.createDataFrame([("a", "x")], "id string, n string")
    plain = q.check_contract(df, [q.Field("id", "string")], as_of="2024-01-01 00:00:00").collect()
    assert [(r.part, r.status) for r in plain] == [("schema", "Pass")]
    wrong = q.check_contract(df, [q.Field("n", "timestamp", required=True, future_allowed=False),
                                  q.Field("id", "string", required=True)],
                             as_of="2024-01-01 00:00:00").collect()
    assert [(r.part, r.subject, r.status) for r in wrong] == [
        ("schema", "n", "Fail"), ("schema", "id", "Pass"), ("completeness", "id", "Pass")]


def test_the_score_stores_only_what_its_rules_read(spark):
    from waybill.catalog import base, quality
    t = base.tables_of(spark, "/root/testdata/sf0.001")
    held = quality.scored_tables(t)
    assert quality.scored(t).count() == len(q.SCORED_RULES)
    for name, columns in quality.SCORED_COLUMNS.items():
        assert spark.read.parquet(f"{held.path}/{name}").columns == list(columns)
    plan = base.QUERIES["dqa_7_quality_kpis"](t)._jdf.queryExecution().optimizedPlan().toString()
    # no table is derived again to count its rows
    assert "l_orderkey" not in plan
