import json

import pytest
from pyspark.sql import functions as F

from waybill.operators import query as ask
from waybill.operators import security as sec


@pytest.fixture(scope="module")
def shipments(spark):
    rows = [(f"S{i}", "UPS" if i % 2 else "DHL", str(i % 5), i % 7, float(i)) for i in range(40)]
    return spark.createDataFrame(rows, "shipment_number string, carrier_id string, "
                                       "customer_id string, rank int, value double")


POLICY = sec.Policy({"Carrier": {"shipments": ("carrier_id", "$carrier_id")},
                     "Customer": {"shipments": ("customer_id", "$customer_id")}},
                    {"Carrier": ("a", "both"), "Customer": ("c", "both")})


def test_roles(shipments):
    def n(p):
        return sec.secure(shipments, "shipments", p, POLICY).count()
    carrier = POLICY.principal("a", carrier_id="UPS")
    assert n(carrier) == 20
    assert n(POLICY.principal("c", customer_id="3")) == 8
    assert n(POLICY.principal("both", carrier_id="UPS", customer_id="2")) == 24
    assert n(POLICY.principal("nobody")) == 0 and n(sec.Principal("x", is_admin=True)) == 40
    assert n(POLICY.principal("a")) == 0 and n(POLICY.principal("a", carrier_id="NONE")) == 0
    assert sec.secure(shipments, "invoices", carrier, POLICY).count() == 0
    once = sec.secure(shipments, "shipments", carrier, POLICY)
    assert once.count() == sec.secure(once, "shipments", carrier, POLICY).count()


def test_filter_reaches_the_scan(spark, shipments, tmp_path):
    shipments.write.parquet(str(tmp_path / "t"))
    df = sec.secure(spark.read.parquet(str(tmp_path / "t")), "shipments",
                    POLICY.principal("a", carrier_id="UPS"), POLICY).filter("value > 3")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(carrier_id,UPS)" in plan and "GreaterThan(value,3.0)" in plan


def policy_json(value="UPS", expression=None):
    return json.dumps({
        "roles": [{"name": "R", "tablePermissions": [
            {"tableName": "t", "filterExpression": expression or f"carrier_id = '{value}'"}]}],
        "roleAssignments": [{"role": "R", "members": [{"id": "p1"}]}]})


def test_policy_file(spark):
    policy = sec.load_policy(policy_json(), {"carrier_id": ["UPS"]})
    assert policy.principal("p1").roles == ("R",)
    with pytest.raises(ValueError, match="unknown carrier_id"):
        sec.load_policy(policy_json("PARTNER_X"), {"carrier_id": ["UPS"]})
    with pytest.raises(ValueError, match="only column"):
        sec.load_policy(policy_json(expression="1 or 1 = 1"))
    tables = spark.createDataFrame([("t",), ("open",)], "table_name string")
    audit = sec.audit_tables(tables, sec.policy_table(spark, policy)).collect()
    assert [(r.table_name, r.filters) for r in audit] == [("open", 0), ("t", 1)]
    members = sec.audit_members(sec.member_table(spark, POLICY)).collect()
    assert [(r.principal, r.roles) for r in members] == [("both", "Carrier,Customer")]


def test_writes_outside_the_scope(spark, shipments):
    extra = shipments.unionByName(spark.createDataFrame(
        [("S99", None, "1", 1, 1.0)], shipments.schema))
    ok, bad = sec.split_writes(extra, "shipments", POLICY.principal("a", carrier_id="UPS"), POLICY)
    assert ok.count() == 20 and bad.count() == 21


def test_masks(spark):
    df = spark.createDataFrame([("CUST001", "Ann", 5.0)],
                               "customer_id string, customer_name string, shipment_value double")
    row = sec.mask(df, "carrier").first().asDict()
    assert row == {"customer_id": "Customer-CUS", "customer_name": "CONFIDENTIAL"}


def test_filter_tree_refuses_unknown(shipments):
    with pytest.raises(ValueError, match="unknown column"):
        ask.condition(shipments, {"secret": {"eq": 1}})
    with pytest.raises(ValueError, match="unknown operator"):
        ask.condition(shipments, {"rank": {"like": 1}})
    text = "UPS' OR '1'='1"
    assert shipments.filter(ask.condition(shipments, {"carrier_id": {"eq": text}})).count() == 0
    with pytest.raises(ValueError, match="limit"):
        ask.query(shipments, key="shipment_number", limit=101)


def test_pages_add_up_to_the_whole(shipments):
    for order in ([("rank", "DESC")], [("rank", "ASC")], []):
        seen, after = [], None
        while True:
            page = ask.page(shipments, order, key="shipment_number", first=7, after=after)
            seen += [r.shipment_number for r in page.rows]
            if not page.has_next:
                break
            after = page.end_cursor
        whole = [r.shipment_number for r in shipments.orderBy(
            *ask.ordering(shipments, order, "shipment_number")).collect()]
        assert seen == whole and len(set(seen)) == 40


@pytest.mark.parametrize("direction", ["ASC", "DESC"])
def test_pages_over_nulls_add_up(spark, direction):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 5) for i in range(31)],
                               "id int, v int")
    order, seen, after = [("v", direction)], [], None
    while True:
        page = ask.page(df, order, key="id", first=4, after=after)
        seen += [r.id for r in page.rows]
        if not page.has_next:
            break
        after = page.end_cursor
    assert seen == [r.id for r in df.orderBy(*ask.ordering(df, order, "id")).collect()]
    assert len(seen) == 31 and all(i % 3 == 0 for i in seen[-11:])


def test_year_end_period():
    where = ask.invoices_query("2024-12")
    assert where == {"and": [{"invoice_date": {"ge": "2024-12-01 00:00:00"}},
                             {"invoice_date": {"lt": "2025-01-01 00:00:00"}}]}


def test_region_members(spark):
    df = spark.createDataFrame([("A",), ("B",)], "region string")
    one = sec.Principal("u", attributes={"region": "A"})
    assert df.filter(sec.region_filter(one, "region")).count() == 1
    assert df.filter(sec.region_filter(sec.Principal("s", ("DataSteward",)), "region")).count() == 2
    assert df.filter(F.coalesce(sec.region_filter(sec.Principal("n"), "region"),
                                F.lit(False))).count() == 0
