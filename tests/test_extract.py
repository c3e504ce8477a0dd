import datetime as dt
from decimal import Decimal

from conftest import AS_OF, ORDER, control, message
from pyspark.sql import functions as F
from waybill.functions.payload import parsed
from waybill.operators import extract as x
from waybill.plans import messages as m
from waybill.sources import driver_messages


def first(df):
    return df.collect()[0].asDict()


def test_golden_order(raw):
    row = first(x.extract_orders(raw(message("ORDERS", "ORDERS05", ORDER)), as_of=AS_OF))
    assert row["order_number"] == "B-770145"
    assert row["customer_id"] == "K4410"
    assert row["order_date"] == dt.datetime(2022, 11, 3, 10)
    assert row["requested_delivery_date"] == dt.datetime(2022, 11, 10)
    assert row["promised_delivery_date"] == dt.datetime(2022, 11, 4, 10)
    assert row["total_amount"] == Decimal("318.40") == row["subtotal_amount"]
    assert (row["ship_to_city"], row["ship_to_country"]) == ("Porto", "PT")
    assert (row["total_lines"], row["total_quantity"]) == (1, Decimal("16.000"))
    assert row["partner_access_scope"] == "CUSTOMER"
    assert row["sla_status"] == "Breached"


def test_order_items_leave_out_children(raw):
    rows = x.extract_order_items(raw(message("ORDERS", "ORDERS05", ORDER))).collect()
    assert [(r.item_number, r.material_id, r.net_amount) for r in rows] == [
        ("30", "PART-9", Decimal("318.40"))]


def test_bad_values_become_null(raw):
    broken = {"E1EDK01": [{"belnr": "O1"}], "E1EDK03": [{"iddat": "012", "datum": "2024131X"}],
              "E1EDS01": [{"sumid": "001", "summe": "abc"}]}
    row = first(x.extract_orders(raw(message("ORDERS", "ORDERS05", broken)), as_of=AS_OF))
    assert row["order_date"] is None and row["total_amount"] is None and row["sla_status"] is None
    assert row["total_lines"] == 0 and row["total_quantity"] == 0


def test_null_empty_and_unknown_messages(raw):
    df = raw(message("ORDERS", "ORDERS05", None, ctl=""), message("ORDERS", "ORDERS05", "{oops"),
             message("NEWTYPE", "X", {}))
    assert x.extract_orders(df, as_of=AS_OF).count() == 2
    scopes = {r.message_type: r.partner_access_scope for r in x.partner_summary(df).collect()}
    assert scopes == {"ORDERS": "CUSTOMER", "NEWTYPE": ""}


def test_segment_as_object_or_array(raw):
    header = {"belnr": "D1", "carrier_id": "", "customer_id": "C9", "partner_access_scope": ""}
    both = raw(message("DESADV", "DESADV01", {"E1EDK01": header}),
               message("DESADV", "DESADV01", {"E1EDK01": [header]}))
    rows = x.partner_summary(both).collect()
    assert [(r.customer_id, r.carrier_id, r.partner_access_scope) for r in rows] == [
        ("C9", "", "CARRIER_CUSTOMER")] * 2


SHIPMENT = {"E1SHP00": [{"tknum": "S1", "vsart": "EXP", "tdlnr": "CARRIER-UPS", "signi": "TRK1",
                         "shpsts": "B", "datbg": "20221101", "uatbg": "080000",
                         "daten": "20221103", "uaten": "090000", "carrier_name": "UPS",
                         "customer_id": "C1"}],
            "E1SHP01": [{"vbeln": "DLV1"}],
            "E1SHP10": [{"tsrfo": "1", "tstyp": "STATUS_UPDATE", "tsdat": "20221101",
                         "tsuhr": "080000", "tsrst": "A", "tsloc": "X"},
                        {"tsrfo": "2", "tstyp": "STATUS_UPDATE", "tsdat": "20221103",
                         "tsuhr": "090000", "tsrst": "B", "tsloc": "Y"}]}


def test_shipment_header(raw):
    row = first(x.extract_shipments(raw(message("SHPMNT", "SHPMNT05", SHIPMENT))))
    assert (row["carrier_id"], row["tracking_number"], row["delivery_number"]) == (
        "CARRIER-UPS", "TRK1", "DLV1")
    assert row["shipment_status"] == "Delivered" and row["is_in_transit"] is False
    assert row["transit_time_hours"] == 49 and row["is_on_time"] is True


def test_on_time_unknown_until_delivered(raw):
    data = {"planned_ship_date": "2022-11-01T08:00:00", "actual_ship_date": "2022-11-01T09:10:00",
            "planned_delivery_date": "2022-11-03T08:00:00"}
    row = first(x.extract_shipments_flat(raw(message("SHPMNT", "SHPMNT05", data))))
    assert row["is_on_time"] is None and row["is_in_transit"] is True
    assert row["ship_delay_hours"] == 1


def test_delivered_on_the_promised_instant(raw):
    data = {"planned_delivery_date": "2022-11-03T08:00:00",
            "actual_delivery_date": "2022-11-03T08:00:00"}
    row = first(x.extract_shipments_flat(raw(message("SHPMNT", "SHPMNT05", data))))
    assert row["is_on_time"] is True and row["delivery_delay_hours"] == 0


def test_tracking_events(raw):
    rows = x.extract_tracking_events(raw(message("SHPMNT", "SHPMNT05", SHIPMENT))).collect()
    assert [(r.sequence, r.status_code, r.event_time) for r in rows] == [
        (1, "A", dt.datetime(2022, 11, 1, 8)), (2, "B", dt.datetime(2022, 11, 3, 9))]


RECEIPT = {"E1WHC00": [{"confno": "C1", "lgnum": "WH003", "whstype": "GR", "status": "COMPLETE",
                        "confdat": "20221103", "conftim": "101500", "usnam": "OP1",
                        "warehouse_partner_id": "PARTNER-WH003"}],
           "E1WHC01": [{"duration": "3600"}],
           "E1WHC10": [{"segnam": "E1WHC10", "itemno": "10", "matnr": "M1", "confqty": "100.000",
                        "targetqty": "98.000", "variance": "2.000", "unit": "EA"},
                       {"segnam": "E1WHC11", "itemno": "10", "sernr": "S1"},
                       {"segnam": "E1WHC11", "itemno": "10", "sernr": "S2"},
                       {"segnam": "E1WHC13", "itemno": "10", "lgpla": "BIN-1", "nlpla": "BIN-9"},
                       {"segnam": "E1WHC10", "itemno": "20", "matnr": "M2", "confqty": "5.000"}],
           "E1WHC20": [{"restype": "LABOR", "resid": "OP1", "efficiency": "95.5"}],
           "E1WHC30": [{"result": "PASS"}],
           "E1WHC40": [{"itemno": "10", "excptype": "QUANTITY_VARIANCE", "reason": "COUNT"}]}
ONLY_CHILDREN = {"E1WHC00": [{"confno": "C2"}],
                 "E1WHC10": [{"segnam": "E1WHC11", "itemno": "10", "sernr": "S9"}]}


def test_warehouse_items(raw):
    df = raw(message("WHSCON", "WHSCON01", RECEIPT),
             message("WHSCON", "WHSCON01", ONLY_CHILDREN, docnum="2"),
             message("WHSCON", "WHSCON01", {"E1WHC00": [{"confno": "C3"}], "E1WHC10": []}, "3"))
    rows = {r.item_number: r for r in x.extract_warehouse_items(df).collect()}
    assert set(rows) == {"10", "20"}
    ten = rows["10"]
    assert ten.quantity == 100 and ten.quantity_variance == 2
    assert ten.serial_numbers == "S1,S2" and ten.source_bin == "BIN-1"
    assert ten.has_exception and ten.exception_type == "QUANTITY_VARIANCE"
    assert ten.processing_time_minutes == 60 and ten.is_partner_operated
    assert ten.quality_check_result == "PASS" and not rows["20"].has_exception
    assert x.extract_warehouse_items(df, keep_empty=True).count() == 4
    assert x.movements_without_items(df).count() == 2


def test_warehouse_flags(raw):
    df = raw(message("WHSCON", "WHSCON01", {"completed_time": "2022-11-03T10:45:30",
                                            "inspection_flag": "X", "exception_flag": ""}),
             message("WHSCON", "WHSCON01", {}, ctl=control(status="51")))
    a, b = x.extract_warehouse_flat(df).collect()
    assert a.processing_time_minutes == 45 and a.inspection_required and not a.exception_flag
    assert b.exception_flag and not b.inspection_required


INVOICE = {"E1EDK01": [{"belnr": "I1", "curcy": "EUR", "customer_id": "C1"}],
           "E1EDK03": [{"iddat": "012", "datum": "20221015"}, {"iddat": "013", "datum": "20221114"}],
           "E1EDK14": [{"qualf": "001", "orgid": "DLV1"}],
           "E1EDS01": [{"sumid": "002", "summe": "500.00"}, {"sumid": "011", "summe": "40.00"},
                       {"sumid": "001", "summe": "540.00"}]}


def test_invoice_sums_by_kind_and_aging(raw):
    df = raw(message("INVOIC", "INVOIC02", INVOICE))
    row = first(x.extract_invoices(df, as_of=AS_OF))
    assert (row["subtotal_amount"], row["tax_amount"], row["total_amount"]) == (
        Decimal("500.00"), Decimal("40.00"), Decimal("540.00"))
    assert row["delivery_number"] == "DLV1" and row["amount_due"] == Decimal("540.00")
    assert row["days_overdue"] == 31 and row["aging_bucket"] == "31-60" and row["is_immutable"]
    assert row["payment_status"] == "Overdue"


def test_invoice_flat_totals(raw):
    data = {"invoice_number": "I2", "subtotal_amount": "100.00", "tax_amount": "8.00",
            "discount_amount": "5.00", "amount_paid": "103.00", "payment_status": "Paid",
            "due_date": "2022-11-01", "payment_date": "2022-11-01", "dispute_flag": "X"}
    row = first(x.extract_invoices_flat(raw(message("INVOIC", "INVOIC02", data)), as_of=AS_OF))
    assert row["total_amount"] == Decimal("103.00") and row["amount_due"] == 0
    assert row["aging_bucket"] == "Current" and not row["is_overdue"] and row["is_disputed"]
    assert row["payment_efficiency"] == 100


def test_delivery_numbers_and_units(raw):
    data = {"E1EDK01": [{"belnr": "D1", "bldat": "20221103", "ntgew": 25.5, "brgew": 28.05,
                         "volum": 1.25}],
            "E1EDK14": [{"qualf": "008", "orgid": "WH001"}],
            "E1EDL20": [{"segnam": "E1EDL20", "lfimg": "2.000", "vgbel": "O1"},
                        {"segnam": "E1EDL20", "lfimg": "3.500"}],
            "E1EDL37": [{"vhilm": "PALLET"}, {"vhilm": "carton"}, {"vhilm": "CARTON"}]}
    row = first(x.extract_deliveries(raw(message("DESADV", "DESADV01", data))))
    assert row["total_weight_kg"] == Decimal("25.50") and row["total_volume_m3"] == Decimal("1.25")
    assert (row["total_pallets"], row["total_cartons"], row["item_count"]) == (1, 2, 2)
    assert row["total_quantity"] == Decimal("5.500") and row["warehouse_id"] == "WH001"


def test_lab_orders_keep_latest(spark):
    line = '[{"CUSTOMER_ID":"7","ORDER_DATE":"20221201","DELIVERY_DATE":"%s","SHIP_DATE":%s,' \
           '"TOTAL_AMOUNT":"10.5","STATUS":"OPEN"}]'
    rows = [("a", "P", "2022-12-01 00:00:00", '{"DOCNUM":"1"}', line % ("20221216", "null")),
            ("b", "P", "2022-12-02 00:00:00", '{"DOCNUM":"1"}', line % ("20221218", '"20221203"')),
            ("c", "P", "2022-12-02 00:00:00", '{"DOCNUM":"2"}', line % ("20221215", "null"))]
    df = spark.createDataFrame(rows, "message_id string, sap_system string, timestamp string, "
                                     "control string, data string")
    got = {r.order_number: r for r in x.extract_orders_lab(df, as_of=AS_OF).collect()}
    assert got["1"].message_id == "b" and got["1"].order_status == "Shipped"
    assert got["1"].sla_status == "Good" and got["1"].days_to_ship == 2
    assert got["2"].sla_status == "Breached" and got["2"].order_status == "Pending"


def test_partner_coverage(raw):
    df = raw(message("SHPMNT", "SHPMNT05", SHIPMENT), message("ORDERS", "ORDERS05", ORDER),
             message("WHSCON", "WHSCON01", RECEIPT), message("WHSCON", "WHSCON01", ONLY_CHILDREN))
    row = first(m.partner_coverage(x.partner_summary(df)))
    assert [float(row[c]) for c in ("carrier_coverage", "customer_coverage",
                                    "warehouse_coverage")] == [25.0, 25.0, 25.0]


def test_payload_shipments(spark):
    payload = '{"header":{"shipment_id":"1","ship_date":"2022-11-01"},' \
              '"customer":{"customer_id":"C"},"total_weight":2.5}'
    df = spark.createDataFrame([("SHPMNT", "9", payload), ("ORDERS", "8", payload)],
                               "idoc_type string, idoc_number string, raw_payload string")
    rows = x.extract_payload_shipments(df).collect()
    assert len(rows) == 1 and rows[0].customer_id == "C" and rows[0].total_weight == 2.5
    assert rows[0].ship_date == dt.datetime(2022, 11, 1)


def _filters(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if line.strip(" :+-").startswith("Filter")]


def test_exploded_segments_are_not_parsed_again_in_a_filter(raw):
    """Spark infers a filter by the array's size from an inner explosion."""
    events = {"E1SHP00": [{"tknum": "S1"}],
              "E1SHP10": [{"tstyp": "A"}, {"tstyp": "B", "tsrfo": "7"}]}
    sent = raw(message("SHPMNT", "SHPMNT05", events),
               message("SHPMNT", "SHPMNT05", {"E1SHP00": [{"tknum": "S2"}], "E1SHP10": []}, "2"),
               message("SHPMNT", "SHPMNT05", {"E1SHP00": [{"tknum": "S3"}]}, "3"),
               message("ORDERS", "ORDERS05", ORDER, "4"))
    found = x.extract_tracking_events(sent)
    assert sorted((r.shipment_number, r.sequence, r.event_type) for r in found.collect()) == [
        ("S1", 1, "A"), ("S1", 7, "B")]
    for df in (found, x.extract_order_items(sent), x.extract_invoice_items(sent),
               x.extract_delivery_items(sent), x.extract_warehouse_items(sent)):
        assert not [f for f in _filters(df) if "variant_get" in f or "size(" in f]


def test_only_fields_that_are_read_are_converted(raw):
    sent = raw(message("ORDERS", "ORDERS05", ORDER))
    some = parsed(sent, "E1EDK03", E1EDK01="belnr")
    assert some.select("_s_E1EDK01", "_s_E1EDK03").schema.simpleString() == (
        "struct<_s_E1EDK01:array<struct<belnr:string>>,"
        "_s_E1EDK03:array<struct<iddat:string,datum:string,uzeit:string>>>")
    assert some.select("_h_E1EDK01.belnr").first()[0] == "B-770145"
    plan = x.partner_summary(sent)._jdf.queryExecution().optimizedPlan().toString()
    assert "customer_id" in plan and "StructField(bsart" not in plan and "tknum" not in plan


def test_segment_messages_convert_only_the_control_fields_that_are_read(raw):
    sent = raw(message("SHPMNT", "SHPMNT05", {"E1SHP00": [{"tknum": "S1", "tdlnr": "C1"}]}, "7"))
    for df in (x.extract_shipments(sent), x.extract_orders(sent, as_of=AS_OF),
               x.extract_invoices(sent, as_of=AS_OF), x.extract_deliveries(sent),
               x.extract_warehouse_header(sent), x.partner_summary(sent).drop("header")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "StructField(docnum" in plan and "StructField(sndprn" not in plan
    row = x.partner_summary(sent).first()
    assert (row.idoc_number, row.carrier_id, row.header.docnum, row.header.sender) == (
        "7", "C1", "7", "NORTH")
    # a record that is no object, and none
    odd = raw(message("SHPMNT", "SHPMNT05", {}, ctl="[1]"), message("SHPMNT", "SHPMNT05", {}, ctl=""))
    assert [(r.idoc_number, r.header.docnum) for r in x.partner_summary(odd).collect()] == [
        (None, None)] * 2


def test_times_of_messages_are_formatted_once(spark):
    made = driver_messages
    times = spark.createDataFrame([(t,) for t in (
        "2024-03-05 07:08:09.123456", "0001-01-01 00:00:00", "1582-10-04 23:59:59",
        "9999-12-31 23:59:59", "+10000-01-02 03:04:05", "0000-05-06 01:02:03", None)],
        "t string").select(F.col("t").cast("timestamp").alias("t"))
    pairs = [(made._day("t"), "yyyyMMdd"), (made._time("t"), "HHmmss"),
             (made._iso("t"), "yyyy-MM-dd'T'HH:mm:ss")]
    assert times.filter("t is not null").count() == 6
    for made_text, pattern in pairs:
        same = times.select(made_text.eqNullSafe(F.date_format("t", pattern)).alias("same"))
        assert [r.same for r in same.collect()] == [True] * 7
    plan = times.select(*[c for c, _ in pairs])._jdf.queryExecution().optimizedPlan().toString()
    assert "yyyyMMdd" not in plan and "HHmmss" not in plan


def test_flat_messages_convert_only_the_control_fields_that_are_read(raw):
    for kind, make in (("SHPMNT", x.extract_shipments_flat), ("WHSCON", x.extract_warehouse_flat),
                       ("ORDERS", lambda df: x.extract_orders_flat(df, as_of=AS_OF)),
                       ("INVOIC", lambda df: x.extract_invoices_flat(df, as_of=AS_OF))):
        made = make(raw(message(kind, f"{kind}05", {})))
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "StructField(docnum" in plan and "StructField(sndprn" not in plan
        dates = kind in ("WHSCON", "ORDERS")
        assert ("StructField(credat" in plan) == ("StructField(status" in plan) == dates
        assert made.count() == 1
