"""JSON messages made from the given tables, so extraction runs on data that grows with them.

One message per order, line or invoice; no group of rows is ever collected into one message.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.sources.driver_tables import Tables

C = F.col


def _text(c: Column | str) -> Column:
    return (C(c) if isinstance(c, str) else c).cast("string")


def _iso(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


# a formatter costs more than the rest of a field: a time is formatted once, in the form that all
# of its fields share


def _day(c: str) -> Column:
    return F.replace(F.substring_index(_iso(c), "T", 1), F.lit("-"), F.lit(""))


def _time(c: str) -> Column:
    return F.replace(F.substring_index(_iso(c), "T", -1), F.lit(":"), F.lit(""))


def _seg(name: str, **fields: Column) -> Column:
    return F.struct(F.lit(name).alias("segnam"), *[v.alias(k) for k, v in fields.items()])


def _message(df: DataFrame, kind: str, idoc: str, number: Column, created: str,
             data: Column) -> DataFrame:
    control = F.struct(number.alias("docnum"), F.lit("03").alias("status"),
                       F.lit("2").alias("direct"), F.lit("SALES").alias("sndprn"),
                       F.lit("LAKE").alias("rcvprn"), _day(created).alias("credat"),
                       _time(created).alias("cretim"))
    return df.select(F.lit(idoc).alias("idoc_type"), F.lit(kind).alias("message_type"),
                     "sap_system", C(created).alias("timestamp"),
                     F.to_json(control).alias("control"), F.to_json(data).alias("data"))


class Messages:
    """Message frames over ``Tables``."""

    def __init__(self, tables: Tables):
        self.t = tables

    @cached_property
    def orders(self) -> DataFrame:
        """Orders with segments; two items that add up to the order, children mixed in."""
        total = C("total_amount")
        first = F.round(total / 4, 2).cast("decimal(18,2)")
        item = {"posex": F.lit("10"), "menge": F.lit("3.000"), "menee": F.lit("EA"),
                "vprei": F.lit("1.00"), "netwr": _text(first), "matnr": F.lit("MAT-A"),
                "arktx": F.lit("first"), "werks": F.lit("WH001")}
        rest = {**item, "posex": F.lit("20"), "menge": F.lit("2.500"),
                "netwr": _text((total - first).cast("decimal(18,2)")), "matnr": F.lit("MAT-B"),
                "arktx": F.lit("second")}
        child = {k: F.lit(None).cast("string") for k in item}
        data = F.struct(
            F.array(_seg("E1EDK01", curcy=C("currency"), zterm=F.lit("Net 30"),
                         bsart=F.lit("ZOR"), belnr=C("order_number"), ntgew=F.lit("25.000"),
                         ablad=F.lit("WH001"), recipnt_no=C("customer_id"),
                         vsbed=C("priority"), customer_id=C("customer_id"),
                         customer_name=C("customer_name"), bldat=_day("order_date"),
                         delivery_date=_iso("requested_delivery_date"),
                         order_status=C("order_status"), total_value=_text(total)))
            .alias("E1EDK01"),
            # the wished date comes first: entries are told apart by qualifier, not position
            F.array(_seg("E1EDK03", iddat=F.lit("002"), datum=_day("requested_delivery_date"),
                         uzeit=_time("requested_delivery_date")),
                    _seg("E1EDK03", iddat=F.lit("012"), datum=_day("order_date"),
                         uzeit=_time("order_date"))).alias("E1EDK03"),
            F.array(_seg("E1EDKA1", parvw=F.lit("AG"), ort01=F.lit("Head Office")),
                    _seg("E1EDKA1", parvw=F.lit("WE"), ort01=F.lit("Main Store")))
            .alias("E1EDKA1"),
            F.array(_seg("E1EDP01", **item), _seg("E1EDP19", **child), _seg("E1EDP01", **rest))
            .alias("E1EDP01"),
            F.array(_seg("E1EDS01", sumid=F.lit("011"), summe=F.lit("1.50")),
                    _seg("E1EDS01", sumid=F.lit("001"), summe=_text(total))).alias("E1EDS01"))
        return _message(self.t.orders, "ORDERS", "ORDERS05", C("order_number"), "order_date", data)

    @cached_property
    def orders_flat(self) -> DataFrame:
        data = F.struct(
            "customer_id", "customer_name", _iso("requested_delivery_date").alias("delivery_date"),
            F.lit("ZOR").alias("order_type"), "priority",
            _text("total_amount").alias("total_amount"), "currency",
            F.lit("Net 30").alias("payment_terms"), _text("total_lines").alias("line_count"),
            _text("total_quantity").alias("total_quantity"),
            _text("total_weight_kg").alias("total_weight"))
        return _message(self.t.orders_with_lines, "ORDERS", "ORDERS05", C("order_number"),
                        "order_date", data)

    @cached_property
    def orders_lab(self) -> DataFrame:
        """Upper-case payload; every order is sent twice, first without its ship dates. Every
        third order has two lines."""
        df = self.t.orders.withColumn("_version", F.explode(F.array(F.lit(1), F.lit(2))))
        later = C("_version") == 2
        line = F.struct(
            C("customer_id").alias("CUSTOMER_ID"), C("customer_name").alias("CUSTOMER_NAME"),
            _day("order_date").alias("ORDER_DATE"),
            _day("requested_delivery_date").alias("DELIVERY_DATE"),
            F.when(later, _day("actual_ship_date")).alias("SHIP_DATE"),
            F.when(later, _day("actual_delivery_date")).alias("DELIVERED_DATE"),
            _text("total_amount").alias("TOTAL_AMOUNT"), C("currency").alias("CURRENCY"),
            F.upper("order_status").alias("STATUS"))
        return df.select(
            F.concat_ws("-", "order_number", "_version").alias("message_id"), "sap_system",
            (C("order_date") + F.make_dt_interval(hours=C("_version"))).alias("timestamp"),
            F.to_json(F.struct(C("order_number").alias("DOCNUM"), F.lit("ZOR").alias("DOCTYP")))
            .alias("control"),
            F.to_json(F.when(C("order_number").cast("bigint") % 3 == 0, F.array(line, line))
                      .otherwise(F.array(line))).alias("data"))

    @cached_property
    def shipments(self) -> DataFrame:
        """Shipments with segments; the carrier number is only in ``tdlnr``."""
        code = (F.when(C("shipment_status") == "Delivered", "B")
                .when(C("shipment_status") == "In Transit", "A").otherwise("C"))
        data = F.struct(
            F.array(_seg("E1SHP00", tknum=C("shipment_number"), vsart=C("service_level"),
                         tdlnr=C("carrier_id"), signi=C("tracking_number"), shpsts=code,
                         order_id=C("order_number"), carrier_name=C("carrier_name"),
                         customer_id=C("customer_id"), customer_name=C("customer_name"),
                         planned_ship_date=_iso("planned_ship_date"),
                         actual_ship_date=_iso("actual_ship_date"),
                         planned_delivery_date=_iso("planned_delivery_date"),
                         actual_delivery_date=_iso("actual_delivery_date"),
                         total_weight=_text("total_weight_kg"))).alias("E1SHP00"),
            F.array(_seg("E1SHP02", parvw=F.lit("SH"), parnr=C("origin_country"),
                         ort01=F.lit(None).cast("string")),
                    _seg("E1SHP02", parvw=F.lit("CN"), parnr=C("customer_id"),
                         ort01=C("destination_country"))).alias("E1SHP02"),
            F.array(_seg("E1SHP10", tsrfo=F.lit("1"), tstyp=F.lit("PLANNED"),
                         tsdat=_day("planned_ship_date"), tsuhr=_time("planned_ship_date"),
                         tsrst=F.lit("P"), tsloc=C("origin_country")),
                    _seg("E1SHP10", tsrfo=F.lit("2"), tstyp=F.lit("STATUS_UPDATE"),
                         tsdat=_day("planned_delivery_date"),
                         tsuhr=_time("planned_delivery_date"), tsrst=code,
                         tsloc=C("destination_country"))).alias("E1SHP10"))
        return _message(self.t.shipments, "SHPMNT", "SHPMNT05", C("shipment_number"),
                        "planned_ship_date", data)

    @cached_property
    def shipments_flat(self) -> DataFrame:
        data = F.struct(
            "tracking_number", "order_number", C("carrier_id").alias("carrier_code"),
            "carrier_name", "service_level", "shipment_status",
            *[_iso(c).alias(c) for c in ("planned_ship_date", "actual_ship_date",
                                         "planned_delivery_date", "actual_delivery_date")],
            _text("total_weight_kg").alias("total_weight"))
        return _message(self.t.shipments, "SHPMNT", "SHPMNT05", C("shipment_number"),
                        "planned_ship_date", data)

    @cached_property
    def deliveries(self) -> DataFrame:
        """Delivery notes; the header is an object here, with weights as numbers."""
        rows = self.t.shipments.filter(C("actual_delivery_date").isNotNull())
        weight = C("total_weight_kg").cast("double")
        data = F.struct(
            _seg("E1EDK01", belnr=F.concat(F.lit("D"), C("shipment_number")),
                 bldat=_day("actual_ship_date"), ntgew=weight, brgew=weight * 2,
                 volum=weight / 4, vsart=C("service_level"), traid=C("tracking_number"),
                 carrier_id=C("carrier_id"), carrier_name=C("carrier_name"),
                 customer_id=C("customer_id"), customer_name=C("customer_name"),
                 partner_access_scope=F.lit("")).alias("E1EDK01"),
            F.array(_seg("E1EDK14", qualf=F.lit("008"), orgid=F.lit("WH001"))).alias("E1EDK14"),
            F.array(_seg("E1EDL20", lfimg=F.lit("1.500"), vgbel=C("order_number")),
                    _seg("E1EDL20", lfimg=F.lit("2.000"), vgbel=C("order_number")))
            .alias("E1EDL20"),
            F.array(_seg("E1EDL37", vhilm=F.lit("PALLET")), _seg("E1EDL37", vhilm=F.lit("CARTON")),
                    _seg("E1EDL37", vhilm=F.lit("CARTON"))).alias("E1EDL37"))
        return _message(rows, "DESADV", "DESADV01", C("shipment_number"), "actual_ship_date", data)

    @cached_property
    def movements(self) -> DataFrame:
        """Movements with one item, its serials and bin mixed in; exceptions carry a reason."""
        none = F.lit(None).cast("string")
        blank = {k: none for k in ("matnr", "confqty", "targetqty", "variance", "sernr", "lgpla")}

        def child(kind: str, **fields: Column) -> Column:
            return _seg(kind, itemno=F.lit("10"), **{**blank, **fields})

        qty = _text("quantity")
        fault = F.array(_seg("E1WHC40", itemno=F.lit("10"), excptype=C("exception_type"),
                             reason=C("quality_status")))
        data = F.struct(
            F.array(_seg("E1WHC00", confno=C("movement_id"), lgnum=C("warehouse_id"),
                         whstype=C("movement_type"), refdoc=C("order_number"),
                         status=F.lit("COMPLETE"), confdat=_day("movement_timestamp"),
                         conftim=_time("movement_timestamp"), usnam=C("operator_id"),
                         warehouse_partner_id=C("warehouse_partner_id"),
                         matnr=C("material_id"), menge=_text(C("quantity").cast("int")),
                         brgew=_text("weight_kg"))).alias("E1WHC00"),
            F.array(_seg("E1WHC01", duration=_text(C("processing_time_minutes") * 60)))
            .alias("E1WHC01"),
            F.array(child("E1WHC10", matnr=C("material_id"), confqty=qty, targetqty=qty,
                          variance=F.lit("0.000")),
                    child("E1WHC11", sernr=F.concat(F.lit("S1-"), C("material_id"))),
                    child("E1WHC11", sernr=F.concat(F.lit("S2-"), C("material_id"))),
                    child("E1WHC13", lgpla=C("location_code"))).alias("E1WHC10"),
            F.array(_seg("E1WHC20", restype=F.lit("EQUIPMENT"), resid=C("equipment_id"),
                         efficiency=F.lit("98.0")),
                    _seg("E1WHC20", restype=F.lit("LABOR"), resid=C("operator_id"),
                         efficiency=F.lit("95.5"))).alias("E1WHC20"),
            F.array(_seg("E1WHC30", result=C("quality_status"))).alias("E1WHC30"),
            F.when(C("exception_flag"), fault).alias("E1WHC40"))
        return _message(self.t.warehouse, "WHSCON", "WHSCON01", C("movement_id"),
                        "movement_timestamp", data)

    @cached_property
    def movements_flat(self) -> DataFrame:
        done = C("movement_timestamp") + F.make_dt_interval(mins=C("processing_time_minutes")
                                                            .cast("int"))
        df = self.t.warehouse.withColumn("_done", done)
        data = F.struct(
            "warehouse_id", "movement_type", "material_id", _text("quantity").alias("quantity"),
            _text("weight_kg").alias("weight"), "zone", "operator_id", "equipment_id",
            "quality_status", _iso("_done").alias("completed_time"),
            F.when(C("inspection_required"), "X").alias("inspection_flag"),
            F.when(C("exception_flag"), "X").otherwise("").alias("exception_flag"))
        return _message(df, "WHSCON", "WHSCON01", C("movement_id"), "movement_timestamp", data)

    @cached_property
    def invoices(self) -> DataFrame:
        """Invoices with segments; the subtotal comes first among the sums."""
        data = F.struct(
            F.array(_seg("E1EDK01", belnr=C("invoice_number"), bldat=_day("invoice_date"),
                         curcy=C("currency"), zterm=F.lit("Net 30"), bsart=F.lit("ZINV"),
                         recipnt_no=C("customer_id"), customer_id=C("customer_id"),
                         order_ref=C("order_number"), total_amount=_text("total_amount"),
                         tax_amount=_text("tax_amount"), due_date=_iso("due_date"),
                         payment_status=C("payment_status"))).alias("E1EDK01"),
            F.array(_seg("E1EDK03", iddat=F.lit("012"), datum=_day("invoice_date"),
                         uzeit=_time("invoice_date")),
                    _seg("E1EDK03", iddat=F.lit("013"), datum=_day("due_date"),
                         uzeit=F.lit(None).cast("string"))).alias("E1EDK03"),
            F.array(_seg("E1EDK14", qualf=F.lit("001"),
                         orgid=F.concat(F.lit("D-"), C("order_number")))).alias("E1EDK14"),
            F.array(_seg("E1EDS01", sumid=F.lit("002"), summe=_text("subtotal_amount")),
                    _seg("E1EDS01", sumid=F.lit("011"), summe=_text("tax_amount")),
                    _seg("E1EDS01", sumid=F.lit("001"), summe=_text("total_amount")))
            .alias("E1EDS01"))
        return _message(self.t.invoices, "INVOIC", "INVOIC02", C("invoice_number"),
                        "invoice_date", data)

    @cached_property
    def invoice_lines(self) -> DataFrame:
        """Invoices with the lines of their orders, children mixed in. In every 97th the stated
        subtotal differs from the lines."""
        lines = self.t.order_lines.groupBy("order_number").agg(F.sort_array(F.collect_list(
            F.struct("item_number", "material_id", "quantity", "net_amount"))).alias("_lines"))
        none = F.lit(None).cast("string")

        def segs(line: Column) -> Column:
            number = _text(line["item_number"] * 10)
            return F.array(
                _seg("E1EDP01", posex=number, matnr=line["material_id"], idtnr=none,
                     menge=_text(line["quantity"]), netwr=_text(line["net_amount"])),
                _seg("E1EDP19", posex=number, matnr=none, idtnr=line["material_id"], menge=none,
                     netwr=none))

        off = F.when(C("order_number").cast("bigint") % 97 == 0, 1).otherwise(0)
        stated = (C("subtotal_amount") + off).cast("decimal(18,2)")
        data = F.struct(
            F.array(_seg("E1EDK01", belnr=C("invoice_number"))).alias("E1EDK01"),
            F.flatten(F.transform("_lines", segs)).alias("E1EDP01"),
            F.array(_seg("E1EDS01", sumid=F.lit("002"), summe=_text(stated))).alias("E1EDS01"))
        return _message(self.t.invoices.join(lines, "order_number"), "INVOIC", "INVOIC02",
                        C("invoice_number"), "invoice_date", data)

    @cached_property
    def delivery_lines(self) -> DataFrame:
        """Delivery notes with two lines, of which the first has a batch."""
        rows = self.t.shipments.filter(C("actual_delivery_date").isNotNull())
        half = _text((C("total_weight_kg") / 2).cast("decimal(15,3)"))
        data = F.struct(
            F.array(_seg("E1EDK01", belnr=F.concat(F.lit("D"), C("shipment_number"))))
            .alias("E1EDK01"),
            F.array(*(_seg("E1EDL20", posex=F.lit(n), matnr=F.lit(m), lfimg=F.lit(q),
                           vrkme=F.lit("EA"), ntgew=half, vgbel=C("order_number"))
                      for n, m, q in (("10", "P1", "1.500"), ("20", "P2", "2.000"))))
            .alias("E1EDL20"),
            F.array(_seg("E1EDL24", posnr=F.lit("10"), lfimg=F.lit("1.500"),
                         charg=F.concat(F.lit("B"), C("shipment_number")))).alias("E1EDL24"))
        return _message(rows, "DESADV", "DESADV01", C("shipment_number"), "actual_ship_date", data)

    @cached_property
    def invoices_flat(self) -> DataFrame:
        data = F.struct(
            "invoice_number", "invoice_type", _iso("invoice_date").alias("invoice_date"),
            _iso("due_date").alias("due_date"), _iso("payment_date").alias("payment_date"),
            "customer_id", "currency",
            *[_text(c).alias(c) for c in ("subtotal_amount", "tax_amount", "discount_amount",
                                          "amount_paid")],
            "payment_status", "service_type", _text("total_line_items").alias("line_items"),
            _text("fiscal_year").alias("fiscal_year"), _text("fiscal_period")
            .alias("fiscal_period"), F.when(C("is_disputed"), "X").alias("dispute_flag"))
        return _message(self.t.invoices, "INVOIC", "INVOIC02", C("invoice_number"),
                        "invoice_date", data)
