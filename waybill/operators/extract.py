"""Raw messages to typed silver entities.

``raw`` has idoc_type, message_type, sap_system, timestamp, control and data (JSON text). Wrong
dates and amounts become null, they never stop a load.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import (
    SLA_PRESETS,
    SlaPolicy,
    aging_bucket,
    as_ts,
    diff_boundary,
    first_filled,
    payment_efficiency,
    payment_status,
    sla_class,
)
from waybill.functions.payload import (
    any_field,
    columns,
    control_record,
    field,
    head,
    moment,
    number,
    only,
    parsed,
    pick,
    segments,
    take,
    with_flat,
    with_items,
)
from waybill.functions.policies import (
    DEFAULT_SCOPES,
    SHIPMENT_STATUS_CODES,
    lookup,
    remaining_days_class,
)
from waybill.operators.rows import dedupe_latest

C = F.col


def _control(name: str) -> Column:
    return field(C("_c"), name)


def _of(raw: DataFrame, kinds: str | tuple[str, ...], *names: str, **fields: str) -> DataFrame:
    """Messages of the given kinds, parsed, with the named segments (or some fields of them)
    located, and the message number of the control record (or what ``control`` names)."""
    wanted = (kinds,) if isinstance(kinds, str) else kinds
    return parsed(raw.filter(C("message_type").isin(*wanted)), *names,
                  **{"control": "docnum"} | fields)


def _paths(spec: Mapping[str, tuple[str, str]]) -> str:
    """The fields a specification reads."""
    return " ".join(dict.fromkeys(path for path, _ in spec.values()))


def _flat(raw: DataFrame, kinds: str | tuple[str, ...], spec: Mapping[str, tuple[str, str]],
          *more: str, control: str = "docnum") -> DataFrame:
    """Messages of the given kinds with the top-level fields of ``spec`` and ``more``, and those
    of the control record that are read."""
    return with_flat(_of(raw, kinds, control=control),
                     [*(path for path, _ in spec.values()), *more])


def _meta() -> list[Column]:
    return [C("sap_system"), C("idoc_type"), _control("docnum").alias("idoc_number"),
            C("timestamp").alias("message_timestamp")]


# ---------------------------------------------------------------- headers

# Names of the header entries and the control fields they come from.
HEADER_FIELDS = {"docnum": "docnum", "status": "status", "direction": "direct",
                 "sender": "sndprn", "receiver": "rcvprn", "created_date": "credat",
                 "created_time": "cretim"}


def header(control: Column) -> Column:
    """Control record as a struct of text fields."""
    return F.struct(*[field(control, path).alias(name) for name, path in HEADER_FIELDS.items()])


def message_summary(raw: DataFrame) -> DataFrame:
    """One row per message with its number and header."""
    return parsed(raw).select("timestamp", "idoc_type", "message_type", "sap_system",
                              _control("docnum").alias("idoc_number"),
                              header(C("_c")).alias("header"))


def access_scope(*names: str) -> Column:
    """Scope from the header segments, or the default of the type; unknown types have none."""
    given = any_field(*[(head(n), "partner_access_scope") for n in names], default=None)
    known = lookup(DEFAULT_SCOPES, C("message_type"))
    return F.when(known.isNull(), "").otherwise(F.coalesce(given, known))


def partner_summary(raw: DataFrame) -> DataFrame:
    """Message summary with carrier, customer, warehouse partner and access scope."""
    ship, doc, whs = head("E1SHP00"), head("E1EDK01"), head("E1WHC00")
    partners = "carrier_id carrier_name customer_id customer_name partner_access_scope"
    # a conversion of its own, which goes where the header is not asked for
    record = control_record(" ".join(HEADER_FIELDS.values()))
    return parsed(
        raw, control="docnum", E1SHP00=f"{partners} tdlnr", E1EDK01=partners,
        E1WHC00="warehouse_partner_id warehouse_partner_name partner_access_scope").withColumn(
        "_header", record).select(
        "timestamp", "idoc_type", "message_type", "sap_system",
        _control("docnum").alias("idoc_number"), header(C("_header")).alias("header"),
        any_field((ship, "carrier_id"), (ship, "tdlnr"), (doc, "carrier_id")).alias("carrier_id"),
        any_field((ship, "carrier_name"), (doc, "carrier_name")).alias("carrier_name"),
        any_field((ship, "customer_id"), (doc, "customer_id")).alias("customer_id"),
        any_field((ship, "customer_name"), (doc, "customer_name")).alias("customer_name"),
        any_field((whs, "warehouse_partner_id")).alias("warehouse_partner_id"),
        any_field((whs, "warehouse_partner_name")).alias("warehouse_partner_name"),
        access_scope("E1SHP00", "E1EDK01", "E1WHC00").alias("partner_access_scope"))


# ---------------------------------------------------------------- orders

FLAT_ORDER = {
    "customer_id": ("customer_id", "text"), "customer_name": ("customer_name", "text"),
    "requested_delivery_date": ("delivery_date", "time"),
    "promised_delivery_date": ("delivery_date", "time"), "order_type": ("order_type", "text"),
    "priority": ("priority", "text"), "total_amount": ("total_amount", "money"),
    "currency": ("currency", "text"), "payment_terms": ("payment_terms", "text"),
    "processing_status": ("processing_status", "text"), "created_by": ("created_by", "text"),
    "total_lines": ("line_count", "int"), "total_quantity": ("total_quantity", "quantity"),
    "total_weight_kg": ("total_weight", "quantity"),
}


def extract_orders_flat(raw: DataFrame, *, as_of,
                        sla: SlaPolicy = SLA_PRESETS["half_day"]) -> DataFrame:
    """Orders from payloads without segments; age and class count from the control date."""
    now = as_ts(as_of)
    created = moment(_control("credat"), _control("cretim"))
    age = diff_boundary("hour", now, C("order_date"))
    base = _flat(raw, "ORDERS", FLAT_ORDER, control="docnum status credat cretim").withColumn(
        "order_date", created)
    return base.select(
        _control("docnum").alias("order_number"), F.lit(1).alias("order_version"), "order_date",
        *columns(take(C("_f"), FLAT_ORDER)), _control("status").alias("order_status"),
        now.alias("last_modified"), age.cast("double").alias("order_age_hours"),
        (age > sla.limit).alias("is_delayed"),
        sla_class(C("order_date"), None, now, sla).alias("sla_status"),
        *_meta(), C("control").alias("raw_control"), C("data").alias("raw_data"))


HEAD_ORDER = {
    "order_type": ("bsart", "text"), "customer_number": ("recipnt_no", "text"),
    "sold_to_party": ("recipnt_no", "text"), "customer_id": ("customer_id", "text"),
    "customer_name": ("customer_name", "text"), "order_date": ("bldat", "time"),
    "requested_delivery_date": ("delivery_date", "time"),
    "confirmed_delivery_date": ("confirmed_delivery", "time"),
    "order_status": ("order_status", "text"), "fulfillment_status": ("fulfillment_status", "text"),
    "total_value": ("total_value", "money"), "currency": ("curcy", "text"),
    "payment_terms": ("zterm", "text"), "total_quantity": ("total_quantity", "int"),
    "total_weight_kg": ("total_weight", "quantity"), "line_item_count": ("item_count", "int"),
}


def extract_orders_header(raw: DataFrame) -> DataFrame:
    """Orders with partner columns, from the header segment only."""
    return _of(raw, "ORDERS", E1EDK01=f"{_paths(HEAD_ORDER)} partner_access_scope").select(
        _control("docnum").alias("order_number"), F.lit("").alias("ship_to_party"),
        *columns(take(head("E1EDK01"), HEAD_ORDER)),
        access_scope("E1EDK01").alias("partner_access_scope"), *_meta())


ADDRESS = {"ship_to_name": ("name1", "text"), "ship_to_street": ("stras", "text"),
           "ship_to_city": ("ort01", "text"), "ship_to_state": ("regio", "text"),
           "ship_to_postal_code": ("pstlz", "text"), "ship_to_country": ("land1", "text")}


def _item_sum(name: str, segment: str, path: str, kind: str = "decimal(18,3)") -> Column:
    """Sum of a field over the entries of one kind; zero for none."""
    values = F.transform(only(name, segment), lambda s: number(field(s, path), kind))
    return F.aggregate(values, F.lit(0).cast("decimal(28,3)"),
                       lambda acc, x: (acc + F.coalesce(x, F.lit(0))).cast("decimal(28,3)"))


def extract_orders(raw: DataFrame, *, as_of, sla: SlaPolicy = SLA_PRESETS["default"],
                   sla_hours: int = 24) -> DataFrame:
    """Orders from their segments: dates by qualifier, ship-to address, totals by kind of sum."""
    now = as_ts(as_of)
    doc = head("E1EDK01")
    ordered, wanted = pick("E1EDK03", "iddat", "012"), pick("E1EDK03", "iddat", "002")
    base = _of(raw, "ORDERS", "E1EDK03", "E1EDS01", "E1EDKA1", E1EDP01="segnam netwr menge",
               E1EDK01="belnr customer_id customer_name ablad bsart vsbed curcy zterm ntgew "
                       "partner_access_scope").withColumns({
        "_ship_to": pick("E1EDKA1", "parvw", "WE"),
        "order_date": moment(field(ordered, "datum"), field(ordered, "uzeit")),
        "total_amount": number(field(pick("E1EDS01", "sumid", "001"), "summe")),
        "tax_amount": number(field(pick("E1EDS01", "sumid", "011"), "summe")),
    })
    age = diff_boundary("hour", now, C("order_date"))
    return base.select(
        field(doc, "belnr").alias("order_number"), field(doc, "customer_id").alias("customer_id"),
        field(doc, "customer_name").alias("customer_name"), "order_date",
        moment(field(wanted, "datum"), field(wanted, "uzeit")).alias("requested_delivery_date"),
        (C("order_date") + F.make_dt_interval(hours=F.lit(sla_hours)))
        .alias("promised_delivery_date"),
        field(doc, "ablad").alias("warehouse_id"), field(doc, "bsart").alias("order_type"),
        field(doc, "vsbed").alias("priority"),
        _item_sum("E1EDP01", "E1EDP01", "netwr").cast("decimal(18,2)").alias("subtotal_amount"),
        "tax_amount", "total_amount", field(doc, "curcy").alias("currency"),
        field(doc, "zterm").alias("payment_terms"), F.lit("Pending").alias("order_status"),
        age.alias("order_age_hours"), (age > sla.limit).alias("is_delayed"),
        F.lit(sla_hours).alias("sla_target_hours"),
        sla_class(C("order_date"), None, now, sla).alias("sla_status"),
        *columns(take(C("_ship_to"), ADDRESS)),
        F.size(only("E1EDP01", "E1EDP01")).alias("total_lines"),
        _item_sum("E1EDP01", "E1EDP01", "menge").alias("total_quantity"),
        number(field(doc, "ntgew"), "decimal(15,3)").alias("total_weight_kg"),
        access_scope("E1EDK01").alias("partner_access_scope"), *_meta())


ITEM = {"item_number": ("posex", "text"), "material_id": ("matnr", "text"),
        "description": ("arktx", "text"), "quantity": ("menge", "quantity"),
        "unit": ("menee", "text"), "unit_price": ("vprei", "money"),
        "net_amount": ("netwr", "money"), "plant": ("werks", "text")}


def extract_order_items(raw: DataFrame) -> DataFrame:
    """One row per order line; child segments in the same array are left out."""
    base = _of(raw, "ORDERS", E1EDK01="belnr", E1EDP01=f"segnam {_paths(ITEM)}").select(
        field(head("E1EDK01"), "belnr").alias("order_number"), "sap_system",
        only("E1EDP01", "E1EDP01").alias("_items"))
    items = with_items(base, C("_items"), "_item")
    return items.select("order_number", "sap_system", (C("position") + 1).alias("position"),
                        *columns(take(C("_item"), ITEM)))


def extract_invoice_items(raw: DataFrame) -> DataFrame:
    """One row per invoice line; child segments in the same array are left out."""
    base = _of(raw, "INVOIC", E1EDK01="belnr", E1EDP01=f"segnam {_paths(ITEM)}").select(
        field(head("E1EDK01"), "belnr").alias("invoice_number"), "sap_system",
        only("E1EDP01", "E1EDP01").alias("_items"))
    items = with_items(base, C("_items"), "_item")
    return items.select("invoice_number", "sap_system", (C("position") + 1).alias("position"),
                        *columns(take(C("_item"), ITEM)))


def extract_orders_lab(raw: DataFrame, *, as_of) -> DataFrame:
    """Orders from upper-case JSON paths, cleaned, reduced to the latest version, classified.

    ``raw`` has message_id, sap_system, timestamp, control (object) and data (array of lines).
    Every line repeats the order's header, so its fields are taken from the first one;
    ``line_count`` tells how many lines the message has.
    """
    def line(name: str) -> Column:
        return F.get_json_object("data", f"$[0].{name}")

    def day(name: str) -> Column:
        return F.to_date(F.try_to_timestamp(line(name), F.lit("yyyyMMdd")))

    typed = raw.select(
        "message_id", "sap_system", "timestamp",
        F.get_json_object("control", "$.DOCNUM").alias("order_number"),
        F.get_json_object("control", "$.DOCTYP").alias("order_type"),
        line("CUSTOMER_ID").alias("customer_number"), line("CUSTOMER_NAME").alias("customer_name"),
        day("ORDER_DATE").alias("order_date"), day("DELIVERY_DATE").alias("delivery_date"),
        day("SHIP_DATE").alias("actual_ship_date"),
        day("DELIVERED_DATE").alias("actual_delivery_date"),
        line("TOTAL_AMOUNT").try_cast("decimal(15,2)").alias("total_amount"),
        line("CURRENCY").alias("currency"), line("STATUS").alias("_status"),
        F.json_array_length("data").cast("bigint").alias("line_count"))
    latest = dedupe_latest(typed, ["order_number", "sap_system"], ["timestamp", "message_id"])
    now = as_ts(as_of)
    status = (F.when(C("actual_delivery_date").isNotNull(), "Delivered")
              .when(C("actual_ship_date").isNotNull(), "Shipped")
              .when(C("_status") == "CANCELLED", "Cancelled").otherwise("Pending"))
    return latest.withColumns({
        "sla_days_remaining": F.datediff("delivery_date", now),
        "sla_status": F.coalesce(remaining_days_class(C("delivery_date"), now),
                                 F.lit("Breached")),
        "order_status": status,
        "days_to_ship": F.datediff("actual_ship_date", "order_date"),
        "days_to_delivery": F.datediff("actual_delivery_date", "order_date"),
        "partner_access_scope": C("customer_number")}).drop("_status")


# ---------------------------------------------------------------- shipments and deliveries

def _shipment_facts() -> dict[str, Column]:
    """Delays, duration and state from the four planned and actual times.

    ``is_on_time`` stays null until the delivery is known.
    """
    planned_ship, ship = C("planned_ship_date"), C("actual_ship_date")
    planned, arrived = C("planned_delivery_date"), C("actual_delivery_date")
    return {
        "ship_delay_hours": diff_boundary("hour", ship, planned_ship),
        "delivery_delay_hours": diff_boundary("hour", arrived, planned),
        "transit_time_hours": diff_boundary("hour", arrived, ship),
        "is_on_time": arrived <= planned,
        "is_in_transit": ship.isNotNull() & arrived.isNull(),
    }


FLAT_SHIPMENT = {
    "tracking_number": ("tracking_number", "text"), "order_number": ("order_number", "text"),
    "delivery_number": ("delivery_number", "text"), "origin_location": ("origin_location", "text"),
    "origin_address": ("origin_address", "text"),
    "destination_location": ("destination_location", "text"),
    "destination_address": ("destination_address", "text"), "carrier_code": ("carrier_code", "text"),
    "carrier_name": ("carrier_name", "text"), "service_level": ("service_level", "text"),
    "transport_mode": ("transport_mode", "text"),
    "planned_ship_date": ("planned_ship_date", "time"),
    "actual_ship_date": ("actual_ship_date", "time"),
    "planned_delivery_date": ("planned_delivery_date", "time"),
    "estimated_delivery_date": ("estimated_delivery_date", "time"),
    "actual_delivery_date": ("actual_delivery_date", "time"),
    "shipment_status": ("shipment_status", "text"), "delivery_status": ("delivery_status", "text"),
    "current_location": ("current_location", "text"), "package_count": ("package_count", "int"),
    "total_weight_kg": ("total_weight", "quantity"), "total_volume_m3": ("total_volume", "quantity"),
}


def extract_shipments_flat(raw: DataFrame) -> DataFrame:
    """Shipments and deliveries from payloads without segments."""
    return _flat(raw, ("SHPMNT", "DESADV"), FLAT_SHIPMENT).select(
        _control("docnum").alias("shipment_number"), *columns(take(C("_f"), FLAT_SHIPMENT)),
        *_meta(), C("control").alias("raw_control"), C("data").alias("raw_data"),
    ).withColumns(_shipment_facts())


def extract_shipments(raw: DataFrame,
                      status_map: Mapping[str, str] = SHIPMENT_STATUS_CODES) -> DataFrame:
    """Shipments from either message kind, with partner columns.

    Header fields win over the time segments; a field missing in one kind is taken from the other.
    """
    ship, doc = head("E1SHP00"), head("E1EDK01")
    delivered = field(ship, "shpsts") == "B"
    started = moment(field(ship, "datbg"), field(ship, "uatbg"))
    ended = moment(field(ship, "daten"), field(ship, "uaten"))
    planned_ship = moment(any_field((ship, "planned_ship_date"), (doc, "bldat"), default=None))
    return _of(raw, ("SHPMNT", "DESADV"), "E1SHP00", "E1SHP02", E1SHP01="vbeln", E1EDK14="orgid",
               E1EDKA1="parvw ort01",
               E1EDK01="bldat traid belnr carrier_id carrier_name vsart customer_id "
                       "customer_name partner_access_scope ntgew volum").select(
        any_field((ship, "tknum"), (C("_c"), "docnum")).alias("shipment_number"),
        any_field((ship, "signi"), (doc, "traid")).alias("tracking_number"),
        any_field((ship, "order_id")).alias("order_number"),
        any_field((ship, "delivery_id"), (head("E1SHP01"), "vbeln"), (doc, "belnr"))
        .alias("delivery_number"),
        any_field((ship, "origin_warehouse"), (pick("E1SHP02", "parvw", "SH"), "parnr"),
                  (head("E1EDK14"), "orgid")).alias("origin_location"),
        any_field((ship, "destination_city"), (pick("E1SHP02", "parvw", "CN"), "ort01"),
                  (pick("E1EDKA1", "parvw", "WE"), "ort01")).alias("destination_location"),
        any_field((ship, "carrier_id"), (ship, "tdlnr"), (doc, "carrier_id")).alias("carrier_id"),
        any_field((ship, "carrier_name"), (doc, "carrier_name")).alias("carrier_name"),
        any_field((ship, "vsbed"), (ship, "vsart"), (doc, "vsart")).alias("service_level"),
        field(ship, "vsart").alias("transport_mode"),
        any_field((ship, "customer_id"), (doc, "customer_id")).alias("customer_id"),
        any_field((ship, "customer_name"), (doc, "customer_name")).alias("customer_name"),
        access_scope("E1SHP00", "E1EDK01").alias("partner_access_scope"),
        F.coalesce(planned_ship, started).alias("planned_ship_date"),
        F.coalesce(moment(field(ship, "actual_ship_date")), started).alias("actual_ship_date"),
        F.coalesce(moment(field(ship, "planned_delivery_date")), ended)
        .alias("planned_delivery_date"),
        moment(field(ship, "estimated_delivery")).alias("estimated_delivery_date"),
        F.coalesce(moment(field(ship, "actual_delivery_date")), F.when(delivered, ended))
        .alias("actual_delivery_date"),
        lookup(dict(status_map), field(ship, "shpsts"), F.lit("Unknown"))
        .alias("shipment_status"),
        field(ship, "current_location").alias("current_location"),
        number(field(ship, "package_count"), "int").alias("package_count"),
        number(any_field((ship, "total_weight"), (doc, "ntgew")), "decimal(15,3)")
        .alias("total_weight_kg"),
        number(any_field((ship, "total_volume"), (doc, "volum")), "decimal(15,3)")
        .alias("total_volume_m3"),
        *_meta()).withColumns(_shipment_facts())


EVENT = {"event_type": ("tstyp", "text"), "status_code": ("tsrst", "text"),
         "status_text": ("tstxt", "text"), "location": ("tsloc", "text")}


def extract_tracking_events(raw: DataFrame) -> DataFrame:
    """One row per tracking event with its sequence number and time."""
    base = _of(raw, "SHPMNT", "E1SHP10", E1SHP00="tknum").select(
        field(head("E1SHP00"), "tknum").alias("shipment_number"), "sap_system",
        segments("E1SHP10").alias("_events"))
    events = with_items(base, C("_events"), "_event", "_pos")
    return events.select(
        "shipment_number", "sap_system",
        F.coalesce(number(field(C("_event"), "tsrfo"), "int"), C("_pos") + 1).alias("sequence"),
        moment(field(C("_event"), "tsdat"), field(C("_event"), "tsuhr")).alias("event_time"),
        *columns(take(C("_event"), EVENT)))


def extract_deliveries(raw: DataFrame) -> DataFrame:
    """Delivery notes with weights, volume, plant, item count and handling units."""
    doc = head("E1EDK01")
    date = pick("E1EDK03", "iddat", "012")
    units = segments("E1EDL37")

    def count_of(kind: str) -> Column:
        return F.size(F.filter(units, lambda s: F.upper(field(s, "vhilm")) == kind))

    return _of(raw, "DESADV", "E1EDK03", "E1EDK14", "E1EDL37", E1EDL20="segnam lfimg vgbel",
               E1EDK01="belnr bldat carrier_id carrier_name traid vsart customer_id "
                       "customer_name ntgew brgew volum partner_access_scope").select(
        field(doc, "belnr").alias("delivery_number"),
        F.coalesce(moment(field(date, "datum"), field(date, "uzeit")), moment(field(doc, "bldat")))
        .alias("delivery_date"),
        field(F.get(segments("E1EDL20"), F.lit(0)), "vgbel").alias("order_number"),
        field(doc, "carrier_id").alias("carrier_id"),
        field(doc, "carrier_name").alias("carrier_name"),
        field(doc, "traid").alias("tracking_number"), field(doc, "vsart").alias("service_level"),
        field(doc, "customer_id").alias("customer_id"),
        field(doc, "customer_name").alias("customer_name"),
        field(pick("E1EDK14", "qualf", "008"), "orgid").alias("warehouse_id"),
        number(field(doc, "ntgew"), "decimal(10,2)").alias("total_weight_kg"),
        number(field(doc, "brgew"), "decimal(10,2)").alias("total_gross_weight_kg"),
        number(field(doc, "volum"), "decimal(10,2)").alias("total_volume_m3"),
        F.size(segments("E1EDL20")).alias("item_count"),
        _item_sum("E1EDL20", "E1EDL20", "lfimg").alias("total_quantity"),
        count_of("PALLET").alias("total_pallets"), count_of("CARTON").alias("total_cartons"),
        access_scope("E1EDK01").alias("partner_access_scope"), *_meta())


DELIVERY_ITEM = {"item_number": ("posex", "text"), "material_id": ("matnr", "text"),
                 "description": ("arktx", "text"), "quantity": ("lfimg", "quantity"),
                 "unit": ("vrkme", "text"), "weight_kg": ("ntgew", "quantity"),
                 "volume_m3": ("volum", "quantity"), "order_number": ("vgbel", "text")}
BATCH = {"batch_number": ("charg", "text"), "batch_quantity": ("lfimg", "quantity")}


def extract_delivery_items(raw: DataFrame) -> DataFrame:
    """One row per delivery line with its batch; a line without batch segment has null there."""
    base = _of(raw, "DESADV", "E1EDL24", E1EDK01="belnr", E1EDL20=_paths(DELIVERY_ITEM)).select(
        field(head("E1EDK01"), "belnr").alias("delivery_number"), "sap_system",
        segments("E1EDL24").alias("_batches"), segments("E1EDL20").alias("_items"))
    items = with_items(base, C("_items"), "_item")
    own = F.get(F.filter("_batches", lambda s: field(s, "posnr") == field(C("_item"), "posex")),
                F.lit(0))
    return items.withColumn("_batch", own).select(
        "delivery_number", "sap_system", (C("position") + 1).alias("position"),
        *columns(take(C("_item"), DELIVERY_ITEM)), *columns(take(C("_batch"), BATCH)))


# ---------------------------------------------------------------- warehouse

FLAT_MOVEMENT = {
    "warehouse_id": ("warehouse_id", "text"), "movement_type": ("movement_type", "text"),
    "material_id": ("material_id", "text"),
    "material_description": ("material_description", "text"),
    "batch_number": ("batch_number", "text"), "serial_number": ("serial_number", "text"),
    "quantity": ("quantity", "quantity"), "unit_of_measure": ("unit", "text"),
    "weight_kg": ("weight", "quantity"), "volume_m3": ("volume", "quantity"),
    "from_location": ("from_location", "text"), "to_location": ("to_location", "text"),
    "zone": ("zone", "text"), "aisle": ("aisle", "text"), "shelf": ("shelf", "text"),
    "bin_location": ("bin", "text"), "order_number": ("order_number", "text"),
    "shipment_number": ("shipment_number", "text"), "purchase_order": ("purchase_order", "text"),
    "goods_receipt": ("goods_receipt", "text"), "operator_id": ("operator_id", "text"),
    "operator_name": ("operator_name", "text"), "equipment_id": ("equipment_id", "text"),
    "quality_status": ("quality_status", "text"), "stock_condition": ("stock_condition", "text"),
    "inspection_required": ("inspection_flag", "flag"),
    "exception_reason": ("exception_reason", "text"),
}


def extract_warehouse_flat(raw: DataFrame) -> DataFrame:
    """Movements from payloads without segments, with processing minutes and exception flag."""
    started = moment(_control("credat"), _control("cretim"))
    done = moment(field(C("_f"), "completed_time"))
    flagged = (F.coalesce(field(C("_f"), "exception_flag") == "X", F.lit(False))
               | F.coalesce(_control("status") != "03", F.lit(True)))
    return _flat(raw, "WHSCON", FLAT_MOVEMENT, "completed_time", "exception_flag",
                 control="docnum status credat cretim").select(
        _control("docnum").alias("movement_id"), started.alias("movement_timestamp"),
        _control("status").alias("movement_status"), *columns(take(C("_f"), FLAT_MOVEMENT)),
        diff_boundary("minute", done, started).alias("processing_time_minutes"),
        flagged.alias("exception_flag"), *_meta(), C("control").alias("raw_control"),
        C("data").alias("raw_data"))


HEAD_MOVEMENT = {
    "confirmation_number": ("confno", "text"), "warehouse_id": ("lgnum", "text"),
    "warehouse_partner_id": ("warehouse_partner_id", "text"),
    "warehouse_partner_name": ("warehouse_partner_name", "text"),
    "movement_type": ("whstype", "text"), "reference_document": ("refdoc", "text"),
    "movement_status": ("status", "text"), "operator_id": ("usnam", "text"),
}


def _movement_time() -> Column:
    h = head("E1WHC00")
    return moment(field(h, "confdat"), field(h, "conftim"))


def extract_warehouse_header(raw: DataFrame) -> DataFrame:
    """Movements with partner columns, from the header segment only."""
    h = head("E1WHC00")
    return _of(raw, "WHSCON", E1WHC00=f"{_paths(HEAD_MOVEMENT)} matnr menge meins brgew confdat "
                                      "conftim partner_access_scope").select(
        *columns(take(h, HEAD_MOVEMENT)), field(h, "matnr").alias("material_id"),
        number(field(h, "menge"), "int").alias("quantity"),
        field(h, "meins").alias("unit_of_measure"),
        number(field(h, "brgew"), "decimal(15,3)").alias("weight_kg"),
        _movement_time().alias("movement_timestamp"),
        moment(field(h, "confdat")).alias("confirmation_date"),
        access_scope("E1WHC00").alias("partner_access_scope"), *_meta())


MOVED_ITEM = {
    "item_number": ("itemno", "text"), "material_id": ("matnr", "text"),
    "material_description": ("maktx", "text"), "batch_number": ("charg", "text"),
    "quantity": ("confqty", "quantity"), "target_quantity": ("targetqty", "quantity"),
    "quantity_variance": ("variance", "quantity"), "unit_of_measure": ("unit", "text"),
    "storage_location": ("lgort", "text"), "plant": ("werks", "text"),
    "weight_kg": ("weight", "quantity"),
}


def extract_warehouse_items(raw: DataFrame, *, keep_empty: bool = False) -> DataFrame:
    """One row per confirmed item with header, serial numbers, bins, resources and exceptions.

    Children are matched by item number inside their own message, so nothing is shuffled.
    ``keep_empty`` keeps movements without items as one row.
    """
    h = head("E1WHC00")
    base = _of(raw, "WHSCON", "E1WHC01", "E1WHC20", "E1WHC30", "E1WHC40",
               E1WHC00=f"{_paths(HEAD_MOVEMENT)} confdat conftim partner_access_scope",
               E1WHC10=f"segnam {_paths(MOVED_ITEM)} sernr lgpla nlpla lgtyp")
    moved = only("E1WHC10", "E1WHC10")
    items = (base.select("*", F.explode_outer(moved).alias("_item")) if keep_empty
             else with_items(base, moved, "_item", "_pos"))
    no = field(C("_item"), "itemno")

    def children(segment: str) -> Column:
        return F.filter(only("E1WHC10", segment), lambda s: field(s, "itemno") == no)

    def resource(kind: str) -> Column:
        return F.get(F.filter(segments("E1WHC20"), lambda s: field(s, "restype") == kind),
                     F.lit(0))

    items = items.withColumns({"_bin": F.get(children("E1WHC13"), F.lit(0)),
                               # exceptions have an array of their own
                               "_faults": F.filter(segments("E1WHC40"),
                                                   lambda s: field(s, "itemno") == no)})
    serials, bins, faults = children("E1WHC11"), C("_bin"), C("_faults")
    fault = F.get(faults, F.lit(0))
    partner = any_field((h, "warehouse_partner_id"))
    seconds = number(field(head("E1WHC01"), "duration"), "decimal(15,3)")
    return items.select(
        *columns(take(h, HEAD_MOVEMENT)), (partner != "").alias("is_partner_operated"),
        _movement_time().alias("movement_timestamp"), *columns(take(C("_item"), MOVED_ITEM)),
        F.nullif(F.array_join(F.transform(serials, lambda s: field(s, "sernr")), ","), F.lit(""))
        .alias("serial_numbers"),
        field(bins, "lgpla").alias("source_bin"),
        field(bins, "nlpla").alias("destination_bin"),
        field(bins, "lgtyp").alias("storage_type"),
        F.round(seconds / 60, 2).alias("processing_time_minutes"),
        field(resource("EQUIPMENT"), "resid").alias("equipment_id"),
        number(field(resource("LABOR"), "efficiency"), "decimal(5,2)")
        .alias("productivity_score"),
        field(head("E1WHC30"), "result").alias("quality_check_result"),
        (F.size(faults) > 0).alias("has_exception"),
        field(fault, "excptype").alias("exception_type"),
        field(fault, "reason").alias("exception_reason"),
        access_scope("E1WHC00").alias("partner_access_scope"), *_meta())


def movements_without_items(raw: DataFrame) -> DataFrame:
    """Movements the item explosion leaves out, to be counted."""
    return _of(raw, "WHSCON", E1WHC10="segnam").filter(F.size(only("E1WHC10", "E1WHC10")) == 0).select(
        _control("docnum").alias("idoc_number"), "sap_system")


# ---------------------------------------------------------------- invoices

FLAT_INVOICE = {
    "invoice_number": ("invoice_number", "text"), "invoice_type": ("invoice_type", "text"),
    "invoice_date": ("invoice_date", "time"), "due_date": ("due_date", "time"),
    "posting_date": ("posting_date", "time"), "payment_date": ("payment_date", "time"),
    "customer_id": ("customer_id", "text"), "customer_name": ("customer_name", "text"),
    "currency": ("currency", "text"), "subtotal_amount": ("subtotal_amount", "money"),
    "tax_amount": ("tax_amount", "money"), "discount_amount": ("discount_amount", "money"),
    "shipping_charges": ("shipping_charges", "money"), "amount_paid": ("amount_paid", "money"),
    "payment_terms": ("payment_terms", "text"), "payment_method": ("payment_method", "text"),
    "payment_status": ("payment_status", "text"), "order_numbers": ("order_numbers", "text"),
    "shipment_numbers": ("shipment_numbers", "text"), "service_type": ("service_type", "text"),
    "total_line_items": ("line_items", "int"), "fiscal_year": ("fiscal_year", "int"),
    "fiscal_period": ("fiscal_period", "int"), "gross_margin_pct": ("margin_pct", "money"),
    "is_disputed": ("dispute_flag", "flag"), "dispute_reason": ("dispute_reason", "text"),
}


def extract_invoices_flat(raw: DataFrame, *, as_of, efficiency: str = "binary") -> DataFrame:
    """Invoices from payloads without segments: totals, balance, aging, efficiency.

    A missing charge counts as zero; a missing subtotal or tax leaves the total unknown.
    """
    now = as_ts(as_of)
    zero = F.lit(0).cast("decimal(18,2)")
    total = (C("subtotal_amount") + C("tax_amount") - F.coalesce("discount_amount", zero)
             + F.coalesce("shipping_charges", zero)).cast("decimal(18,2)")
    base = _flat(raw, "INVOIC", FLAT_INVOICE).select(
        _control("docnum").alias("invoice_id"), *columns(take(C("_f"), FLAT_INVOICE)), *_meta())
    base = base.withColumn("total_amount", total).withColumns({
        "amount_due": (C("total_amount") - F.coalesce("amount_paid", zero)).cast("decimal(18,2)"),
        "days_to_due": diff_boundary("day", C("due_date"), now),
        "days_overdue": diff_boundary("day", now, C("due_date"))})
    late = F.coalesce((C("days_overdue") > 0) & (first_filled(C("payment_status")) != "Paid"),
                      F.lit(False))
    return base.withColumns({
        "is_overdue": late, "aging_bucket": aging_bucket(C("days_overdue"), late),
        "payment_efficiency": payment_efficiency(C("payment_date"), C("due_date"),
                                                 C("invoice_date"), efficiency)})


HEAD_INVOICE = {
    "invoice_number": ("belnr", "text"), "invoice_type": ("bsart", "text"),
    "bill_to_customer": ("recipnt_no", "text"), "customer_id": ("customer_id", "text"),
    "customer_name": ("customer_name", "text"), "order_reference": ("order_ref", "text"),
    "delivery_reference": ("delivery_ref", "text"), "invoice_amount": ("invoice_amount", "money"),
    "tax_amount": ("tax_amount", "money"), "total_amount": ("total_amount", "money"),
    "currency": ("curcy", "text"), "payment_terms": ("zterm", "text"),
    "invoice_date": ("bldat", "time"), "due_date": ("due_date", "time"),
    "posting_date": ("posting_date", "time"), "payment_status": ("payment_status", "text"),
}


def extract_invoices_header(raw: DataFrame) -> DataFrame:
    """Invoices with partner columns, from the header segment only."""
    return _of(raw, "INVOIC", E1EDK01=f"{_paths(HEAD_INVOICE)} partner_access_scope").select(
        *columns(take(head("E1EDK01"), HEAD_INVOICE)),
        access_scope("E1EDK01").alias("partner_access_scope"), *_meta())


def extract_invoices(raw: DataFrame, *, as_of, payments: DataFrame | None = None,
                     immutable_after: int = 30) -> DataFrame:
    """Invoices from their segments: sums by kind, dates by qualifier, payments joined if given.

    ``payments`` has invoice_number, amount_paid and payment_date, one row per invoice.
    """
    now = as_ts(as_of)
    doc = head("E1EDK01")
    issued, due = pick("E1EDK03", "iddat", "012"), pick("E1EDK03", "iddat", "013")

    def amount(kind: str) -> Column:
        return number(field(pick("E1EDS01", "sumid", kind), "summe"))

    base = _of(raw, "INVOIC", "E1EDK03", "E1EDK14", "E1EDS01",
               E1EDK01="belnr bldat customer_id customer_name curcy zterm "
                       "partner_access_scope").select(
        field(doc, "belnr").alias("invoice_number"),
        F.coalesce(moment(field(issued, "datum"), field(issued, "uzeit")),
                   moment(field(doc, "bldat"))).alias("invoice_date"),
        field(doc, "customer_id").alias("customer_id"),
        field(doc, "customer_name").alias("customer_name"),
        field(pick("E1EDK14", "qualf", "001"), "orgid").alias("delivery_number"),
        amount("002").alias("subtotal_amount"), amount("011").alias("tax_amount"),
        amount("001").alias("total_amount"), field(doc, "curcy").alias("currency"),
        field(doc, "zterm").alias("payment_terms"),
        moment(field(due, "datum"), field(due, "uzeit")).alias("due_date"),
        access_scope("E1EDK01").alias("partner_access_scope"), *_meta())
    if payments is None:
        base = base.withColumns({"amount_paid": F.lit(0).cast("decimal(18,2)"),
                                 "payment_date": F.lit(None).cast("timestamp")})
    else:
        paid = payments.select("invoice_number", "amount_paid", "payment_date")
        base = base.join(paid, "invoice_number", "left").withColumn(
            "amount_paid", F.coalesce("amount_paid", F.lit(0).cast("decimal(18,2)")))
    return base.withColumns({
        "amount_due": (C("total_amount") - C("amount_paid")).cast("decimal(18,2)"),
        "payment_status": payment_status(C("total_amount"), C("amount_paid"), C("due_date"), now),
        "aging_days": F.datediff(now, "invoice_date"),
        "days_overdue": F.greatest(F.datediff(now, "due_date"), F.lit(0)),
    }).withColumns({
        "is_overdue": (C("days_overdue") > 0) & (C("payment_status") != "Paid"),
        "payment_efficiency": payment_efficiency(C("payment_date"), C("due_date")),
        "is_immutable": C("aging_days") > immutable_after,
    }).withColumn("aging_bucket", aging_bucket(C("days_overdue"), C("is_overdue")))


# ---------------------------------------------------------------- generic lab payloads

SHIPMENT_PAYLOAD = ("header struct<shipment_id:string,shipment_number:string,ship_date:string,"
                    "delivery_date:string>,customer struct<customer_id:string,"
                    "customer_name:string>,carrier struct<carrier_id:string>,"
                    "total_weight double,tracking_number string,status string")
ORDER_PAYLOAD = ("header struct<order_id:string,order_number:string,order_date:string>,"
                 "customer struct<customer_id:string>,total_value double,status string")


def extract_payload_shipments(raw: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """Shipments from nested payload text with a fixed schema."""
    p = F.from_json(payload, SHIPMENT_PAYLOAD)
    return raw.filter(C("idoc_type") == "SHPMNT").withColumn("_p", p).select(
        "_p.header.shipment_id", "_p.header.shipment_number", "_p.customer.customer_id",
        "_p.customer.customer_name", "_p.carrier.carrier_id",
        moment(C("_p.header.ship_date")).alias("ship_date"),
        moment(C("_p.header.delivery_date")).alias("delivery_date"),
        "_p.total_weight", "_p.tracking_number", "_p.status",
        C("idoc_number").alias("source_idoc_number"))


def extract_payload_orders(raw: DataFrame, payload: str = "raw_payload") -> DataFrame:
    p = F.from_json(payload, ORDER_PAYLOAD)
    return raw.filter(C("idoc_type") == "ORDERS").withColumn("_p", p).select(
        "_p.header.order_id", "_p.header.order_number", "_p.customer.customer_id",
        moment(C("_p.header.order_date")).alias("order_date"), "_p.total_value", "_p.status",
        C("idoc_number").alias("source_idoc_number"))
