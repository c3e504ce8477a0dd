"""Column helpers over message payloads held as VARIANT.

A segment may come as an object or as an array of objects, and child segments may be mixed into
their parent's array; ``segments`` and ``pick`` hide both.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.scalars import first_filled

C = F.col


# Fields read from each segment and from the control record.
SEGMENT_FIELDS = {
    "E1EDK01": "belnr bldat bsart curcy zterm ntgew brgew volum vsart traid ablad vsbed "
               "recipnt_no carrier_id carrier_name customer_id customer_name "
               "partner_access_scope delivery_date confirmed_delivery order_status "
               "fulfillment_status total_value total_quantity total_weight item_count order_ref "
               "delivery_ref invoice_amount tax_amount total_amount due_date posting_date "
               "payment_status",
    "E1EDK03": "iddat datum uzeit",
    "E1EDK14": "qualf orgid",
    "E1EDKA1": "parvw name1 stras ort01 regio pstlz land1",
    "E1EDL20": "segnam posex matnr arktx lfimg vrkme ntgew volum vgbel",
    "E1EDL24": "posnr charg lfimg",
    "E1EDL37": "vhilm",
    "E1EDP01": "segnam posex matnr arktx menge menee vprei netwr werks",
    "E1EDS01": "sumid summe",
    "E1SHP00": "tknum vsart vsbed tdlnr signi shpsts datbg uatbg daten uaten order_id "
               "delivery_id origin_warehouse destination_city carrier_id carrier_name "
               "customer_id customer_name partner_access_scope planned_ship_date "
               "actual_ship_date planned_delivery_date estimated_delivery "
               "actual_delivery_date current_location package_count total_weight total_volume",
    "E1SHP01": "vbeln lifex",
    "E1SHP02": "parvw parnr ort01",
    "E1SHP10": "tsrfo tstyp tsdat tsuhr tsrst tstxt tsloc",
    "E1WHC00": "confno lgnum whstype refdoc status confdat conftim usnam warehouse_partner_id "
               "warehouse_partner_name partner_access_scope matnr menge meins brgew",
    "E1WHC01": "duration",
    "E1WHC10": "segnam itemno matnr maktx charg confqty targetqty variance unit lgort werks "
               "weight sernr lgpla nlpla lgtyp",
    "E1WHC20": "restype resid efficiency",
    "E1WHC30": "result",
    "E1WHC40": "itemno excptype reason",
}
CONTROL_FIELDS = "docnum status direct sndprn rcvprn credat cretim idoctyp mestyp"


def _struct(names: str) -> str:
    return "struct<" + ",".join(f"{n}:string" for n in names.split()) + ">"


def _entries(name: str, fields: str) -> Column:
    """Entries of a segment as an array of structs; empty when the segment is missing."""
    kind = _struct(fields)
    one = F.try_variant_get("_d", f"$.{name}", kind)
    many = F.try_variant_get("_d", f"$.{name}", f"array<{kind}>")
    none = F.array().cast(f"array<{kind}>")
    return F.coalesce(many, F.when(one.isNotNull(), F.array(one)), none)


def control_record(names: str) -> Column:
    """The named fields of the control record, from its VARIANT (``_cv``)."""
    return F.try_variant_get("_cv", "$", _struct(names))


def parsed(raw: DataFrame, *names: str, control: str = CONTROL_FIELDS,
           **fields: str) -> DataFrame:
    """Adds the control record (``_c``), the payload as VARIANT (``_d``) and the named segments.

    A segment is converted to an array of structs in one step, and its first entry becomes a
    column of its own, so reading a field costs no further search in the payload. Bad JSON gives
    null. Every field that is converted costs time in every message: ``fields`` names the segments
    of which only some are read, and these; ``control`` the fields of the control record.
    """
    wanted = {n: SEGMENT_FIELDS[n] for n in names} | fields
    out = raw.withColumns({"_cv": F.try_parse_json("control"), "_d": F.try_parse_json("data")})
    out = out.withColumns({
        "_c": control_record(control),
        **{f"_s_{n}": _entries(n, of) for n, of in wanted.items()}})
    return out.withColumns({f"_h_{n}": F.get(f"_s_{n}", F.lit(0)) for n in wanted})


def with_flat(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Adds ``_f``: the named top-level fields of a payload without segments."""
    return df.withColumn("_f", F.try_variant_get("_d", "$", _struct(" ".join(dict.fromkeys(names)))))


def segments(name: str) -> Column:
    """All entries of a segment named in ``parsed``."""
    return C(f"_s_{name}")


def head(name: str) -> Column:
    """First entry of a segment named in ``parsed``."""
    return C(f"_h_{name}")


def field(entry: Column, name: str) -> Column:
    """One field as text; null when the entry or the field is missing."""
    return entry.getField(name)


def pick(name: str, key: str, value: str) -> Column:
    """First entry of a segment whose ``key`` has ``value``."""
    return F.get(F.filter(segments(name), lambda s: field(s, key) == value), F.lit(0))


def only(name: str, segment: str) -> Column:
    """Entries of one kind from an array that mixes a segment with its children."""
    return F.filter(segments(name), lambda s: field(s, "segnam") == segment)


def with_items(df: DataFrame, items: Column, name: str, position: str = "position") -> DataFrame:
    """One row per entry of an array, as ``name``, with its place from 0 as ``position``.

    Rows without entries go after the explosion. An inner explosion makes Spark filter by the
    array's size before it, and that filter, pushed down to the source and into its joins, makes
    and parses the payload there again.
    """
    kept = [C(c) for c in df.columns]
    out = df.select(*kept, F.posexplode_outer(items).alias(position, name))
    return out.filter(C(position).isNotNull())


def number(text: Column, kind: str = "decimal(18,2)") -> Column:
    return F.nullif(F.trim(text), F.lit("")).try_cast(kind)


def whole(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit("")).try_cast("decimal(18,3)").try_cast("int")


def moment(date: Column, time: Column | None = None) -> Column:
    """Timestamp from yyyyMMdd with optional HHmmss, or from ISO text; bad text gives null."""
    clock = F.coalesce(F.nullif(time, F.lit("")), F.lit("000000")) if time is not None \
        else F.lit("000000")
    size = F.length(date)
    joined = F.when(size == 8, F.concat(date, clock)).when(size == 14, date)
    return F.coalesce(F.try_to_timestamp(joined, F.lit("yyyyMMddHHmmss")),
                      date.try_cast("timestamp"))


CONVERT = {
    "text": lambda c: c,
    "money": number,
    "quantity": lambda c: number(c, "decimal(15,3)"),
    "int": whole,
    "time": moment,
    "flag": lambda c: F.coalesce(c == "X", F.lit(False)),
}


def take(entry: Column, spec: Mapping[str, tuple[str, str]]) -> dict[str, Column]:
    """Columns from one entry: name -> (field, kind), kinds as in ``CONVERT``."""
    return {name: CONVERT[kind](field(entry, path)) for name, (path, kind) in spec.items()}


def columns(cells: Mapping[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in cells.items()]


def any_field(*sources: tuple[Column, str], default: str | None = "") -> Column:
    """First non-empty field among (entry, name) pairs."""
    return first_filled(*[field(e, n) for e, n in sources], default=default)
