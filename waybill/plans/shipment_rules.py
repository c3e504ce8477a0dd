"""Rules over the tracking events of a shipment: the order of its states, and evidence for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.operators import scans

C = F.col
# Codes of the states, in the order in which a shipment goes through them.
STEPS = {"P": "Pending Pickup", "A": "Picked Up", "B": "In Transit", "D": "Out for Delivery",
         "C": "Delivered"}
ASIDE = {"E": "Exception", "R": "Returned"}
NEW = "-"


def progression() -> scans.Machine:
    """A shipment goes forward or stays. An exception may come on the way and ends in any later
    step or in a return; what has been delivered can only come back as a return, which is final."""
    line = list(STEPS)
    steps = {(NEW, e): e for e in (*line, *ASIDE)}
    for i, s in enumerate(line):
        steps |= {(s, e): e for e in line[i:]}
        steps |= {(s, e): e for e in ASIDE if s != "C" or e == "R"}
    steps |= {("E", e): e for e in (*line[1:], *ASIDE)} | {("R", "R"): "R"}
    return scans.Machine((NEW, *line, *ASIDE), (*line, *ASIDE), steps, NEW)


def lacks_evidence(code: Column) -> Column:
    """Delivered without a delivery date, an exception without a reason, or no tracking number
    from the transit on."""
    return F.coalesce(((code == "C") & C("actual_delivery_date").isNull())
                      | ((code == "E") & C("reason_code").isNull())
                      | (code.isin("B", "D", "C") & C("tracking_number").isNull()), F.lit(False))


def _judged(events: DataFrame, size: int) -> DataFrame:
    out = scans.run(events, ["shipment_number"], ["event_time", "event_number"], "status_code",
                    progression(), size)
    return out.withColumn("state_after", F.when(C("allowed"), C("status_code"))
                          .otherwise(C("state_before")))


def judged_events(events: DataFrame, size: int = scans.SLICE) -> DataFrame:
    """Tracking events with the state each one met, whether it may follow, and whether its
    evidence is missing. ``events``: shipment_number, event_time, event_number, status_code,
    reason_code, tracking_number, actual_delivery_date."""
    return _judged(events, size).withColumn("no_evidence", lacks_evidence(C("status_code")))


def broken_rules(events: DataFrame, size: int = scans.SLICE) -> DataFrame:
    """A row a shipment: its events, those that go back, those without evidence, and its state."""
    # evidence is judged before the scan, which then moves its answer only
    judged = _judged(events.select("shipment_number", "event_time", "event_number", "status_code",
                                   lacks_evidence(C("status_code")).alias("no_evidence")), size)
    return judged.groupBy("shipment_number").agg(
        F.count("*").alias("events"), F.count_if(~C("allowed")).alias("steps_back"),
        F.count_if("no_evidence").alias("without_evidence"),
        F.max_by("state_after", F.struct("event_time", "event_number")).alias("state"))


def date_order(shipments: DataFrame, carriers: DataFrame) -> DataFrame:
    """Shipments that arrive before they leave, or whose carrier is unknown."""
    known = carriers.select("carrier_id").distinct().withColumn("known", F.lit(True))
    early = C("actual_delivery_date") < C("actual_ship_date")
    return shipments.join(known, "carrier_id", "left").select(
        "shipment_number", F.coalesce(early, F.lit(False)).alias("dates_reversed"),
        C("known").isNull().alias("carrier_unknown")).filter("dates_reversed or carrier_unknown")
