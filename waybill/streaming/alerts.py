"""Threshold and silence alerts, kept current by every batch, with or without messages.

A heartbeat runs beside the messages: rows that only tell the time. So batches go on when nothing
is sent any more, and silence, of one system or of all, is noticed by the clock.

No batch reads the raw table. What the checks need is kept in ``state``, by batch:

* ``ticks/hour=H/batch_id=N``: messages by time, latency and failure, counted; the last hour is
  read from one or two hours' folders, and hours older than eight days are dropped;
* ``hours/day=D/batch_id=N``: messages an hour, for the week's mean;
* ``systems/batch_id=N``: when each system was heard last, one row a system, after batch N, and for
  which of its silences an alert was raised.

A repeated batch starts from what its predecessor left and replaces its own rows, so it raises the
same alerts again in the same place.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waybill.functions import bin_floor, diff_boundary, ratio
from waybill.operators import storage
from waybill.plans import messages
from waybill.streaming.jobs import start

C = F.col
KEEP_DAYS = 8
MOST_BATCHES = 64
TICK = "timestamp timestamp, s bigint, n bigint, bad bigint"
HOUR = "bin timestamp, total bigint"
HEARD = "kind string, sap_system string, last timestamp, raised timestamp"
SYSTEM, ALL, CLOCK = "system", "all", "clock"


def heartbeat(spark: SparkSession) -> DataFrame:
    """One row a second with the time of the clock."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load().select("timestamp")


def _hour(ts):  # noqa: ANN001, ANN202
    return F.date_format(ts, "yyyy-MM-dd-HH")


def _ticks(spark: SparkSession, state: str, first, last) -> DataFrame:  # noqa: ANN001
    """Ticks of the hours from one time to another; other hours' folders are not opened."""
    schema = f"{TICK}, hour string, batch_id bigint"
    if not storage.exists(spark, f"{state}/ticks"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{state}/ticks").filter(
        C("hour").between(first.strftime("%Y-%m-%d-%H"), last.strftime("%Y-%m-%d-%H")))


def _heard(spark: SparkSession, state: str, batch_id: int) -> DataFrame:
    """What the batch before left; older ones go."""
    held = storage.folders(spark, f"{state}/systems", "batch_id") if storage.exists(
        spark, f"{state}/systems") else {}
    before = sorted((int(n) for n in held if int(n) < batch_id), reverse=True)
    for n in before[1:]:
        storage.remove(spark, held[str(n)])
    if not before:
        return spark.createDataFrame([], HEARD)
    return spark.read.schema(HEARD).parquet(held[str(before[0])])


def alert_stream(stream: DataFrame, state: str, target: str, checkpoint: str, *,
                 beats: DataFrame | None = None, each_system: bool = False,
                 silence_minutes: int = 10, available_now: bool = True, every: str = "10 seconds",
                 **limits: int) -> StreamingQuery:
    """Alerts of every batch: volume, errors and latency of the last hour where it holds messages,
    and silences that have become too long, each once.

    ``stream``: messages with timestamp, ingestion_time, sap_system and control. ``beats``: a
    stream of times (``heartbeat`` in operation); without it, time is that of the newest message.
    With ``each_system`` a system that is silent while others send raises an alert, too. Every
    silence is known by the time of the last message before it.
    """
    rows = stream.select("timestamp", messages.latency().alias("s"), "sap_system",
                         messages.failed_status().alias("failed"), F.lit(False).alias("beat"))
    if beats is not None:
        rows = rows.unionByName(beats.select("timestamp", F.lit(True).alias("beat")),
                                allowMissingColumns=True)

    def batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        with storage.staged(df, f"{state}/batch") as now_in:
            sent = now_in.filter(~C("beat"))
            seen = now_in.agg(F.max("timestamp").alias("last"), F.count_if(~C("beat")).alias("n"))
            newest, n = seen.first()
            if newest is None:
                return
            heard = _heard(spark, state, batch_id)
            last = [sent.groupBy(F.lit(SYSTEM).alias("kind"), "sap_system").agg(
                        F.max("timestamp").alias("last")),
                    sent.agg(F.lit(ALL).alias("kind"), F.lit(None).cast("string")
                             .alias("sap_system"), F.max("timestamp").alias("last")),
                    now_in.agg(F.lit(CLOCK).alias("kind"), F.lit(None).cast("string")
                               .alias("sap_system"), F.max("timestamp").alias("last"))]
            for part in last:
                heard = heard.unionByName(part, allowMissingColumns=True)
            heard = heard.groupBy("kind", "sap_system").agg(F.max("last").alias("last"),
                                                            F.max("raised").alias("raised"))
            with storage.staged(heard, f"{state}/heard") as known:
                clock = known.filter(C("kind") == CLOCK).first()["last"]
                silent = diff_boundary("minute", F.lit(clock), C("last"))
                due = (C("kind") != CLOCK) & C("last").isNotNull() & (
                    silent > silence_minutes) & (C("raised").isNull() | (C("raised") < C("last")))
                found = known.filter(due & (F.lit(each_system) | (C("kind") == ALL))).select(
                    F.lit("Silence").alias("type"), F.lit("Prolonged Silence").alias("alert"),
                    silent.cast("double").alias("value"),
                    F.lit(float(silence_minutes)).alias("threshold"), "sap_system")
                if n:
                    _count(sent, state, batch_id)
                    found = found.unionByName(_checked(spark, state, clock, limits),
                                              allowMissingColumns=True)
                storage.replace_batch(found.withColumn("alerted_at", F.lit(clock)), target, batch_id,
                                      clock.date())
                known.withColumn("raised", F.when(due, C("last")).otherwise(C("raised"))).write.mode(
                    "overwrite").parquet(f"{state}/systems/batch_id={batch_id}")
            _tidy(spark, state, batch_id, clock)

    return start(rows, batch, checkpoint, available_now, every)


def _count(sent: DataFrame, state: str, batch_id: int) -> None:
    """Enters a batch's messages into ticks and hours."""
    ticks = sent.groupBy("timestamp", "s").agg(F.count("*").alias("n"),
                                               F.count_if("failed").alias("bad"))
    storage.replace_batch(ticks.withColumn("hour", _hour("timestamp")), f"{state}/ticks", batch_id,
                          by="hour")
    hours = sent.groupBy(bin_floor(C("timestamp"), 3600).alias("bin")).agg(
        F.count("*").alias("total"))
    storage.replace_batch(hours.withColumn("day", F.to_date("bin")), f"{state}/hours", batch_id,
                          by="day")


def _checked(spark: SparkSession, state: str, clock, limits: dict[str, int]) -> DataFrame:  # noqa: ANN001
    """Alerts of the hour before ``clock`` against the week before it."""
    hour_ago, week_ago = clock - timedelta(hours=1), clock - timedelta(days=7)
    counts = _ticks(spark, state, hour_ago, clock).filter(C("timestamp") > F.lit(hour_ago)).groupBy(
        "s").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    # whole hours are summed; of the hour in which the week begins only its later part counts
    week = F.lit(week_ago)
    first = _ticks(spark, state, week_ago, week_ago).filter(C("timestamp") > week).select(
        bin_floor(C("timestamp"), 3600).alias("bin"), C("n").alias("total"))
    whole = spark.read.schema(f"{HOUR}, day date, batch_id bigint").parquet(f"{state}/hours").filter(
        (C("day") >= F.to_date(week)) & (C("bin") > week)).select("bin", "total")
    mean = first.union(whole).groupBy("bin").agg(F.sum("total").alias("total")).agg(
        ratio(F.sum("total"), F.count("total"), 4)).scalar()
    return messages.thresholds(counts, mean, **limits).filter(C("alert") != "Normal")


def _tidy(spark: SparkSession, state: str, batch_id: int, clock) -> None:  # noqa: ANN001
    """Drops what is too old to be asked for and joins the small folders of earlier batches."""
    least = (clock - timedelta(days=KEEP_DAYS)).strftime("%Y-%m-%d-%H")
    for name, by, schema in (("ticks", "hour", TICK), ("hours", "day", HOUR)):
        path = f"{state}/{name}"
        if storage.exists(spark, path):
            for value, where in storage.folders(spark, path, by).items():
                if value < least[:len(value)]:
                    storage.remove(spark, where)
            storage.merge_batches(spark, path, storage.schema_of(schema), batch_id, MOST_BATCHES,
                                  by)
