"""Structured Streaming jobs. Each takes a streaming frame and returns a frame or a started query.

All sinks are idempotent: a batch that runs twice leaves the same tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from waybill.functions import diff_boundary, pct
from waybill.operators import buckets, storage
from waybill.operators.rows import dedupe_latest, dedupe_repeated, repeated_keys
from waybill.operators.state_file import StateFile

C = F.col


def start(df: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str,
          available_now: bool, every: str | None = None) -> StreamingQuery:
    """``every``: how often a batch begins, unless it takes all there is and ends."""
    writer = df.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


# ---------------------------------------------------------------- bronze to silver

@dataclass(frozen=True)
class Route:
    """How one kind of message becomes a silver table.

    ``version`` orders several versions of one key; the latest one is stored. ``moves=False``
    promises that a key keeps its day, which spares the search of other days.
    """

    extract: Callable[[DataFrame], DataFrame]
    path: str
    keys: tuple[str, ...]
    version: str
    day: str
    moves: bool = True


def to_silver(bronze: DataFrame, routes: Mapping[tuple[str, ...], Route], checkpoint: str, *,
              quarantine: str | None = None, as_of=None,
              available_now: bool = True) -> StreamingQuery:
    """Routes each batch by message type into its silver tables by keyed upsert.

    A re-delivered batch finds its rows already stored and replaces them by themselves. Rows
    without key go to ``quarantine``. A table keeps a newer version it already has.
    """
    def batch(rows: DataFrame, batch_id: int) -> None:
        # nothing of the batch is cached: whole messages of a large batch outgrow the executors.
        # Its last time is noted while the first route reads it
        seen = Observation()
        newest_at = None
        for i, (kinds, route) in enumerate(routes.items()):
            read = rows if i else rows.observe(seen, F.max("timestamp").alias("newest_at"))
            found = route.extract(read.filter(C("message_type").isin(*kinds)))
            bad = F.lit(False)
            for k in route.keys:
                bad = bad | C(k).isNull() | (C(k) == "")
            now = F.current_timestamp() if as_of is None else as_of
            # extracted once: rejects and good rows are both read from the staged table
            with storage.staged(found.withColumn("silver_day", F.to_date(route.day)),
                                route.path) as stamp:
                newest_at = newest_at if i else seen.get["newest_at"]
                if newest_at is None:
                    return
                good, rejected = storage.split(stamp, bad, "key is missing", as_of=now)
                if quarantine:
                    # a repeated batch replaces its own rejects
                    storage.replace_batch(rejected, f"{quarantine}/{'_'.join(kinds)}",
                                          batch_id, newest_at.date())
                keys = list(route.keys)
                # rows of a key that came once are packed at once, not dealt by key before
                with storage.staged(repeated_keys(good, keys), route.path) as repeated:
                    newest = dedupe_repeated(good, repeated, keys, [route.version])
                    storage.upsert(newest, route.path, route.keys, "silver_day",
                                   version=route.version, moves=route.moves)

    def freeing(rows: DataFrame, batch_id: int) -> None:
        with storage.freed_shuffles(rows.sparkSession):
            batch(rows, batch_id)

    return start(bronze, freeing, checkpoint, available_now)


def deduplicated(stream: DataFrame, keys: tuple[str, ...] = ("sap_system", "docnum"),
                 ts: str = "timestamp", delay: str = "1 hour") -> DataFrame:
    """First row of each key; keys are remembered for the watermark delay only."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


# ---------------------------------------------------------------- gold

def refresh_gold(stream: DataFrame, silver: str, compute: Callable[[DataFrame], DataFrame],
                 target: str, day: str, partition: str, checkpoint: str, *,
                 available_now: bool = True) -> StreamingQuery:
    """Keeps a daily table current: the days a batch touches are computed anew from silver.

    Recomputing whole days also removes groups that no longer exist.
    """
    def batch(rows: DataFrame, _id: int) -> None:
        spark = rows.sparkSession
        days = storage.partition_values(rows.select(F.to_date(day).alias("_d")), "_d")
        days = [d for d in days if d is not None]
        if days:
            storage.refresh(compute, spark.read.parquet(silver), target, day, partition, days)

    return start(stream, batch, checkpoint, available_now)


# ---------------------------------------------------------------- windows

def tumbling_counts(stream: DataFrame, width: str = "5 minutes", ts: str = "timestamp",
                    by: tuple[str, ...] = ("message_type",), delay: str = "10 minutes"
                    ) -> DataFrame:
    """Message count per window and key, emitted once the watermark has passed the window."""
    counted = stream.withWatermark(ts, delay).groupBy(F.window(ts, width), *by).agg(
        F.count("*").alias("messages"))
    return counted.select(C("window.start").alias("window_start"),
                          C("window.end").alias("window_end"), *by, "messages")


def late_report(raw: DataFrame, limits: tuple[int, ...] = (30, 300)) -> DataFrame:
    """Share of messages later than each limit (seconds), per type, from the raw table.

    Windows drop rows behind the watermark; this counts them from where nothing is dropped.
    """
    lag = diff_boundary("second", C("ingestion_time"), C("timestamp"))
    cells = [pct(F.count_if(lag > s), F.count("*")).alias(f"late_{s}s_pct") for s in limits]
    return raw.groupBy("message_type").agg(F.count("*").alias("messages"),
                                           F.max(lag).alias("max_latency"), *cells)


def silences(stream: DataFrame, minutes: int = 10, ts: str = "timestamp",
             delay: str = "1 minute") -> DataFrame:
    """One row per silence: a system sent nothing for more than ``minutes`` of event time.

    A session of messages ends where the silence begins, and is emitted once the watermark has
    passed the limit after its last message. State is one row per open session.
    """
    gap = f"{minutes} minutes 1 millisecond"
    sessions = stream.withWatermark(ts, delay).groupBy(
        "sap_system", F.session_window(ts, gap)).agg(F.max(ts).alias("silent_from"))
    return sessions.select("sap_system", "silent_from")


def enriched(stream: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Stream joined to a static table; rows without a match are kept.

    Whether the table is broadcast follows from its size.
    """
    return stream.join(dimension, key, "left")


# ---------------------------------------------------------------- state

class BucketedState:
    """A table with one row a key, in hash buckets whose number follows the rows.

    A key's bucket is its address by linear hashing, so a larger table divides a few buckets and
    leaves the others as they are. Rows are counted (from the files' footers) only when those
    written since the last count could fill the buckets. A division that stopped is done again.
    """

    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...], least: int,
                 size: int) -> None:
        self.spark, self.path, self.keys = spark, path, keys
        self.least, self.size = least, size
        self.file = StateFile(spark, f"{path.rstrip('/')}__buckets")

    def _bucket(self, n: int) -> Column:
        return buckets.address(buckets.hash_of(self.keys), n)

    def upsert(self, rows: DataFrame, version: str) -> None:
        state = self.file.read() or {"buckets": self.least, "rows": 0, "next": None}
        if state["next"]:
            state = self._divide(state)
        # a key never changes its bucket but by a division, so only the batch's buckets are opened
        storage.upsert(rows.withColumn("bucket", self._bucket(state["buckets"])), self.path,
                       self.keys, "bucket", version=version, moves=False)
        state["rows"] += rows.count()
        if state["rows"] > state["buckets"] * self.size:
            state["rows"] = storage.table(self.spark, self.path, "bucket").count()
            state["next"] = buckets.enough(state["rows"], self.size, state["buckets"])
        self.file.write(state)
        if state["next"]:
            self._divide(state)

    def _divide(self, state: dict) -> dict:
        old, new = state["buckets"], state["next"]
        if new > old:
            sources = buckets.divided(old, new)
            held = storage.table(self.spark, self.path, "bucket", T.IntegerType())
            # rows that an earlier attempt has moved are among the new buckets
            some = held.filter(C("bucket").isin([*sources, *range(old, new)]))
            storage.replace_partitions(some.withColumn("bucket", self._bucket(new)), self.path,
                                       "bucket", sources)
        state = state | {"buckets": max(old, new), "next": None}
        self.file.write(state)
        return state


def latest_state(stream: DataFrame, target: str, checkpoint: str,
                 keys: tuple[str, ...] = ("shipment_number",), version: str = "event_time",
                 buckets: int = 64, size: int = 1_000_000,
                 available_now: bool = True) -> StreamingQuery:
    """Current state per key: the row with the latest event wins, also across batches.

    The table begins with ``buckets`` hash buckets and gets more as it grows, about ``size`` rows
    each; a batch rewrites only the buckets it touches.
    """
    def batch(rows: DataFrame, _id: int) -> None:
        state = BucketedState(rows.sparkSession, target, tuple(keys), buckets, size)
        newest = dedupe_latest(rows.filter(C(version).isNotNull()), list(keys), [version])
        with storage.staged(newest, target) as held:
            state.upsert(held, version)

    return start(stream, batch, checkpoint, available_now)
