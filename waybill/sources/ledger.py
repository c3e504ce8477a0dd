"""What has been loaded from a partitioned log: offset intervals, a partition at a time.

A message is known by its log's partition and its offset there. The ledger is a table of intervals
(partition, first, last, batch_id); a load takes in only messages whose offset lies in none of them,
so a file that comes again adds nothing, and enters the merged intervals of what it took. The
report merges all intervals and names the gaps between them.

Offsets are dealt into stretches of ``STRETCH``: runs are found within a stretch and then joined
over its edges, so that a partition with most of all messages is as many tasks as it has stretches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waybill.operators import storage

C = F.col
STRETCH = 1 << 20
ENTRY = "partition int, first bigint, last bigint"


def _stretch(offset: Column, size: int) -> Column:
    return F.floor(offset / size).cast("bigint")


def intervals(messages: DataFrame, size: int = STRETCH) -> DataFrame:
    """(partition, first, last) of the runs of offsets; ``messages``: partition, offset. An offset
    that comes twice counts once."""
    rows = messages.select("partition", C("offset").cast("bigint").alias("offset")).filter(
        "partition is not null and offset is not null").distinct()
    inside = Window.partitionBy("partition", "_s").orderBy("offset")
    runs = rows.withColumn("_s", _stretch(C("offset"), size)).withColumn(
        "_run", C("offset") - F.row_number().over(inside)).groupBy("partition", "_s", "_run").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"))
    return merged(runs.select("partition", "first", "last"))


def merged(entries: DataFrame) -> DataFrame:
    """Intervals that touch or overlap become one."""
    order = Window.partitionBy("partition").orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(C("first") <= reach + 1, 0).otherwise(1)
    return entries.withColumn("_new", begins).withColumn(
        "_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy(
        "partition", "_run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop(
        "_run")


def read(spark: SparkSession, path: str) -> DataFrame:
    schema = f"{ENTRY}, batch_day date, batch_id bigint"
    if not storage.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def unseen(messages: DataFrame, entries: DataFrame, size: int = STRETCH) -> DataFrame:
    """Messages whose offset lies in no interval; of several with one offset, one. Messages without
    partition or offset cannot be told apart and are left out."""
    held = merged(entries.select("partition", "first", "last"))
    spread = held.select("partition", "first", "last", F.explode(F.sequence(
        _stretch(C("first"), size), _stretch(C("last"), size))).alias("_s"))
    rows = messages.filter("partition is not null and offset is not null").withColumn(
        "_s", _stretch(C("offset"), size)).alias("m")
    k = spread.alias("k")
    seen = ((C("m.partition") == C("k.partition")) & (C("m._s") == C("k._s"))
            & C("m.offset").between(C("k.first"), C("k.last")))
    return rows.join(k, seen, "left_anti").drop("_s").dropDuplicates(["partition", "offset"])


def load(messages: DataFrame, ledger: str, target: str, batch_id: int, day) -> int:  # noqa: ANN001
    """Adds the messages that the ledger does not know to the target; returns their number.

    A batch that is repeated replaces its own rows and entries: those of a first attempt do not
    count as known.
    """
    spark = messages.sparkSession
    others = read(spark, ledger).filter(C("batch_id") != batch_id)
    with storage.staged(unseen(messages, others), target) as new:
        storage.replace_batch(new, target, batch_id, day)
        storage.replace_batch(intervals(new), ledger, batch_id, day)
        return new.count()


def report(entries: DataFrame) -> DataFrame:
    """The merged intervals of each partition, with the offsets missing before each of them."""
    order = Window.partitionBy("partition").orderBy("first")
    whole = merged(entries.select("partition", "first", "last"))
    before = F.lag("last").over(order)
    return whole.select("partition", "first", "last", (C("last") - C("first") + 1).alias("messages"),
                        F.coalesce(C("first") - before - 1, F.lit(0)).alias("gap_before"))


def overlaps(entries: DataFrame) -> DataFrame:
    """Offsets a partition that more than one entry holds: none, as long as loads use the ledger."""
    length = F.sum(C("last") - C("first") + 1)
    held = entries.groupBy("partition").agg(length.alias("entered"))
    whole = merged(entries.select("partition", "first", "last")).groupBy("partition").agg(
        length.alias("covered"))
    return held.join(whole, "partition").filter(C("entered") > C("covered")).select(
        "partition", (C("entered") - C("covered")).alias("overlapping"))
