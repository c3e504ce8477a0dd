"""Raw message table: JSON files in, append-only Parquet by day out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from waybill.functions import as_ts
from waybill.functions.payload import moment

C = F.col

# The envelope as it arrives. Objects read as text, so any payload passes through unchanged.
ENVELOPE = T.StructType([T.StructField(n, T.StringType()) for n in (
    "idoc_type", "message_type", "sap_system", "timestamp", "control", "data", "message_id",
    "sap_client")])

# Columns filled from JSON paths of the control record and the envelope.
PATHS = {
    "docnum": "$.docnum", "status": "$.status", "direction": "$.direct", "sender": "$.sndprn",
    "receiver": "$.rcvprn", "created_date": "$.credat", "created_time": "$.cretim",
}


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).json(path)


def stream_files(spark: SparkSession, path: str, files_per_trigger: int | None = None
                 ) -> DataFrame:
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def to_bronze(messages: DataFrame, paths: Mapping[str, str] = PATHS, *,
              ingested_at=None) -> DataFrame:
    """Raw table columns: envelope, mapped control fields, load time, source file and day."""
    loaded = F.current_timestamp() if ingested_at is None else as_ts(ingested_at)
    return messages.select(
        "idoc_type", "message_type", "sap_system", moment(C("timestamp")).alias("timestamp"),
        "control", "data", "message_id", "sap_client",
        *[F.get_json_object("control", p).alias(n) for n, p in paths.items()],
        loaded.alias("ingestion_time"), C("_metadata.file_name").alias("source_file"),
    ).withColumn("ingest_day", F.to_date(F.coalesce("timestamp", "ingestion_time")))


def land(messages: DataFrame, target: str, checkpoint: str, *, ingested_at=None,
         available_now: bool = True) -> StreamingQuery:
    """Appends a message stream to the raw table; the checkpoint makes files load once."""
    writer = (to_bronze(messages, ingested_at=ingested_at).writeStream.format("parquet")
              .option("path", target).option("checkpointLocation", checkpoint)
              .partitionBy("ingest_day").outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def analytic(bronze: DataFrame) -> DataFrame:
    """The view message analytics expects: ``control`` as a struct with the mapped fields."""
    return bronze.withColumn("control", F.struct(
        C("docnum"), C("status"), C("created_date").alias("credat")))


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Table by name, or Parquet folder by path."""
    return spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)


def newer_rows(source: DataFrame, target: DataFrame | None, ts: str = "timestamp",
               target_ts: str | None = None, backfill_days: int = 0, *, as_of=None) -> DataFrame:
    """Rows later than the latest one already in ``target``; all rows when that is empty.

    ``backfill_days`` reaches back that far from ``as_of`` whatever the target holds. The mark is
    a scalar subquery, so it reaches the scan as a filter.
    """
    if backfill_days:
        return source.filter(C(ts) >= F.date_sub(F.to_date(as_ts(as_of)), backfill_days))
    if target is None:
        return source
    mark = target.agg(F.max(target_ts or ts)).scalar()
    floor = F.lit("0001-01-01 00:00:00").cast("timestamp")
    return source.filter(C(ts) > F.coalesce(mark, floor))
