"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from waybill.session import checkpoint_dir


BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Bounds what is sent to a Python worker at once, so that a worker's memory does not follow
    the length of the texts; a single larger row still goes whole."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).rstrip("b")
    if not now.isdigit() or int(now) > size:
        spark.conf.set(name, str(size))


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a frame as a table in the shared folder and read it back.

    It cuts the lineage: a lost executor costs only the tasks that ran there, and a frame that is
    used twice is computed once.
    """
    path = folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
