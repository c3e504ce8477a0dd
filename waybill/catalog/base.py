"""Registration of queries with their SQL counterpart."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.catalog.views_sql import with_views
from waybill.session import checkpoint_dir
from waybill.sources.driver_tables import StoredTables, Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a function of ``Tables`` under ``name``, with SQL over ``views``."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = with_views(views, sql)
        return fn

    return add


def present(df: DataFrame) -> DataFrame:
    """Plain column types for comparison: decimals as doubles, dates and times as text."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        out.append(c.alias(field.name))
    return df.select(*out)


_TABLES: dict[tuple[str, int, str], Tables] = {}


def tables_of(spark: SparkSession, folder: str) -> Tables:
    """The frames of a folder; they are lazy, so queries of one session share their plans."""
    key = (spark.sparkContext.applicationId, id(spark), folder)
    if key not in _TABLES:
        _TABLES[key] = Tables(spark, folder)
    return _TABLES[key]


_STORED: dict[tuple, StoredTables] = {}


def stored(t: Tables, columns: Mapping[str, Sequence[str]] | None = None) -> StoredTables:
    """The same tables with silver stored; written once a session, into the job folder. ``columns``
    names those of each table that are read, where the others need not be stored."""
    key = (t.spark.sparkContext.applicationId, id(t.spark), t.folder,
           tuple((columns or {}).items()))
    if key not in _STORED:
        path = f"{checkpoint_dir(t.spark)}/waybill/silver-{uuid.uuid4().hex}"
        _STORED[key] = StoredTables(t.spark, t.folder, path, columns, as_of=t.as_of,
                                    message_as_of=t.message_as_of)
    return _STORED[key]


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(QUERIES[name](tables_of(spark, sf_dir)))

    run.__name__ = name
    return run
