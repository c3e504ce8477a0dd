"""Tables by day, kept current from sets of changed days.

A change set names the days of a table that a run changed. ``refresh`` carries it through a graph of
tables: each table recomputes the days that depend on changed days of its sources, from the source
days these need, and adds what it replaced to the change set for the tables behind it. Tables that
do not wait for each other are computed at once. Days stand for any partition by date: the start of
a month is the day of a month's table.

The log of changes is a table below ``root`` (``_changes/table=T/version=V``); each table has a mark
of the version it was last refreshed to. A run that stops, or a table that fails, leaves its mark
where it was, and the next run makes good all versions since. The driver sees days only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.operators import storage

C = F.col


def same(day: date) -> list[date]:
    return [day]


@dataclass(frozen=True)
class Daily:
    """A table by day and how it follows from others.

    ``compute`` takes one frame a source, with the days that are needed, and returns rows with the
    column ``day``. ``affects``: which days of this table depend on a day of a source;
    ``needs``: which days of the sources a day of this table is computed from.
    """

    name: str
    sources: tuple[str, ...]
    compute: Callable[..., DataFrame]
    day: str = "day"
    affects: Callable[[date], Iterable[date]] = same
    needs: Callable[[date], Iterable[date]] = same


class Changes:
    """The log of changed days, by table and version."""

    SCHEMA = T.StructType([T.StructField("day", T.DateType())])

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _at(self, kind: str, table: str, version: int | None = None) -> str:
        path = f"{self.root}/{kind}/table={table}"
        return path if version is None else f"{path}/version={version}"

    def _versions(self, kind: str, table: str) -> list[int]:
        path = self._at(kind, table)
        if not storage.exists(self.spark, path):
            return []
        return sorted(int(v) for v in storage.folders(self.spark, path, "version"))

    def declare(self, table: str, schema: T.StructType) -> None:
        """Keeps a table's columns, which an empty table cannot tell."""
        if not storage.exists(self.spark, self._at("_schema", table)):
            self.spark.createDataFrame([], schema).coalesce(1).write.parquet(
                self._at("_schema", table))

    def rows(self, table: str, day: str, wanted: set[date]) -> DataFrame:
        """The table's rows of these days; other days' folders are not opened."""
        path = f"{self.root}/{table}"
        if storage.exists(self.spark, path):
            found = storage.table(self.spark, path, day, T.DateType())
            return found.filter(C(day).isin(sorted(wanted))) if wanted else found.limit(0)
        if not storage.exists(self.spark, self._at("_schema", table)):
            raise ValueError(f"{table} has no rows and no declared columns")
        return self.spark.createDataFrame([], self.spark.read.parquet(
            self._at("_schema", table)).schema)

    def record(self, table: str, days: Iterable[date], version: int) -> None:
        rows = [(d,) for d in sorted(set(days))]
        self.spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            self._at("_changes", table, version))

    def between(self, table: str, after: int, upto: int) -> set[date]:
        """Days that changed in versions after one, up to another."""
        paths = [self._at("_changes", table, v) for v in self._versions("_changes", table)
                 if after < v <= upto]
        if not paths:
            return set()
        rows = self.spark.read.schema(self.SCHEMA).parquet(*paths).distinct().collect()
        return {r["day"] for r in rows}

    def done(self, table: str) -> int:
        return max(self._versions("_done", table), default=0)

    def mark(self, table: str, version: int) -> None:
        """The table is refreshed to this version; earlier marks go."""
        before = self._versions("_done", table)
        self.spark.createDataFrame([], self.SCHEMA).write.mode("overwrite").parquet(
            self._at("_done", table, version))
        for v in before:
            if v != version:
                storage.remove(self.spark, self._at("_done", table, v))


def refresh_one(spark: SparkSession, root: str, step: Daily, days_of: Mapping[str, str],
                version: int) -> list[date]:
    """Brings one table up to a version; returns the days it replaced."""
    log, path = Changes(spark, root), f"{root}/{step.name}"
    since = log.done(step.name)
    changed = set().union(*(log.between(s, since, version) for s in step.sources))
    days = sorted({x for d in changed for x in step.affects(d)})
    needed = {x for d in days for x in step.needs(d)}
    made = step.compute(*(log.rows(s, days_of[s], needed) for s in step.sources))
    log.declare(step.name, made.schema)
    if days:
        storage.replace_partitions(made.filter(C(step.day).isin(days)), path, step.day, days)
    log.record(step.name, days, version)
    log.mark(step.name, version)
    return days


def refresh(spark: SparkSession, root: str, graph: Sequence[Daily], sources: Mapping[str, str],
            version: int, workers: int = 8) -> dict[str, list[date] | str]:
    """Brings all tables of a graph up to a version, each as soon as its sources are.

    ``sources`` are tables below ``root`` that others write, by their day column; their changes
    are in the log already. Returns for each table the days it replaced, or why it has none: its
    own error, or the name of a source that failed.
    """
    days_of = dict(sources) | {s.name: s.day for s in graph}
    waiting, report, running = {s.name: s for s in graph}, {}, {}
    lost = [x for s in graph for x in s.sources if x not in days_of]
    if lost:
        raise ValueError(f"unknown sources {lost}")
    with ThreadPoolExecutor(workers) as pool:
        while waiting or running:
            for name, step in list(waiting.items()):
                failed = [x for x in step.sources if isinstance(report.get(x), str)]
                if failed:
                    report[name] = f"not refreshed: {failed[0]} failed"
                    del waiting[name]
                elif all(x in sources or x in report for x in step.sources):
                    future: Future = pool.submit(refresh_one, spark, root, step, days_of, version)
                    running[future] = name
                    del waiting[name]
            if not running:
                if waiting and not any(s.sources and all(
                        x in sources or x in report for x in s.sources) for s in waiting.values()):
                    raise ValueError(f"tables depend on each other: {sorted(waiting)}")
                continue
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                error = future.exception()
                report[running.pop(future)] = f"failed: {error}" if error else future.result()
    return {s.name: report[s.name] for s in graph}
