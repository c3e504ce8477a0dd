"""Partitioned Parquet tables: create, upsert, refresh, quarantine, compaction.

One writer per table. Rewrites use dynamic partition overwrite: Spark writes the new files aside
and moves whole partitions into place when the job commits, so a lost executor or a failed job
leaves the old partitions as they were, and the job may read the table it replaces. A whole table
is written aside, too, and swapped in when it is complete.

Where partitions are removed or rewritten, their column is read with a declared type, never with
an inferred one: a folder ``007`` must not come back as ``7``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date, datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.functions import as_ts
from waybill.operators import clustering
from waybill.operators.key_index import KeyIndex, forget
from waybill.session import checkpoint_dir

C = F.col


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the table holds any file or partition; marker files do not count."""
    fs, p = _fs(spark, path)
    return fs.exists(p) and any(not f.getPath().getName().startswith(("_", "."))
                                for f in fs.listStatus(p))


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _packed(df: DataFrame, partition: str | None) -> DataFrame:
    """Brings the rows of a partition together, so it gets few files.

    The rebalance hint lets adaptive execution split a partition that holds much of the data and
    merge small ones, where a plain repartition would put each into one task.
    """
    return df.hint("rebalance", C(partition)) if partition else df


def create_or_replace(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Replaces the whole table; ``df`` may read the table itself.

    The new table is written aside. Only when it is complete the old folder is renamed, the new
    one takes its place, and the old one goes; a write that fails leaves the old table. A driver
    that dies between the two renames leaves the old one aside, where ``recover`` finds it.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    recover(spark, path)
    new, old = _staging(path, "new"), _staging(path, "old")
    writer = _packed(df, partition).write
    try:
        (writer.partitionBy(partition) if partition else writer).parquet(new)
    except Exception:
        remove(spark, new)
        raise
    forget(spark, path)
    fs, target = _fs(spark, path)
    had = fs.exists(target)
    if had and not fs.rename(target, _fs(spark, old)[1]):
        raise OSError(f"{path} could not be moved aside")
    if not had:
        fs.mkdirs(target.getParent())
    if not fs.rename(_fs(spark, new)[1], target):
        if had:
            fs.rename(_fs(spark, old)[1], target)
        raise OSError(f"the new table could not be moved to {path}")
    remove(spark, old)


def recover(spark: SparkSession, path: str) -> bool:
    """Undoes a swap that stopped half-way: a table that is only aside takes its place again.
    Called before a table is replaced or updated; true if there was something to undo."""
    fs, target = _fs(spark, path.rstrip("/"))
    aside = _fs(spark, f"{path.rstrip('/')}__staging")[1]
    if not fs.exists(aside):
        return False
    old = [f.getPath() for f in fs.listStatus(aside) if f.getPath().getName().startswith("old-")]
    back = bool(old) and not fs.exists(target)
    if back and not fs.rename(old.pop(), target):
        raise OSError(f"{path} could not be moved back")
    for p in old:  # the swap was complete but for their removal
        fs.delete(p, True)
    return back


def snapshot(df: DataFrame, path: str) -> None:
    """Replaces a table without partitions."""
    create_or_replace(df, path)


def append(df: DataFrame, path: str, partition: str | None = None) -> None:
    forget(df.sparkSession, path)
    _append(df, path, partition)


def _append(df: DataFrame, path: str, partition: str | None = None) -> None:
    writer = _packed(df, partition).write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def _staging(path: str, kind: str = "rows") -> str:
    return f"{path.rstrip('/')}__staging/{kind}-{uuid.uuid4().hex}"


def partition_values(df: DataFrame, partition: str) -> list:
    """Partition values of a frame: one per day, not one per row."""
    return [r[0] for r in df.select(partition).distinct().collect()]


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _text(value) -> str:
    """A partition value as Spark writes it, before it is escaped."""
    if value is None or value == "":
        return NO_VALUE
    if isinstance(value, datetime):
        whole = value.strftime("%Y-%m-%d %H:%M:%S")
        return f"{whole}.{value.microsecond:06d}".rstrip("0") if value.microsecond else whole
    if isinstance(value, bool):
        return str(value).lower()
    return value.isoformat() if isinstance(value, date) else str(value)


def folders(spark: SparkSession, path: str, partition: str) -> dict[str, str]:
    """The table's partition folders by the text of their value."""
    fs, p = _fs(spark, path)
    names = [f.getPath() for f in fs.listStatus(p) if f.isDirectory()]
    return {unquote(n.getName().split("=", 1)[1]): n.toString() for n in names
            if n.getName().startswith(f"{partition}=")}


def table(spark: SparkSession, path: str, partition: str,
          kind: T.DataType | None = None) -> DataFrame:
    """The table with its partition column of this type; as text by default."""
    found = spark.read.parquet(path).schema
    if partition not in found.names:
        raise ValueError(f"{path} is not partitioned by {partition!r}")
    return spark.read.schema(T.StructType([
        T.StructField(f.name, kind or T.StringType()) if f.name == partition else f
        for f in found.fields])).parquet(path)


def schema_of(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


def _move_in(spark: SparkSession, rows: str, path: str) -> None:
    """Makes partitions that were written aside a table that has none so far."""
    fs, target = _fs(spark, path)
    made = _fs(spark, rows)[1]
    if not fs.exists(target):
        fs.mkdirs(target.getParent())
        moves = [(made, target)]
    else:  # marker files only
        moves = [(f.getPath(), _fs(spark, f"{path.rstrip('/')}/{f.getPath().getName()}")[1])
                 for f in fs.listStatus(made) if f.isDirectory()]
    for old, new in moves:
        if not fs.rename(old, new):
            raise OSError(f"{old.toString()} could not be moved to {new.toString()}")


def _in(partition: str, values: Sequence) -> Column:
    """Partition filter known before the scan, so untouched folders are never opened."""
    known = [v for v in values if v is not None]
    cond = C(partition).isin(known) if known else F.lit(False)
    return cond | C(partition).isNull() if len(known) < len(values) else cond


def _overwrite(rows: DataFrame, path: str, partition: str) -> None:
    """Replaces the partitions that occur in ``rows``."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


def _drop(spark: SparkSession, path: str, partition: str, values: Sequence) -> None:
    """Removes the partitions of these values; raises when one of them is not there."""
    if not values:
        return
    held = folders(spark, path, partition)
    lost = [v for v in values if _text(v) not in held]
    if lost:
        raise ValueError(f"{path} has no partitions {partition}={lost[:5]}")
    for value in values:
        remove(spark, held[_text(value)])


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raises when two rows share a key; equal keys are combined before the shuffle."""
    if df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(C("_n") > 1).limit(1).count():
        raise ValueError(f"several rows share the key {list(keys)}")


def upsert(updates: DataFrame, path: str, keys: Sequence[str], partition: str, *,
           version: str | None = None, moves: bool = True) -> list:
    """Inserts new keys and replaces known ones; returns the partitions that were rewritten.

    The updates are computed once, into a staging folder, and read from there; that folder becomes
    the table where there is none. Only partitions
    that receive a row or hold an old version of one are read and rewritten. Which those are tells
    an index from key to partition (``key_index``), which is asked about the keys of the updates;
    it is built with the table, or once from its keys where it is missing. ``moves=False`` promises
    that a key never changes its partition, as does a key that holds the partition column: then
    there is no index. With ``version`` a stored row with a later version stays.
    """
    spark = updates.sparkSession
    keys = list(keys)
    moves = moves and partition not in keys
    recover(spark, path)
    staging = _staging(path)
    _packed(updates, partition).write.partitionBy(partition).parquet(f"{staging}/rows")
    try:
        staged = spark.read.schema(updates.schema).parquet(f"{staging}/rows")
        check_unique(staged, keys)
        incoming = partition_values(staged, partition)
        if not incoming:
            return []
        index = KeyIndex(spark, path, updates.schema, keys, partition) if moves else None
        if not exists(spark, path):
            if index:
                index.build(staged)
            _move_in(spark, f"{staging}/rows", path)  # packed already
            return incoming
        target = table(spark, path, partition, updates.schema[partition].dataType)
        places = None
        if index:
            if index.state() is None:
                index.build(target)
            index.locate(staged).write.parquet(f"{staging}/places")
            places = spark.read.schema(T.StructType(index.schema.fields[:-2])).parquet(
                f"{staging}/places")
        if version:
            near = _near(spark, path, partition, incoming, places)
            held = target.filter(_in(partition, near)).select(*keys, C(version).alias("_held"))
            # only keys and versions are compared, once; rows are looked at where some are stale
            staged.select(*keys, C(version).alias("_new")).join(held, keys).filter(
                C("_held").isNotNull() & ~F.coalesce(C("_held") <= C("_new"), F.lit(False))
            ).select(*keys).distinct().write.parquet(f"{staging}/stale")
            stale = spark.read.schema(staged.select(*keys).schema).parquet(f"{staging}/stale")
            if not stale.isEmpty():
                staged = staged.join(stale, keys, "left_anti")
                incoming = partition_values(staged, partition)
                if not incoming:
                    return []
                if index:
                    places = places.join(staged.select(*keys), keys, "left_semi")
        touched = _near(spark, path, partition, incoming, places)
        kept = target.filter(_in(partition, touched)).join(staged.select(*keys), keys, "left_anti")
        merged = kept.unionByName(staged, allowMissingColumns=True)
        emptied = []
        if len(touched) > len(incoming):
            left = partition_values(merged.select(partition), partition)
            emptied = [v for v in touched if v not in left]
        number = None
        if index:
            here = [C(k) == C(f"_{i}") for i, k in enumerate(keys)]
            known = places.select(*(C(k).alias(f"_{i}") for i, k in enumerate(keys)),
                                  C("_at").alias("_known"))
            staged.select(*keys, C(partition).alias("_at")).join(
                known, [*here, C("_at").eqNullSafe(C("_known"))], "left_anti").write.parquet(
                f"{staging}/moved")
            moved = spark.read.schema(T.StructType(index.schema.fields[:-2])).parquet(
                f"{staging}/moved")
            number = index.begin(moved)
        _overwrite(_packed(merged, partition), path, partition)
        _drop(spark, path, partition, emptied)
        if index:
            index.commit(number, index.buckets_of(moved))
        return touched
    finally:
        remove(spark, staging)


def _near(spark: SparkSession, path: str, partition: str, incoming: Sequence,
          places: DataFrame | None) -> list:
    """Partitions that get a row or may hold an old version of one."""
    if places is None:
        return list(incoming)
    held = folders(spark, path, partition)
    return list(dict.fromkeys([*incoming, *(v for v in partition_values(places, "_at")
                                            if _text(v) in held)]))


def replace_partitions(df: DataFrame, path: str, partition: str,
                       touched: Sequence | None = None) -> None:
    """Makes ``df`` the whole content of its partitions, so groups that vanished disappear.

    ``touched`` names partitions to replace even where ``df`` has no row for them.
    """
    spark = df.sparkSession
    forget(spark, path)
    # which partitions got a row is noted while they are written: ``df`` is computed once
    seen = Observation()
    noted = df.observe(seen, F.collect_set(partition).alias("values"),
                       F.count_if(C(partition).isNull()).alias("nulls"))
    _overwrite(_packed(noted, partition), path, partition)
    if touched:
        found = seen.get
        left = {_text(v) for v in found["values"]} | ({NO_VALUE} if found["nulls"] else set())
        held = folders(spark, path, partition) if exists(spark, path) else {}
        _drop(spark, path, partition,
              [v for v in touched if _text(v) in held and _text(v) not in left])


def kept(df: DataFrame, name: str) -> DataFrame:
    """A frame as a table in the shared job folder: computed once, and its lineage is cut."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/waybill/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run here go when their query ends, not when the driver happens
    to collect its garbage; those of a long job would else lie on the disks together."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def staged(df: DataFrame, path: str) -> Iterator[DataFrame]:
    """The frame as a table beside ``path`` while it is used: computed once, read as often as
    needed."""
    aside = _staging(path)
    df.write.parquet(aside)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(aside)
    finally:
        remove(df.sparkSession, aside)


def _batch_folders(spark: SparkSession, path: str, by: str, batch_id: str = "*"):  # noqa: ANN202
    fs, p = _fs(spark, f"{path.rstrip('/')}/{by}=*/batch_id={batch_id}")
    return fs, [f.getPath() for f in fs.globStatus(p) or []]


def replace_batch(df: DataFrame, path: str, batch_id: int, day: date | None = None,
                  by: str = "batch_day") -> None:
    """Adds a batch's rows under their day and its number, in place of what the same batch left
    there before. The day is one of the whole batch, or the column ``by`` of its rows.

    Other batches are neither read nor written. ``merge_batches`` joins the folders of batches
    that can no longer be repeated.
    """
    fs, before = _batch_folders(df.sparkSession, path, by, str(batch_id))
    for p in before:
        fs.delete(p, True)
    rows = df.withColumn(by, F.lit(day)) if day else df
    rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("append").partitionBy(
        by, "batch_id").parquet(path)


def merge_batches(spark: SparkSession, path: str, schema: T.StructType, before: int,
                  most: int = 64, by: str = "batch_day") -> None:
    """Joins the batches of each day that has more than ``most``, all earlier than batch ``before``,
    under the number of its last. ``schema``: of the rows without day and batch.

    The rows are written aside and moved in under a name of their own before the old folders go.
    """
    fs, found = _batch_folders(spark, path, by)
    days: dict[str, list[tuple[int, object]]] = {}
    for p in found:
        number = int(p.getName().split("=")[1])
        if number < before:
            days.setdefault(p.getParent().getName().split("=")[1], []).append((number, p))
    for day, parts in days.items():
        if len(parts) <= most:
            continue
        last = max(n for n, _ in parts)
        new = _staging(path, "merged")
        spark.read.schema(schema).parquet(*(p.toString() for _, p in parts)).hint(
            "rebalance").write.parquet(new)
        target = _fs(spark, f"{path.rstrip('/')}/{by}={day}/batch_id={last}")[1]
        old = [f.getPath() for _, p in parts for f in fs.listStatus(p)]
        for f in fs.listStatus(_fs(spark, new)[1]):
            if f.getPath().getName().endswith(".parquet"):
                fs.rename(f.getPath(), _fs(spark, f"{target.toString()}/{f.getPath().getName()}")[1])
        for p in old:
            fs.delete(p, False)
        for number, p in parts:
            if number != last:
                fs.delete(p, True)
        remove(spark, new)


def refresh(compute, source: DataFrame, path: str, day: str, partition: str,
            days: Sequence) -> None:
    """Recomputes a daily table for the given days only, from the source rows of those days.

    The range of days is compared with the column itself, so it reaches the scan.
    """
    days = list(days)
    near = (C(day) >= F.lit(min(days))) & (C(day) < F.lit(max(days) + timedelta(days=1)))
    rows = compute(source.filter(near & F.to_date(day).isin(days)))
    replace_partitions(rows, path, partition, days)


def backfill(compute, source: DataFrame, path: str, day: str, partition: str, days: int, *,
             as_of) -> None:
    """Recomputes the last ``days`` days of a daily table."""
    since = source.filter(F.to_date(day) >= F.date_sub(F.to_date(as_ts(as_of)), days))
    replace_partitions(compute(since), path, partition, partition_values(
        since.select(F.to_date(day).alias(partition)), partition))


def split(df: DataFrame, bad: Column, reason: str, *, as_of) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with reason and time. A predicate that is null counts as bad."""
    flag = F.coalesce(bad, F.lit(True))
    return df.filter(~flag), df.filter(flag).withColumns(
        {"error_reason": F.lit(reason), "quarantined_at": as_ts(as_of)})


def quarantine(df: DataFrame, bad: Column, reason: str, path: str, *, as_of) -> DataFrame:
    """Appends the bad rows to the quarantine table and returns the good ones."""
    good, rejected = split(df, bad, reason, as_of=as_of)
    append(rejected, path)
    return good


def append_results(results: DataFrame, path: str, *, as_of) -> None:
    """Adds rule results to their history, by day."""
    append(results.withColumns({"checked_at": as_ts(as_of),
                                "check_day": F.to_date(as_ts(as_of))}), path, "check_day")


def compact(spark: SparkSession, path: str, cluster_by: Sequence[str],
            partition: str | None = None, values: Sequence | None = None, *,
            interleave: bool = False) -> None:
    """Rewrites a table, or some partitions of it, into few files ordered by ``cluster_by``.

    Rows are spread by range, so equal and near values share files and their row groups can be
    skipped. The number of files follows the data: adaptive execution merges small ranges. With
    ``interleave`` no column leads: rows are ordered along a curve through all of them
    (``clustering``), so that a filter on any one of them skips most row groups.
    """
    if partition is None:
        snapshot(_laid(spark.read.parquet(path), cluster_by, [], interleave), path)
        return
    some = table(spark, path, partition)
    if values is not None:
        some = some.filter(_in(partition, [None if v is None else _text(v) for v in values]))
    _overwrite(_laid(some, cluster_by, [partition], interleave), path, partition)


def _laid(rows: DataFrame, columns: Sequence[str], first: list[str], interleave: bool) -> DataFrame:
    if interleave:
        return clustering.along_curve(rows, columns, first)
    order = [*first, *columns]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def run_steps(steps: dict, retries: int = 2, workers: int = 4) -> list[dict]:
    """Runs independent refresh steps at once, each with retries, and reports how they went."""
    def run(name: str) -> dict:
        for attempt in range(1, retries + 2):
            try:
                steps[name]()
                return {"step": name, "status": "Succeeded", "attempts": attempt, "error": None}
            except Exception as error:  # noqa: BLE001 - one step must not stop the others
                failure = str(error)
        return {"step": name, "status": "Failed", "attempts": retries + 1, "error": failure}

    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(run, steps))
