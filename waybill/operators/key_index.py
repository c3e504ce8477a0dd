"""Where the keys of a partitioned table lie, so that an upsert asks about its own keys only.

The index is a table beside the indexed one (``<path>__keys``): rows (keys, ``_at``, ``_seq``) say
that a key was written to partition ``_at`` by upsert number ``_seq``. They are dealt into hash
buckets, a folder each; the number of buckets follows the number of entries by linear hashing, so
growing divides only as many buckets as are added. A question opens the buckets of the keys that
are asked about, and an upsert appends to those buckets only keys that are new or have moved.
A bucket with many files is written anew with one row a key.

Entries are written before the rows they speak of. An upsert that fails in between leaves its
number open, and for its keys both places, the old and the new one, count as possible. So the
index may name one place too many, but misses none. Files are only added, or removed once their
content has been written elsewhere; the state (number of buckets, entries, open numbers) is a
small file that replaces its predecessor by a new name. One writer at a time, as for the table.

The driver sees bucket numbers and partition values, never keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.operators import buckets
from waybill.operators.state_file import StateFile

C = F.col
BUCKET_KEYS = 1_000_000
MOST_FILES = 16


@dataclass(frozen=True)
class State:
    buckets: int = 1
    entries: int = 0
    last: int = 0  # number of the latest upsert
    open: tuple[int, ...] = ()  # of upserts that began and are not known to have ended


def folder_of(path: str) -> str:
    return f"{path.rstrip('/')}__keys"


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def forget(spark: SparkSession, path: str) -> None:
    """Drops the index of a table that was written in another way than by keyed upserts."""
    fs, p = _fs(spark, folder_of(path))
    fs.delete(p, True)


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType,
                 keys: Sequence[str], partition: str, size: int = BUCKET_KEYS) -> None:
        """``schema`` is that of the indexed table's rows."""
        self.spark, self.folder, self.keys = spark, folder_of(path), list(keys)
        self.partition, self.size = partition, size
        self.schema = T.StructType([
            *(T.StructField(k, schema[k].dataType) for k in self.keys),
            T.StructField("_at", schema[partition].dataType),
            T.StructField("_seq", T.LongType()), T.StructField("_bucket", T.IntegerType())])

    # ---- state

    def state(self) -> State | None:
        """None where there is no complete index."""
        held = StateFile(self.spark, self.folder).read()
        return held and State(**held | {"open": tuple(held["open"])})

    def _save(self, state: State) -> State:
        StateFile(self.spark, self.folder).write(asdict(state))
        return state

    # ---- buckets

    def _bucket(self, n: int):  # noqa: ANN202
        return buckets.address(buckets.hash_of(self.keys), n).alias("_bucket")

    def _read(self, wanted: Sequence[int]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder).filter(
            C("_bucket").isin(list(wanted)))

    def _files(self, wanted: Sequence[int]) -> dict[int, list]:
        out = {}
        for b in wanted:
            fs, p = _fs(self.spark, f"{self.folder}/_bucket={b}")
            out[b] = [f.getPath() for f in fs.listStatus(p)
                      if f.getPath().getName().endswith(".parquet")] if fs.exists(p) else []
        return out

    def _append(self, rows: DataFrame) -> None:
        rows.select(*self.keys, "_at", "_seq", "_bucket").hint("rebalance", C("_bucket")).write.mode(
            "append").partitionBy("_bucket").parquet(self.folder)

    def _rewrite(self, wanted: Sequence[int], rows: DataFrame) -> None:
        """Replaces the files of these buckets; for a moment entries are there twice."""
        old = [p for files in self._files(wanted).values() for p in files]
        self._append(rows)
        fs, _ = _fs(self.spark, self.folder)
        for p in old:
            fs.delete(p, False)

    def _live(self, rows: DataFrame, state: State) -> DataFrame:
        """The entries of each key from its last finished upsert on."""
        if not state.open:
            return rows.groupBy(*self.keys, "_bucket").agg(
                F.max(F.struct("_seq", "_at")).alias("_last")).select(
                *self.keys, "_last._at", "_last._seq", "_bucket")
        known = F.when(~C("_seq").isin(*state.open), C("_seq"))
        last = rows.groupBy(*self.keys, "_bucket").agg(F.max(known).alias("_last"))
        return rows.join(last, [*self.keys, "_bucket"]).filter(
            C("_last").isNull() | (C("_seq") >= C("_last"))).drop("_last").distinct()

    def _grow(self, state: State, n: int) -> State:
        """Divides buckets until there are ``n``: rows are copied to the new ones, then these
        count, then the copies' originals go."""
        if n <= state.buckets:
            return state
        sources = buckets.divided(state.buckets, n)
        held = self._read(sources).withColumn("_to", self._bucket(n))
        self._append(held.filter(C("_to") >= state.buckets).withColumn("_bucket", C("_to")))
        state = self._save(replace(state, buckets=n))
        self._rewrite(sources, held.filter(C("_to") == C("_bucket")))
        return state

    # ---- use

    def build(self, rows: DataFrame) -> None:
        """The index of a whole table, or of one that is about to be written."""
        fs, p = _fs(self.spark, self.folder)
        fs.delete(p, True)
        held = rows.select(*self.keys, C(self.partition).alias("_at")).withColumn(
            "_seq", F.lit(0).cast("long"))
        entries = held.count()
        n = buckets.enough(entries, self.size)
        self._append(held.withColumn("_bucket", self._bucket(n)))
        self._save(State(buckets=n, entries=entries))

    def locate(self, asked: DataFrame) -> DataFrame:
        """(keys, _at): where rows with these keys may lie."""
        state = self.state()
        asked = asked.select(*self.keys, self._bucket(state.buckets))
        wanted = [r[0] for r in asked.select("_bucket").distinct().collect()]
        found = self._read(wanted).join(asked, [*self.keys, "_bucket"], "left_semi")
        return self._live(found, state).select(*self.keys, "_at")

    def begin(self, new: DataFrame) -> int:
        """Enters (keys, _at) of an upsert that is about to write; returns its number."""
        state = self.state()
        number = state.last + 1
        state = self._save(replace(state, last=number, open=(*state.open, number)))
        entries = state.entries + new.count()
        state = self._grow(state, buckets.enough(entries, self.size, state.buckets))
        rows = new.select(*self.keys, "_at").withColumn("_seq", F.lit(number).cast("long"))
        self._append(rows.withColumn("_bucket", self._bucket(state.buckets)))
        self._save(replace(state, entries=entries))
        return number

    def commit(self, number: int, touched: Sequence[int] = ()) -> None:
        state = self.state()
        state = self._save(replace(state, open=tuple(x for x in state.open if x != number)))
        full = [b for b, files in self._files(touched).items() if len(files) > MOST_FILES]
        if full:
            self._rewrite(full, self._live(self._read(full), state))

    def buckets_of(self, rows: DataFrame) -> list[int]:
        n = self.state().buckets
        return sorted(r[0] for r in rows.select(self._bucket(n)).distinct().collect())
