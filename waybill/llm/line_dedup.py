"""Line dedup that can be undone: sharded cuckoo filters backed by exact reference counts.

A line's key is the line with ASCII white space stripped at both ends and A-Z lower-cased. Keys of
at least ``min_chars`` code points found in at least ``min_docs`` documents lose all their lines
except in the document with the largest doc_id that holds them; other lines stay.

State is three tables in the shared folder, dealt by key hash into shards:

* ``postings`` (shard, k1, k2, doc_id): which document holds which key, once each;
* ``counts`` (shard, k1, k2, n_docs, last_doc): exact reference counts;
* ``filters`` (shard, data): a cuckoo filter of the shard's keys.

Inserting asks the filters first: only keys that may be known meet the exact counts, new ones are
added without a look-up. Deleting documents lowers the counts, finds the next holder, and takes
keys without a holder out of the filters, so a line comes back when its copies go. Every step
writes new tables and leaves the old ones, so a step that fails is simply repeated.

Keys are 128 bits of two hashes with different seeds. A hot line is counted by partial aggregation,
and each shard gets one row a key.

Defined cases: null or empty text is one empty line. Rows with equal doc_id are one document when
counting, but each row loses only lines of its own text; doc_id and two hashes of the text tell
rows apart. A row without doc_id counts for nothing and loses nothing.
Further columns pass through ``dedup`` unchanged; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm.cuckoo import CuckooFilter, Full
from waybill.llm.storage import kept

SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHARDS = 64
FILTER_BYTES = 64 << 20  # filters of dropped keys up to this size are sent to every task
KEY = ["k1", "k2"]
ROW = ["doc_id", "t1", "t2"]  # rows that agree in these lose the same lines


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashes(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("k1"), F.xxhash64(F.lit(7), key).alias("k2"))


def _text_hashes(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2")]


def document_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, k1, k2) of every long enough line; a key once a row."""
    keys = F.filter(F.transform(_lines(F.col("text")), line_key),
                    lambda k: F.char_length(k) >= min_chars)
    return (docs.where("doc_id is not null")
            .select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.explode(F.array_distinct(F.transform(keys, _hashes))).alias("k"))
            .select("doc_id", "k.k1", "k.k2"))


@dataclass(frozen=True)
class LineStore:
    postings: DataFrame
    counts: DataFrame
    filters: DataFrame
    min_chars: int
    min_docs: int
    shards: int
    is_empty: bool = False


def _sharded(df: DataFrame, shards: int) -> DataFrame:
    return df.withColumn("shard", F.pmod(F.col("k1"), F.lit(shards)).cast("int"))


def empty_store(spark: SparkSession, min_chars: int = 20, min_docs: int = 3,
                shards: int = SHARDS) -> LineStore:
    return LineStore(
        spark.createDataFrame([], "shard int, k1 long, k2 long, doc_id long"),
        spark.createDataFrame([], "shard int, k1 long, k2 long, n_docs long, last_doc long"),
        spark.createDataFrame([], "shard int, data binary"), min_chars, min_docs, shards, True)


def _maybe_known(shard_filter: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
    known = np.zeros(len(keys), bool)
    if len(shard_filter) and len(keys):
        known = CuckooFilter.load(shard_filter["data"].iloc[0]).contains(
            keys["k1"].to_numpy().view(np.uint64))
    return keys.assign(known=known)


def _with_keys(shard_filter: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
    """The shard's filter after adding (change 1) and removing (change -1) keys; ``held`` keys
    come along so that a full filter can be rebuilt."""
    if not len(keys):
        return shard_filter[["shard", "data"]]
    at = keys["k1"].to_numpy().view(np.uint64)
    change = keys["change"].to_numpy()
    old = CuckooFilter.load(shard_filter["data"].iloc[0]) if len(shard_filter) else None
    try:
        if old is None:
            raise Full
        old.delete(at[change < 0])
        old.insert(at[change > 0])
    except Full:
        old = CuckooFilter.of(at[change >= 0])
    return pd.DataFrame({"shard": [int(keys["shard"].iloc[0])], "data": [old.dump()]})


def _filters(store: LineStore, counts: DataFrame, changed: DataFrame) -> DataFrame:
    """``changed``: (shard, k1, k2, change). Keys that stay are sent too, for a filter to grow."""
    stay = (counts.join(changed.where("change > 0").select(*KEY), KEY, "left_anti")
            .select("shard", *KEY, F.lit(0).alias("change")))
    return kept(store.filters.groupBy("shard").cogroup(
        changed.select("shard", *KEY, F.col("change").cast("int").alias("change"))
        .union(stay).groupBy("shard"))
        .applyInPandas(_with_keys, "shard int, data binary"), "filters")


def _first(store: LineStore, docs: DataFrame) -> LineStore:
    """An empty store takes everything as new: no look-ups, and the filters follow the counts."""
    postings = kept(_sharded(document_keys(docs, store.min_chars), store.shards)
                    .select("shard", *KEY, "doc_id").distinct(), "postings")
    counts = kept(postings.groupBy("shard", *KEY).agg(
        F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc")), "counts")
    filters = counts.groupBy("shard").applyInPandas(_one_filter, "shard int, data binary")
    return LineStore(postings, counts, filters, store.min_chars, store.min_docs, store.shards)


def insert(store: LineStore, docs: DataFrame) -> LineStore:
    """The store with these documents; what it already holds of them is not counted twice."""
    if store.is_empty:
        return _first(store, docs)
    new = kept(_sharded(document_keys(docs, store.min_chars), store.shards)
               .select("shard", *KEY, "doc_id").distinct()
               .join(store.postings, ["shard", *KEY, "doc_id"], "left_anti"), "postings")
    delta = new.groupBy("shard", *KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
    asked = kept(store.filters.groupBy("shard").cogroup(delta.groupBy("shard")).applyInPandas(
        _maybe_known, "shard int, k1 long, k2 long, n long, last long, known boolean"), "asked")
    known = asked.where("known").drop("known")
    old = store.counts.join(known.drop("shard"), KEY, "left").select(
        "shard", *KEY, (F.col("n_docs") + F.coalesce("n", F.lit(0))).alias("n_docs"),
        F.greatest("last_doc", "last").alias("last_doc"))
    added = (asked.where("not known").drop("known")
             .union(known.join(store.counts.select(*KEY), KEY, "left_anti")
                    .select("shard", *KEY, "n", "last")))
    counts = kept(old.union(added), "counts")
    filters = _filters(store, counts, added.select("shard", *KEY, F.lit(1).alias("change")))
    return LineStore(store.postings.union(new), counts, filters, store.min_chars, store.min_docs,
                     store.shards)


def delete(store: LineStore, doc_ids: DataFrame) -> LineStore:
    """The store without these documents (column doc_id); ids it does not hold change nothing."""
    ids = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    postings = kept(store.postings.join(ids, "doc_id", "left_anti")
                    .select("shard", *KEY, "doc_id"), "postings")
    touched = kept(store.postings.join(ids, "doc_id", "left_semi")
                   .select("shard", *KEY).distinct(), "touched")
    again = (postings.join(touched, ["shard", *KEY], "left_semi").groupBy("shard", *KEY)
             .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc")))
    counts = kept(store.counts.join(touched, ["shard", *KEY], "left_anti")
                  .select("shard", *KEY, "n_docs", "last_doc").union(again), "counts")
    gone = touched.join(counts.select(*KEY), KEY, "left_anti")
    filters = _filters(store, counts, gone.select("shard", *KEY, F.lit(-1).alias("change")))
    return LineStore(postings, counts, filters, store.min_chars, store.min_docs, store.shards)


def _one_filter(keys: pd.DataFrame) -> pd.DataFrame:
    made = CuckooFilter.of(keys["k1"].to_numpy().view(np.uint64))
    return pd.DataFrame({"shard": [int(keys["shard"].iloc[0])], "data": [made.dump()]})


def dropped_keys(store: LineStore, docs: DataFrame) -> DataFrame:
    """(doc_id, t1, t2, drops): positions of the lines that each row loses."""
    heavy = store.counts.where(F.col("n_docs") >= store.min_docs)
    # a heavy key once a line: position and key of every long enough line
    lines = (docs.where("doc_id is not null")
             .select(F.col("doc_id").cast("long").alias("doc_id"), *_text_hashes(F.col("text")),
                     F.posexplode(F.transform(_lines(F.col("text")), line_key))
                     .alias("pos", "key"))
             .where(F.char_length("key") >= store.min_chars)
             .select(*ROW, "pos", _hashes(F.col("key")).alias("k"))
             .select(*ROW, "pos", "k.k1", "k.k2"))
    if heavy.count() * 6 <= FILTER_BYTES:
        shards = {r["shard"]: r["data"] for r in heavy.groupBy("shard").applyInPandas(
            _one_filter, "shard int, data binary").collect()}
        sent = docs.sparkSession.sparkContext.broadcast(shards)
        n = store.shards

        def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            loaded = {k: CuckooFilter.load(v) for k, v in sent.value.items()}
            for batch in batches:
                k1 = batch.column("k1").to_numpy()
                hit, shard = np.zeros(len(k1), bool), k1 % n
                for s in np.unique(shard):
                    if s in loaded:
                        at = np.flatnonzero(shard == s)
                        hit[at] = loaded[s].contains(k1[at].view(np.uint64))
                yield batch.filter(pa.array(hit))

        lines = lines.mapInArrow(
            maybe, "doc_id long, t1 long, t2 long, pos int, k1 long, k2 long")
    return (lines.join(heavy.select(*KEY, "last_doc"), KEY)
            .where("doc_id <> last_doc").groupBy(*ROW)
            .agg(F.collect_set("pos").alias("drops")))


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, drops: pd.Series) -> pd.Series:
    def one(text: str | None, gone: np.ndarray | None) -> str | None:
        if text is None or gone is None:
            return None
        out = set(int(i) for i in gone)
        return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in out)

    return pd.Series([one(t, d) for t, d in zip(texts, drops, strict=True)], dtype=object)


def rewritten(store: LineStore, docs: DataFrame) -> DataFrame:
    """(row, text, n_lines, n_dropped): ``row`` is a struct of the documents' other columns."""
    drops = dropped_keys(store, docs)
    a, b = docs.alias("a"), drops.alias("b")
    gone = F.col("b.drops")
    t1, t2 = _text_hashes(F.col("a.text"))
    same = ((F.col("a.doc_id") == F.col("b.doc_id")) & (t1 == F.col("b.t1"))
            & (t2 == F.col("b.t2")))
    return (a.join(b, same, "left")
            .select(F.struct(*(F.col(f"a.`{c}`") for c in docs.columns if c != "text"))
                    .alias("row"),
                    F.coalesce(_without(F.when(gone.isNotNull(), F.col("a.text")), gone),
                               F.col("a.text")).alias("text"),
                    F.size(_lines(F.col("a.text"))).cast("long").alias("n_lines"),
                    F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped")))


def store_of(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> LineStore:
    """All documents put into an empty store."""
    return insert(empty_store(docs.sparkSession, min_chars, min_docs), docs)


def dedup(store: LineStore, docs: DataFrame) -> DataFrame:
    """The documents, all columns, with the text rewritten."""
    return rewritten(store, docs).select(
        *(F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "row.doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
with l as (
  select doc_id, rid, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from (select *, row_number() over () as rid from documents)),
k as (select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
      from l),
c as (select key, count(distinct doc_id) as n, max(doc_id) as last from k
      where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
v as (select k.*, c.key is not null and k.doc_id <> c.last as gone
      from k left join c on k.key = c.key)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), ''))
         as kept_sha256
from v group by rid, doc_id
"""
