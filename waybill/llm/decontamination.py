"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A window is ``k``
consecutive words of a benchmark item; an item of fewer words, but not none, is one window. Each
task scans the rolling window hashes of whole texts against the set; every hit is verified word by
word. A document word inside any occurrence of a window is hit.

The set is sent in slices of at most ``SLICE`` distinct windows: their number is counted first, and
a larger benchmark is scanned slice after slice, each adding to the hits of the same rows. Nothing
is shuffled but the windows of the benchmark.

``remove="documents"`` drops documents with hits, ``remove="spans"`` cuts each maximal run of hit
words out of the text.

Defined cases: null or empty texts have no words and no hits. Benchmark rows without
text are left out; rows with the same item_id are one item. Rows without item_id are no
item: their windows are hit, for a passage without an id is leaked all the same, but add no item
(``unnamed=False`` leaves them out). Rows of documents stay rows, whatever their doc_id; further
columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm.phrases import Phrases, item_windows
from waybill.llm.storage import kept
from waybill.llm.texts import ALNUM, groups, utf8, words

K = 10
SLICE = 250_000
GROUP = 4 << 20
HITS = ("n_words long, hit_from array<long>, hit_to array<long>, byte_from array<long>, "
        "byte_to array<long>, items array<string>")


def windows(benchmark: DataFrame, k: int = K, unnamed: bool = True) -> DataFrame:
    """(words, items): every distinct window and the items that hold it; with ``unnamed`` also
    windows that only rows without item_id hold, with no items."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = item_windows(batch.column(1), k)
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for x in own for w in x], pa.binary()),
                 pa.array([i for i, x in zip(batch.column(0).to_pylist(), own, strict=True)
                           for _ in x], pa.string())], ["words", "item"])

    rows = (benchmark.where("text is not null")
            .where(F.lit(unnamed) | F.col("item_id").isNotNull())
            .select(F.col("item_id").cast("string").alias("item"), "text")
            .mapInArrow(cut, "words binary, item string"))
    return rows.groupBy("words").agg(F.collect_set("item").alias("items"))


def _merged(begin: np.ndarray, end: np.ndarray) -> tuple[list[int], list[int]]:
    """Maximal runs of words covered by [begin, end)."""
    if not len(begin):
        return [], []
    order = np.argsort(begin, kind="stable")
    begin, top = begin[order], np.maximum.accumulate(end[order])
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > top[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(begin) - 1)
    return begin[new].tolist(), top[last].tolist()


def _scan(texts: pa.Array, phrases: Phrases, items: list[list[str]],
          before: list[tuple] | None) -> list[tuple]:
    data, offsets = utf8(texts)
    out: list[tuple] = []
    for lo, hi in groups(offsets, GROUP):
        part, at = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        h, begin, end, ranges = words(part, at, ALNUM)
        text, first, size, entry = phrases.find(h, ranges, part, begin, end)
        cuts = np.searchsorted(text, np.arange(hi - lo + 1))
        for t in range(hi - lo):
            a, b, n = cuts[t], cuts[t + 1], int(ranges[t + 1] - ranges[t])
            old = before[lo + t] if before else None
            if a == b:
                out.append(old or (n, [], [], [], [], []))
                continue
            names = {i for e in set(entry[a:b].tolist()) for i in items[e]}
            frm, to = first[a:b], first[a:b] + size[a:b]
            if old:
                names |= set(old[5])
                frm = np.concatenate([frm, np.array(old[1], np.int64)])
                to = np.concatenate([to, np.array(old[2], np.int64)])
            runs = _merged(frm, to)
            base = ranges[t]
            out.append((n, *runs, [int(begin[base + i] - at[t]) for i in runs[0]],
                        [int(end[base + i - 1] - at[t]) for i in runs[1]], sorted(names)))
    return out


def scan(docs: DataFrame, benchmark: DataFrame, k: int = K, size: int = SLICE,
         text: bool = False, unnamed: bool = True) -> DataFrame:
    """(row, hits): the documents' columns (``text`` only if asked for) in a struct, and for each
    row its number of words, the runs of hit words (in words and in bytes) and the items."""
    spark = docs.sparkSession
    sets = kept(windows(benchmark, k, unnamed), "windows")
    slices = max(1, -(-sets.count() // size))
    keep = [c for c in docs.columns if text or slices > 1 or c != "text"]
    row = F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row")
    out = docs.select(row, "text")
    fields = T.StructType([T.StructField("row", out.schema["row"].dataType, False),
                           T.StructField("hits", T._parse_datatype_string(HITS))])
    for i in range(slices):
        own = sets if slices == 1 else sets.where(
            F.pmod(F.xxhash64("words"), F.lit(slices)) == i)
        pairs = [(bytes(r["words"]), sorted(r["items"])) for r in own.collect()]
        sent = spark.sparkContext.broadcast(pairs)

        def find(batches: Iterator[pa.RecordBatch], sent=sent, first=i == 0
                 ) -> Iterator[pa.RecordBatch]:
            phrases = Phrases([w for w, _ in sent.value])
            by_words = dict(sent.value)
            items = [by_words[w] for w in phrases.entries]
            for batch in batches:
                before = None if first else [tuple(x.values()) for x in
                                             batch.column(2).to_pylist()]
                rows = _scan(batch.column(1), phrases, items, before)
                hits = pa.StructArray.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64())]
                    + [pa.array([r[j] for r in rows], pa.list_(pa.int64())) for j in range(1, 5)]
                    + [pa.array([r[5] for r in rows], pa.list_(pa.string()))],
                    ["n_words", "hit_from", "hit_to", "byte_from", "byte_to", "items"])
                yield pa.RecordBatch.from_arrays([batch.column(0), hits], ["row", "hits"])

        out = out.mapInArrow(find, fields)
        if i + 1 < slices:
            out = kept(out, "hits").select("row", "row.text", "hits")
    return out


def n_hit() -> Column:
    return F.aggregate(F.zip_with("hits.hit_from", "hits.hit_to", lambda a, b: b - a),
                       F.lit(0).cast("long"), lambda x, y: x + y)


@F.pandas_udf(T.StringType())
def _cut(texts, begins, ends):  # noqa: ANN001, ANN202 - pandas series
    import pandas as pd

    def one(text: str | None, begin, end) -> str | None:  # noqa: ANN001
        if text is None or begin is None or not len(begin):
            return text
        data, out, at = text.encode(), [], 0
        for a, b in zip(begin, end, strict=True):
            out.append(data[at:a])
            at = b
        return b"".join([*out, data[at:]]).decode()

    return pd.Series([one(*x) for x in zip(texts, begins, ends, strict=True)], dtype=object)


def decontaminate(docs: DataFrame, benchmark: DataFrame, k: int = K,
                  remove: str = "documents") -> DataFrame:
    """The documents, with their columns, without what they share with the benchmark."""
    found = scan(docs, benchmark, k, text=True)
    if remove == "documents":
        return found.where(F.size("hits.hit_from") == 0).select("row.*")
    if remove != "spans":
        raise ValueError(f"remove: {remove}")
    cut = _cut(F.col("row.text"), F.col("hits.byte_from"), F.col("hits.byte_to"))
    return found.select(*(cut.alias("text") if c == "text" else F.col(f"row.`{c}`")
                          for c in docs.columns))


def digest(found: DataFrame) -> DataFrame:
    items = F.col("hits.items")
    return found.select(
        "row.doc_id", F.col("hits.n_words").alias("n_words"), n_hit().alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits.hit_from") > 0).alias("contaminated"))


def sha256_of(items: list[str]) -> str:
    """As ``items_sha256``, for tests and callers."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
         r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
with d as (select row_number() over () as rid, doc_id, {_WORDS} as w from documents),
b as (select cast(item_id as varchar) as item, {_WORDS} as w from benchmark
      where text is not null),  -- a row without item_id hits words and adds no item
g as (select distinct item, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as g,
             least(len(w), 10) as k
      from (select item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i
            from b where len(w) > 0)),
s as (select distinct k from g),
o as (select rid, i, k, array_to_string(w[i:i + k - 1], ' ') as g
      from (select rid, w, k, unnest(range(1, len(w) - k + 2)) as i from d, s where len(w) >= k)),
h as (select o.rid, o.i, o.k, g.item from o join g on o.g = g.g and o.k = g.k),
c as (select rid, count(distinct p) as n from (select rid, unnest(range(i, i + k)) as p from h)
      group by rid),
t as (select rid, count(distinct item) as n, string_agg(distinct item, ',' order by item) as items
      from h group by rid)
select d.doc_id, len(d.w) as n_words, coalesce(c.n, 0) as n_hit, coalesce(t.n, 0) as n_items,
       sha256(coalesce(t.items, '')) as items_sha256, c.n is not null as contaminated
from d left join c on d.rid = c.rid left join t on d.rid = t.rid
"""
