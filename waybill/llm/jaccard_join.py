"""Near-duplicate documents by an exact Jaccard join on word shingles.

A document is its set of shingles (``SHINGLE`` consecutive words, A-Z lower-cased; the whole
sequence if it has fewer words). Two documents link when 100 * common >= 75 * union. The join is a
T-occurrence search: a partner of a set of n shingles shares at least T = ceil(0.75 n) of them, so
it occurs in T of the set's inverted lists, and, in any order common to all sets, in at least one
of the first n - T + 1 lists. The order is by document frequency, rare first:

1. blocks ask how frequent their distinct shingles are, and which sets are the first of their
   kind; equal sets are one set from here on;
2. a set with n - T + 1 shingles of its own has no partner and is done; of the others the first
   n - T + 1 shingles make short lists, and the rest is never posted;
3. a list's smallest document is its pivot; documents that share a short list meet in the group of
   its pivot. A group is dealt into chunks of bounded size. In a chunk DivideSkip runs for every
   set: the longest lists (at most T - 1) are set aside, the short ones are merged, sets that
   occur often enough are candidates, and the long lists are probed by binary search in the
   candidates' sorted sets, or counted like the short ones where candidates are many. Sets that are
   known to be connected are not compared again;
4. in a group of several chunks, those outside the group's largest component are compared with all
   chunks, skipping pairs of one component: every pair is either connected already or compared.

So a group of n near copies costs its chunks, not n squared, and what leaves a chunk is one edge a
document, to the smallest it is connected with. Shingles are 64-bit hashes; frequencies are of the low 40 bits within a shard.

``deduplicate`` counts the rows that go. Up to ``MOST_SENT`` their keys are sent to all tasks, so that
no text is shuffled to drop them; more meet the documents in a plain join.

Defined cases: null or empty texts, and texts without words, have no shingles and link with
nothing. A row without doc_id links with nothing and has no component. In ``jaccard_components``
rows with equal doc_id are one node: linked if any of their texts link. In ``deduplicate`` every row
is a node of its own: rows that share an id are compared by their texts, and repeated rows are
copies of each other; rows without doc_id stay. Further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.blocks import (
    FIRST,
    NO_ID,
    Entries,
    answer_shard,
    by_shard,
    codes_of,
    opened,
    pack,
    row_numbers,
    shard_count,
    unpack,
)
from waybill.llm.graph import components
from waybill.llm.storage import kept
from waybill.llm.texts import NOT_SPACE, grams, groups, mix, utf8, words

SHINGLE = 5
PERCENT = 75
CHUNK = 2048
CHUNK_SHINGLES = 2 << 20
LOW = 5  # bytes of a hash that tell shingles of a shard apart
GROUP = 2 << 20
PROBE = 4096  # entries of lists that are counted in the time that one candidate is probed
MOST_SENT = 500_000  # rows that go, sent to every task (25 bytes each)
_U = np.uint64


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out = []
    for lo, hi in groups(offsets, GROUP):
        part, at = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        h, _, _, ranges = words(part, at, NOT_SPACE)
        g = grams(h, k)
        for a, b in zip(ranges[:-1].tolist(), ranges[1:].tolist(), strict=True):
            if b - a >= k:
                out.append(np.unique(g[a:b - k + 1]))
            else:
                out.append(grams(h[a:b], b - a) if b > a else g[:0])
    return out


def least_common(n: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Shingles that a set of n shares with any partner at least."""
    return -(-percent * n // 100)


def linked(common: np.ndarray, n: int, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (n + m - common)


class Block:
    """A block's shingle sets, the distinct ones among them, and its distinct shingles."""

    def __init__(self, packed: bytes, k: int, number: int | None = None) -> None:
        """With the block's number, rows are known by their numbers instead of their ids."""
        self.ids, self.order, texts = unpack(packed)
        if number is not None:
            known = self.order != NO_ID
            self.order = np.where(known, row_numbers(number, len(texts)), NO_ID)
            self.ids = pa.array(self.order, pa.int64(), mask=~known)
        self.sets = shingle_sets(*utf8(texts), k)
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.one = np.array([mix(s).sum(dtype=_U) for s in self.sets], _U)
        self.two = np.array([mix(s ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U) for s in self.sets], _U)
        self.one = mix(self.one + self.sizes.astype(_U))
        at = np.flatnonzero((self.sizes > 0) & (self.order != NO_ID))
        zero = np.zeros(len(at), np.int64)
        self.entries = Entries([(self.one[at], self.two[at], zero + 1, self.order[at], zero, zero,
                                 at)])
        own = [self.sets[i] for i in self.entries.text.tolist()]
        self.shingles, count = np.unique(np.concatenate([np.zeros(0, _U), *own]),
                                         return_counts=True)
        self.count = np.minimum(count, 255).astype(np.uint8)


ASK = ("kind string, shard int, block long, hash binary, second binary, count binary, "
       "doc binary, start binary")
_ASK = pa.schema([("kind", pa.string()), ("shard", pa.int32()), ("block", pa.int64()),
                  *((c, pa.binary()) for c in ("hash", "second", "count", "doc", "start"))])
ANSWER = "block long, kind string, shard int, data binary"
_ANSWER = pa.schema([("block", pa.int64()), ("kind", pa.string()), ("shard", pa.int32()),
                     ("data", pa.binary())])


def _ask(k: int, shards: int, rows_apart: bool):  # noqa: ANN202
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                      strict=True):
                block = Block(packed, k, number if rows_apart else None)
                rows = [{"kind": "sets", "shard": s, "block": number}
                        | {c: x[lo:hi].tobytes() for c, x in zip(
                            _ASK.names[3:], block.entries.part()[:5], strict=True)}
                        for s, lo, hi in by_shard(block.entries.hash, shards)]
                low = block.shingles.view(np.uint8).reshape(-1, 8)[:, :LOW]
                rows += [{"kind": "shingles", "shard": s, "block": number,
                          "hash": low[lo:hi].tobytes(), "count": block.count[lo:hi].tobytes()}
                         for s, lo, hi in by_shard(block.shingles, shards)]
                yield from pa.Table.from_pylist(rows, _ASK).to_batches()

    return ask


def _frequency(rows: pa.Table) -> pa.Table:
    """For every shingle asked about: 0 if one set holds it, else a class that grows with the
    number of sets (its binary digits)."""
    low = np.frombuffer(b"".join(rows["hash"].to_pylist()), np.uint8).reshape(-1, LOW)
    wide = np.zeros((len(low), 8), np.uint8)
    wide[:, :LOW] = low
    h = wide.view(_U).ravel()
    count = np.frombuffer(b"".join(rows["count"].to_pylist()), np.uint8)
    order = np.argsort(h)
    new = np.ones(len(h), bool)
    new[1:] = h[order[1:]] != h[order[:-1]]
    first = np.flatnonzero(new)
    total = np.add.reduceat(count[order], first, dtype=np.int64)
    kind = np.where(total == 1, 0, np.frexp(total.astype(np.float64))[1]).astype(np.uint8)
    out = np.zeros(len(h), np.uint8)
    out[order] = np.repeat(kind, np.diff(np.append(first, len(h))))
    cut = np.cumsum([0, *(len(x) for x in rows["count"].to_pylist())])
    return pa.table([rows["block"], rows["kind"], rows["shard"],
                     pa.array([out[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:],
                                                                  strict=True)], pa.binary())],
                    schema=_ANSWER)


def _answer(rows: pa.Table) -> pa.Table:
    own, parts = rows["kind"].to_pylist(), []
    for kind, answer in (("sets", answer_shard("sets")), ("shingles", _frequency)):
        at = [i for i, x in enumerate(own) if x == kind]
        if at:
            parts.append(answer(rows.take(pa.array(at))))
    return pa.concat_tables(parts)


SETS = "doc long, n long, one long, two long, shingles binary, short array<long>"
_SETS = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("one", pa.int64()),
                   ("two", pa.int64()), ("shingles", pa.binary()),
                   ("short", pa.list_(pa.int64()))])
# what a row is known by where rows are told apart: its doc_id and two hashes of its text
ROW = ("id", "h1", "h2")
_ROW = pa.schema([(c, pa.int64()) for c in ROW])


def _select(k: int, percent: int, rows_apart: bool):  # noqa: ANN202
    """A row a document: its set's size and hash; for the first holder of a set that may have
    partners also the shingles that are not its own, and the short lists it is in."""

    def select(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        parts, schema = [], _SETS
        if rows_apart:
            schema = pa.unify_schemas([_SETS, _ROW])
        for number, packed in zip(blocks["block"].to_pylist(), blocks["data"].to_pylist(),
                                  strict=True):
            block = Block(packed, k, number if rows_apart else None)
            frequent = codes_of(replies, "shingles", len(block.shingles))
            codes = codes_of(replies, "sets", len(block.entries.hash))
            mine: list[bytes | None] = [None] * len(block.sets)
            short: list[np.ndarray | None] = [None] * len(block.sets)
            for i in block.entries.text[(codes & FIRST) > 0].tolist():
                own = block.sets[i]
                kind = frequent[np.searchsorted(block.shingles, own)]
                common = kind > 0
                n, need = len(own), least_common(len(own), percent)
                if common.sum() < need:
                    continue
                order = np.argsort(kind, kind="stable")[:n - need + 1]
                mine[i] = own[common].tobytes()
                short[i] = own[order[common[order]]].view(np.int64)
            held = opened(packed).rename_columns({"doc_id": "id"}).select(ROW) if rows_apart else []
            parts.append(pa.table(
                [block.ids.cast(pa.int64()), pa.array(block.sizes),
                 pa.array(block.one.view(np.int64)), pa.array(block.two.view(np.int64)),
                 pa.array(mine, pa.binary()), pa.array(short, pa.list_(pa.int64())),
                 *held], schema=schema))
        return pa.concat_tables(parts) if parts else schema.empty_table()

    return select


class Chunk:
    """Sets with an inverted index: for each shingle the sets that hold it."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray) -> None:
        self.sets, self.sizes = sets, sizes
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        every = np.concatenate([np.zeros(0, _U), *sets])
        order = np.argsort(every, kind="stable")
        self.members = owner[order]
        self.shingles, self.first = np.unique(every[order], return_index=True)
        self.last = np.append(self.first[1:], len(every))

    def search(self, own: np.ndarray, n: int, allowed: np.ndarray, percent: int) -> np.ndarray:
        """The allowed sets that link with this one."""
        need = least_common(n, percent)
        at = np.searchsorted(self.shingles, own)
        at[at == len(self.shingles)] = 0
        held = self.shingles[at] == own if len(self.shingles) else np.zeros(len(own), bool)
        own, at = own[held], at[held]
        if len(own) < need or not allowed.any():
            return np.zeros(0, np.int64)
        length = self.last[at] - self.first[at]
        order = np.argsort(length, kind="stable")
        # DivideSkip: the longer the longest list, the fewer lists are set aside
        aside = min(need - 1, int(need / (0.01 * np.log2(length.max() + 1) + 1) * 0.5))
        short, long = order[:len(order) - aside], order[len(order) - aside:]
        count = self._merged(at[short], length[short])
        fits = ((count >= need - aside) & allowed
                & (100 * np.minimum(self.sizes, n) >= percent * np.maximum(self.sizes, n)))
        found = np.flatnonzero(fits)
        if not len(found):
            return found
        if len(found) * (len(long) + PROBE) < length[long].sum():
            common = count[found] + np.array(
                [np.isin(own[long], self.sets[i], assume_unique=True).sum()
                 if len(long) * 8 > len(self.sets[i]) else self._probe(own[long], self.sets[i])
                 for i in found.tolist()], np.int64)
        else:
            common = (count + self._merged(at[long], length[long]))[found]
        return found[linked(common, n, self.sizes[found], percent)]

    def _merged(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """In how many of these lists each set occurs."""
        inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        return np.bincount(self.members[np.repeat(self.first[at], length) + inside],
                           minlength=len(self.sets))

    @staticmethod
    def _probe(few: np.ndarray, many: np.ndarray) -> int:
        at = np.searchsorted(many, few)
        at[at == len(many)] = 0
        return int((many[at] == few).sum())


def _join(percent: int):  # noqa: ANN202
    """Links of a chunk, as edges from a label to the smallest label it is connected with: every set
    that ``asks`` against all others of the chunk, skipping sets that are known to be connected."""

    def join(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("asks", "ascending"), ("doc", "ascending")])
        n = rows["n"].to_numpy()
        asks = rows["asks"].combine_chunks().to_numpy(zero_copy_only=False)
        sets = [np.frombuffer(x, _U) for x in rows["shingles"].to_pylist()]
        names, label = np.unique(rows["label"].to_numpy(), return_inverse=True)
        own = label.copy()
        chunk = Chunk(sets, n)
        at = np.arange(len(sets))
        for i in np.flatnonzero(asks).tolist():
            # of two sets that both ask, the later one is compared with the earlier one
            allowed = (label != label[i]) & (~asks | (at < i))
            for other in np.unique(label[chunk.search(sets[i], int(n[i]), allowed, percent)]):
                label[label == other] = label[i]
        low = np.full(len(names), len(names))
        np.minimum.at(low, label, own)
        edges = np.unique(np.stack([own, low[label]])[:, own != low[label]], axis=1)
        return pa.table({"u": names[edges[0]], "v": names[edges[1]]},
                        schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))

    return join


def _chunks(docs: Column, shingles: Column) -> Column:
    return F.greatest(F.ceil(docs / CHUNK), F.ceil(shingles / CHUNK_SHINGLES)).cast("int")


def link_components(sets: DataFrame, copies: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, component) of every doc that links with another; ``copies``: edges (u, v) of docs
    with equal sets."""
    posts = sets.where("short is not null").select("doc", "n", F.explode("short").alias("s"))
    pivots = posts.groupBy("s").agg(F.min("doc").alias("pivot"), F.count("*").alias("k")).where(
        "k > 1").select("s", "pivot")
    members = kept(posts.join(pivots, "s").select("pivot", "doc", "n").distinct(), "members")
    size = members.groupBy("pivot").agg(
        _chunks(F.count("*"), F.sum("n")).alias("chunks"))
    salted = F.pmod(F.xxhash64(F.lit(17), "doc"), F.col("chunks")).cast("int")
    placed = kept(members.join(size, "pivot").withColumn("chunk", salted), "chunks")
    held = sets.where("short is not null").select("doc", "shingles")
    near = kept(
        placed.join(held, "doc")
        .select("pivot", "chunk", "doc", "n", "shingles", F.lit(True).alias("asks"),
                F.col("doc").alias("label"))
        .groupBy("pivot", "chunk").applyInArrow(_join(percent), "u long, v long"), "near")
    named = components(near.union(copies))
    if (placed.agg(F.max("chunks")).first()[0] or 1) == 1:
        return named
    # groups of several chunks: who is not in the largest component meets every chunk
    named = kept(named, "named")
    wide = kept(placed.where("chunks > 1").join(
        named.select(F.col("node").alias("doc"), "component"), "doc", "left")
        .select("pivot", "chunk", "chunks", "doc", "n",
                F.coalesce("component", "doc").alias("label")), "wide")
    main = (wide.groupBy("pivot", "label").agg(F.count("*").alias("k")).groupBy("pivot")
            .agg(F.max_by("label", F.struct("k", "label")).alias("main")))
    rest = kept(wide.join(main, "pivot").where("label <> main").drop("main"), "rest")
    parts = rest.groupBy("pivot").agg(_chunks(F.count("*"), F.sum("n")).alias("parts"))
    askers = rest.join(parts, "pivot").select(
        "pivot", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        F.pmod(F.xxhash64(F.lit(19), "doc"), F.col("parts")).cast("int").alias("part"), "doc",
        "n", "label", F.lit(True).alias("asks"))
    asked = wide.join(parts, "pivot").select(
        "pivot", "chunk", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        "doc", "n", "label", F.lit(False).alias("asks"))
    far = kept(askers.union(asked).join(held, "doc").groupBy("pivot", "chunk", "part").applyInArrow(
        _join(percent), "u long, v long"), "far")
    if far.isEmpty():
        return named
    return components(named.select(F.col("node").alias("u"), F.col("component").alias("v"))
                      .where("u <> v").union(far))


def shingled(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT,
             rows_apart: bool = False) -> DataFrame:
    """A row a document: doc, n, the set's hash, and what the join needs of it. With
    ``rows_apart`` doc is the number of the row, and ``ROW`` (from columns of docs) follows."""
    blocks = pack(docs, "jaccard-blocks", more=ROW[1:] if rows_apart else ())
    shards = shard_count(blocks)
    replies = kept(blocks.select("block", "data").mapInArrow(_ask(k, shards, rows_apart), ASK)
                   .groupBy("shard").applyInArrow(_answer, ANSWER), "jaccard-answers")
    more = "".join(f", {c} long" for c in ROW) if rows_apart else ""
    return kept(blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        _select(k, percent, rows_apart), SETS + more), "jaccard-sets")


def _components(sets: DataFrame, percent: int) -> DataFrame:
    """(node, component) of every doc that links with another."""
    # copies hang on the first of their kind; rows of one doc_id are one node
    held = sets.select("doc", "n", "one", "two").where("n > 0 and doc is not null")
    first = kept(held.groupBy("one", "two").agg(F.min("doc").alias("first")), "first")
    copies = held.join(first, ["one", "two"]).where("doc <> first").select(
        F.col("doc").alias("u"), F.col("first").alias("v"))
    return link_components(sets, copies, percent)


def jaccard_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """A row a document: doc_id, n_shingles, component_id."""
    sets = shingled(docs, k, percent)
    named, slim = _components(sets, percent), sets.select("doc", "n")
    return slim.join(named, slim["doc"] == named["node"], "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component_id"))


def deduplicate(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents, all columns, with one row of each component: that with the smallest doc_id,
    among rows that share it the one with the smallest hash of its text, and among equal rows the
    one with the smallest hash of its other columns. Rows without doc_id stay."""
    key = [F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("h1"),
           F.xxhash64(F.lit(29), "text").alias("h2")]
    sets = shingled(docs.select("doc_id", "text", *key[1:]), k, percent, rows_apart=True)
    named = _components(sets, percent)
    linked_rows = kept(sets.select("doc", *ROW).join(named, F.col("doc") == F.col("node"))
                       .select("component", *ROW), "jaccard-rows")
    place = F.struct(*ROW)
    best = linked_rows.groupBy("component").agg(F.min(place).alias("best"))
    judged = linked_rows.join(best, "component").groupBy(*ROW).agg(
        F.count("*").alias("k"), F.max(place == F.col("best")).alias("stays"))
    judged = kept(judged.where("not stays or k > 1"), "jaccard-gone").select(
        *(F.col(c).alias(f"g_{c}") for c in ROW), "stays")
    if judged.count() <= MOST_SENT:  # else texts are shuffled to meet them
        judged = F.broadcast(judged)
    same = [F.col(c) == F.col(f"g_{c}") for c in ROW]
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(row, *key).join(judged, same, "left").where("stays is null or stays")
    if judged.where("stays").isEmpty():
        return rows.select("row.*")
    # only repeated rows meet, and no more than one a task
    ordered = [f"row.`{f.name}`" for f in docs.schema.fields
               if "map<" not in f.dataType.simpleString()]
    again = rows.where("stays").groupBy(*ROW).agg(
        F.min_by("row", F.xxhash64(*ordered)).alias("row"))
    return rows.where("stays is null").select("row.*").union(again.select("row.*"))


SQL = r"""
with recursive d as (
  select doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
s as (select doc_id, list_distinct(list_transform(
        range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) as s
      from d where len(w) > 0),
p as (select doc_id, len(s) as n, unnest(s) as g from s),
c as (select a.doc_id as a, b.doc_id as b, any_value(a.n) as n, any_value(b.n) as m,
             count(*) as k
      from p a join p b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
l as (select a, b from c where 100 * k >= 75 * (n + m - k)),
reach(a, b) as (select a, b from l union select r.a, l.b from reach r join l on r.b = l.a),
low as (select a, min(b) as low from reach group by a)
select d.doc_id, coalesce(len(s.s), 0) as n_shingles,
       coalesce(least(low.low, d.doc_id), d.doc_id) as component_id
from d left join s on d.doc_id = s.doc_id left join low on d.doc_id = low.a
"""
