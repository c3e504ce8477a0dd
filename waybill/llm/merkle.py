"""Merkle manifest of a dataset: a tree of digests in which every document can be re-checked alone.

A leaf is the digest of a document's fields. Per group (``lang``), leaves ascend by id; every
``arity`` consecutive nodes become the digest of their concatenated hex digests (the last run may be
shorter, down to one) until one node remains, the group's subroot; a lone leaf is its own subroot.
Subroots, ordered by group, give the root in the same way.

A parent keeps a copy of its hash state from before each child slot. To fold a changed child into
it, the state of that slot is resumed and takes the replacement and the siblings to its right; what
lies to the left is in the state already. So the new root of one changed document costs one resumed
state a level, and no digest of another document is made again.

Scale: leaves are numbered by a range-partitioned sort, each partition counted once. A group is cut
into chunks of about a thousand consecutive leaves, whole subtrees, however large the group is: a
chunk's top is a node of the next layer, and each layer is a job with as many tasks as it has
chunks. The way from a chunk's top to the root (a few siblings a level) comes down layer by layer,
so that in the end every chunk folds its own leaves to the root in one task. Texts never leave the
scan; all tables hold digests and lie in the shared folder. The driver sees how many nodes the
largest group has.

Defined cases: a null field is ``-``, another its UTF-8 length, a colon and its value, so that no
two rows write alike. A null group is a group of its own, the first. A null id comes before all
others; rows with the same id are leaves of their own, ordered by digest. An empty table has no
root and gives no rows. Columns that are no fields are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waybill.llm.storage import kept

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 2
CHUNK = 1024


def leaf(values: Iterable[Column]) -> Column:
    """The digest of a row's fields, 32 bytes."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text),
                          F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(field, values)).cast("binary"), 256))


class Parent:
    """A node that keeps the hash states from before each of its child slots."""

    __slots__ = ("children", "digest", "states")

    def __init__(self, children: list[bytes]) -> None:
        self.children, self.states, state = children, [], sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def siblings(self, slot: int) -> tuple[bytes, bytes]:
        return b"".join(self.children[:slot]), b"".join(self.children[slot + 1:])

    def fold(self, slot: int, child: bytes) -> bytes:
        """The node's digest with another child in a slot."""
        state = self.states[slot].copy()
        state.update(child)
        for right in self.children[slot + 1:]:
            state.update(right)
        return state.hexdigest().encode()


class Step:
    """A parent above the chunk: the state behind the left siblings, and the right ones."""

    __slots__ = ("right", "state")

    def __init__(self, left: bytes, right: bytes) -> None:
        self.state, self.right = sha256(left), right

    def fold(self, child: bytes) -> bytes:
        state = self.state.copy()
        state.update(child)
        state.update(self.right)
        return state.hexdigest().encode()


def height(n: int, arity: int) -> int:
    """Levels above n nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


class Subtree:
    """The levels of one chunk, from its nodes to its top."""

    def __init__(self, nodes: list[bytes], levels: int, arity: int) -> None:
        self.arity, self.levels, self.top = arity, [], nodes
        for _ in range(levels):
            parents = [Parent(self.top[i:i + arity]) for i in range(0, len(self.top), arity)]
            self.levels.append(parents)
            self.top = [p.digest for p in parents]

    def way(self, at: int) -> Iterator[tuple[Parent, int]]:
        for parents in self.levels:
            at, slot = divmod(at, self.arity)
            yield parents[at], slot


class Shape(NamedTuple):
    """Children of a node, and levels of a chunk."""

    arity: int
    levels: int

    @property
    def chunk(self) -> Column:
        return F.floor(F.col("pos") / self.arity ** self.levels).cast("long").alias("chunk")

    def read(self, rows: pa.Table) -> tuple[pa.Table, Subtree]:
        """A chunk's rows in order, and the tree above them."""
        rows = rows.sort_by("pos")
        nodes = [x.hex().encode() for x in rows["digest"].to_pylist()]
        levels = min(self.levels, height(rows["n"][0].as_py(), self.arity))
        return rows, Subtree(nodes, levels, self.arity)


def shape(arity: int = ARITY, chunk: int = CHUNK) -> Shape:
    """Chunks of at most ``chunk`` nodes, at least of one parent."""
    return Shape(arity, max(1, height(chunk + 1, arity) - 1))


NODE = "key string, pos long, n long, digest binary"
_NODE = pa.schema([("key", pa.string()), ("pos", pa.int64()), ("n", pa.int64()),
                   ("digest", pa.binary())])


def _tops(form: Shape):  # noqa: ANN202
    def tops(rows: pa.Table) -> pa.Table:
        rows, tree = form.read(rows)
        pos, n = rows["pos"][0].as_py(), rows["n"][0].as_py()
        for _ in tree.levels:
            pos, n = pos // form.arity, -(-n // form.arity)
        (top,) = tree.top
        return pa.Table.from_pylist([{"key": rows["key"][0].as_py(), "pos": pos, "n": n,
                                      "digest": bytes.fromhex(top.decode())}], _NODE)

    return tops


# a way up is text: left siblings, a slash, right siblings, a comma between levels
WAY = "key string, pos long, way string"
_WAY = pa.schema([("key", pa.string()), ("pos", pa.int64()), ("way", pa.string())])


def _ways(form: Shape):  # noqa: ANN202
    def ways(rows: pa.Table, above: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _WAY.empty_table()
        rows, tree = form.read(rows)
        rest = above["way"].to_pylist()
        own = [",".join([*("/".join(x.decode() for x in parent.siblings(slot))
                           for parent, slot in tree.way(i)), *filter(None, rest)])
               for i in range(rows.num_rows)]
        return pa.table([rows["key"], rows["pos"], pa.array(own, pa.string())], schema=_WAY)

    return ways


AUDIT = "id string, leaf string, proof_sha256 string, folded_root string, key string"
_AUDIT = pa.schema([(c.split()[0], pa.string()) for c in AUDIT.split(", ")])


def _folds(form: Shape):  # noqa: ANN202
    def folds(rows: pa.Table, above: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _AUDIT.empty_table()
        rows, tree = form.read(rows)
        (way,) = above["way"].to_pylist()
        steps = [x.encode().split(b"/") for x in way.split(",") if way]
        upper, proof_above = [Step(*x) for x in steps], b"".join(b"".join(x) for x in steps)
        out = []
        for i, (own, new) in enumerate(zip(rows["digest"].to_pylist(), rows["changed"].to_pylist(),
                                           strict=True)):
            node, proof = (new or own).hex().encode(), sha256()
            for parent, slot in tree.way(i):
                for side in parent.siblings(slot):
                    proof.update(side)
                node = parent.fold(slot, node)
            proof.update(proof_above)
            for step in upper:
                node = step.fold(node)
            out.append((own.hex(), proof.hexdigest(), node.decode()))
        columns = [pa.array(x, pa.string()) for x in zip(*out, strict=True)]
        return pa.table([rows["id"], *columns, rows["key"]], schema=_AUDIT)

    return folds


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds ``pos``, the place within ``key`` by ``order``, and ``n``, the size of the key."""
    by = [F.col(c).asc_nulls_first() for c in ("key", *order)]
    # a row's number within its sorted partition, and the partition, are both in this id
    stored = kept(rows.repartitionByRange(*by).sortWithinPartitions(*by)
                  .withColumn("at", F.monotonically_increasing_id())
                  .withColumn("part", F.shiftright("at", 33)), name)
    parts = stored.groupBy("key", "part").agg(F.min("at").alias("first"),
                                              F.count("*").alias("size"))
    whole = Window.partitionBy("key")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.select("key", "part", F.sum("size").over(whole).alias("n"), (
        F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return stored.join(shift, ["key", "part"]).select(
        *rows.columns, (F.col("at") + F.col("shift")).alias("pos"), "n")


class Manifest(NamedTuple):
    """Layers of nodes (key, pos, n, digest) from the leaves to the subroots, and from those to
    the root; each layer is a table."""

    form: Shape
    layers: list[DataFrame]
    upper: list[DataFrame]


def _grown(nodes: DataFrame, form: Shape) -> list[DataFrame]:
    layers = [nodes]
    while (layers[-1].agg(F.max("n")).first()[0] or 0) > 1:
        layers.append(kept(layers[-1].select("key", "pos", "n", "digest").groupBy(
            "key", form.chunk).applyInArrow(_tops(form), NODE), "merkle-layer"))
    return layers


def build(docs: DataFrame, group: str = "lang", key: str = "doc_id",
          fields: Iterable[str] = FIELDS, changed: Column | None = None,
          form: Shape = shape()) -> Manifest:
    """The manifest of a table. ``changed``: a leaf digest (see ``leaf``) to be folded in place of
    the row's own by ``audit``, null where there is none."""
    name = F.col(group).cast("string")
    leaves = docs.select(
        # the order of these names is that of the groups, null first
        F.coalesce(F.concat(F.lit("s"), name), F.lit("n")).alias("key"),
        F.col(key).alias("id"), leaf(F.col(c) for c in fields).alias("digest"),
        (F.lit(None).cast("binary") if changed is None else changed).alias("changed"))
    # stored before the sort, so that texts are read once
    placed = numbered(kept(leaves, "merkle-leaves"), ["id", "digest"], "merkle-sorted")
    layers = _grown(kept(placed, "merkle-layer"), form)
    tops = layers[-1].select(F.lit("").alias("key"), F.col("key").alias("id"), "digest")
    return Manifest(form, layers, _grown(
        kept(numbered(tops, ["id"], "merkle-subroots"), "merkle-layer"), form))


def _down(layers: list[DataFrame], way: DataFrame, form: Shape) -> DataFrame:
    """The ways of a layer's nodes, from those of the nodes above the last of ``layers``."""
    for layer in reversed(layers):
        way = kept(layer.select("key", "pos", "n", "digest").groupBy("key", form.chunk).cogroup(
            way.groupBy("key", "pos")).applyInArrow(_ways(form), WAY), "merkle-ways")
    return way


def roots(manifest: Manifest) -> DataFrame:
    """(key, subroot, root): a row a group, the key as in the layers."""
    top = manifest.upper[-1].first()  # one row, or none where there are no groups
    return manifest.layers[-1].select(
        "key", F.lower(F.hex("digest")).alias("subroot"),
        F.lit(top and top["digest"].hex()).cast("string").alias("root"))


def audit(manifest: Manifest) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified): a row a leaf."""
    form, layers, upper = manifest
    spark = layers[0].sparkSession
    one = spark.createDataFrame([("", 0, "")], WAY)
    above = _down(upper[:-1], one, form)
    if len(upper) > 1:  # from places in the root's tree to the groups
        above = upper[0].join(above.select("pos", "way"), "pos")
    else:
        above = upper[0].withColumn("way", F.lit(""))
    way = _down(layers[1:-1], above.select(F.col("id").alias("key"),
                                           F.lit(0).cast("long").alias("pos"), "way"), form)
    rows = layers[0].select("key", "pos", "n", "digest", "changed",
                            F.col("id").cast("string").alias("id"))
    # a leaf whose group has no other is its own subroot: one chunk without levels
    folded = rows.groupBy("key", form.chunk).cogroup(way.groupBy("key", "pos")).applyInArrow(
        _folds(form), AUDIT)
    kind = layers[0].schema["id"].dataType
    return folded.join(roots(manifest), "key").select(
        F.col("id").cast(kind).alias("id"), "leaf", "subroot", "root", "proof_sha256",
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def tampered(doc_id: Column) -> Column:
    """A leaf with one character more in n_chars, for every seventh id by its checksum."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0
    return F.when(hit, leaf(F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS))


def digest(docs: DataFrame) -> DataFrame:
    return audit(build(docs, changed=tampered(F.col("doc_id")))).withColumnRenamed("id", "doc_id")


SQL = """
with recursive d as (
  select doc_id, lang, sha256(a || n || t) as leaf,
         case when crc % 7 = 0 then sha256(a || n1 || t) else sha256(a || n || t) end as other
  from (
    select *, f(doc_id::varchar) || f(source) || f(lang) as a, f(n_chars::varchar) as n,
           f((n_chars + 1)::varchar) as n1, f(text) as t,
           xor(4294967295, list_reduce(
             list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint),
             lambda c, b: list_reduce(
               [0::bigint, 0, 0, 0, 0, 0, 0, 0],
               lambda x, i: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end,
               xor(c, b)), 4294967295::bigint)) as crc
    from documents)),
leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
         count(*) over (partition by lang) as n from d),
low(level, lang, pos, n, digest) as (
  select 0, lang, pos, n, leaf from leaves
  union all
  select level + 1, lang, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' order by pos))
  from low where n > 1 group by level, lang, pos // 2, n),
tops as (
  select lang, digest as subroot, row_number() over (order by lang nulls first) - 1 as top,
         count(*) over () as n from low where n = 1),
high(level, pos, n, digest) as (
  select 0, top, n, subroot from tops
  union all
  select level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' order by pos))
  from high where n > 1 group by level, pos // 2, n),
nodes as (  -- levels of the root's tree follow those of the group's
  select level, lang, pos, n, digest from low where n > 1
  union all
  select t.level + h.level, t.lang, h.pos, h.n, h.digest
  from (select lang, max(level) as level from low group by lang) t, high h where h.n > 1),
depth as (select lang, max(level) as level from low group by lang),
fold(doc_id, lang, pos, leaf, level, place, cur, proof) as (
  select doc_id, lang, pos, leaf, 0, case when n = 1 then top else pos end, other, ''
  from (select l.*, t.top from leaves l join tops t on l.lang is not distinct from t.lang)
  union all
  select doc_id, lang, pos, leaf, level + 1,
         case when level + 1 = top_level then top else place // 2 end,
         sha256(case when place % 2 = 1 then other || cur else cur || coalesce(other, '') end),
         proof || coalesce(other, '')
  from (select f.*, s.digest as other, t.top, d.level as top_level
        from fold f join tops t on f.lang is not distinct from t.lang
        join depth d on f.lang is not distinct from d.lang
        join nodes m on m.level = f.level and m.pos = f.place and m.lang is not distinct from f.lang
        left join nodes s on s.level = f.level and s.pos = xor(f.place, 1)
             and s.lang is not distinct from f.lang)),
done as (select *, row_number() over (partition by lang, pos order by level desc) as k from fold),
root as (select digest as root from high where n = 1)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, cur as folded_root,
       cur = root as verified
from done join tops on done.lang is not distinct from tops.lang, root where k = 1
"""
# fields as in ``leaf``; DuckDB's macros are statements of their own, so the calls are written out
for _name in ("doc_id::varchar", "source", "lang", "n_chars::varchar", "(n_chars + 1)::varchar",
              "text"):
    SQL = SQL.replace(f"f({_name})",
                      f"coalesce(strlen({_name}) || ':' || {_name}, '-')")
