"""Documents packed into blocks, for operators that ask the whole corpus about many small pieces.

A block is about a megabyte of whole texts in one row, compressed. An operator walks through its
blocks, asks shards (dealt by hash) about the distinct pieces of each block in one message a block
and shard, and gets one answer back for each message. So a piece that is found in a third of all
documents costs one entry a block, not one a document, and answers find their way by block number.
Blocks are a table in the shared folder: numbering and content never change between passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.storage import kept
from waybill.llm.texts import groups, mix, utf8

BLOCK = 1 << 20
MAX_DOCS = 1 << 14
SHARD_BYTES = 8 << 20
LEAST_SHARDS = 256
NO_ID = np.iinfo(np.int64).max
REPEATED, FIRST, COMPARE, SPLIT = 1, 2, 4, 8
_U = np.uint64


def pack(docs: DataFrame, name: str, size: int = BLOCK, more: tuple[str, ...] = ()) -> DataFrame:
    """(block, bytes, data) with the columns doc_id, text and ``more`` in ``data``."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            _, offsets = utf8(batch.column(1))
            for lo, hi in groups(offsets, size):
                for a in range(lo, hi, MAX_DOCS):
                    part = batch.slice(a, min(hi, a + MAX_DOCS) - a)
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                        out.write_batch(part)
                    held = int(offsets[a + part.num_rows] - offsets[a])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number], pa.int64()), pa.array([held], pa.int64()),
                         pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                        ["block", "bytes", "data"])
                    number += 1

    return kept(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *more).mapInArrow(
        fold, "block long, bytes long, data binary"), name, compression="none")


def opened(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all().combine_chunks()


def row_numbers(block: int, rows: int) -> np.ndarray:
    """One number for each row of a block, as lasting as the table of blocks: up to 2**25 tasks
    of 2**24 blocks."""
    return (((block >> 32) << 38) | ((block & 0xFFFFFFFF) << 14)) + np.arange(rows)


def unpack(data: bytes) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """(doc ids, the ids with nulls as the largest number, texts) of a block."""
    rows = opened(data)
    ids = rows["doc_id"].combine_chunks()
    return (ids, np.array(ids.fill_null(NO_ID)).astype(np.int64),
            rows["text"].combine_chunks() if rows.num_rows else pa.array([], pa.string()))


def shard_count(blocks: DataFrame, size: int = SHARD_BYTES) -> int:
    """As many shards as the corpus has such pieces; a power of two."""
    whole = blocks.agg(F.sum("bytes")).first()[0] or 0
    n = LEAST_SHARDS
    while n * size < whole:
        n *= 2
    return n


def by_shard(sorted_hashes: np.ndarray, shards: int) -> Iterator[tuple[int, int, int]]:
    """(shard, from, to) of the non-empty shards; shards are ranges of the hash."""
    if not len(sorted_hashes):
        return
    shard = (sorted_hashes >> np.uint64(65 - shards.bit_length())).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
    for lo, hi in zip(cut, [*cut[1:], len(shard)], strict=True):
        yield int(shard[lo]), int(lo), int(hi)


class Entries:
    """The distinct pieces of a block, sorted by hash, with count and first holder."""

    def __init__(self, parts: list[tuple[np.ndarray, ...]]) -> None:
        """Each part: hash, second hash, count, order of the text, start, end, text."""
        kinds = (_U, _U, *[np.int64] * 5)
        rows = [np.concatenate([np.zeros(0, t), *(p[i] for p in parts)]).astype(t)
                for i, t in enumerate(kinds)]
        order = np.lexsort((rows[6], rows[4], rows[3], rows[1], rows[0]))
        rows = [r[order] for r in rows]
        new = np.ones(len(order), bool)
        new[1:] = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])
        at = np.flatnonzero(new)
        self.hash, self.second, _, self.doc, self.start, self.end, self.text = (
            r[at] for r in rows)
        self.count = np.add.reduceat(rows[2], at) if len(at) else rows[2]
        self._find = mix(self.hash) + self.second
        self._order = np.argsort(self._find)

    def part(self) -> tuple[np.ndarray, ...]:
        return self.hash, self.second, self.count, self.doc, self.start, self.end, self.text

    def find(self, hashes: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Which entry each piece is; every piece must be one."""
        if not len(hashes):
            return np.zeros(0, np.int64)
        return self._order[np.searchsorted(self._find, mix(hashes) + second,
                                           sorter=self._order)]


def asks(entries: Entries, block: int, shards: int) -> pa.RecordBatch | None:
    rows = [(shard, block, *(x[lo:hi].tobytes() for x in entries.part()[:5]))
            for shard, lo, hi in by_shard(entries.hash, shards)]
    if not rows:
        return None
    types = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
    names = ["shard", "block", "hash", "second", "count", "doc", "start"]
    return pa.RecordBatch.from_arrays(
        [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names)


ASK = ("shard int, block long, hash binary, second binary, count binary, doc binary, "
       "start binary")
ANSWER = "block long, kind string, shard int, data binary"
ANSWER_SCHEMA = pa.schema([("block", pa.int64()), ("kind", pa.string()), ("shard", pa.int32()),
                     ("data", pa.binary())])


def column(rows: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(rows[name].to_pylist()), kind)


def answer_shard(kind: str, hot: int = 0):  # noqa: ANN202
    """What a shard knows of each entry that it was asked about: is it found more than once, is
    this its first holder; and, with ``hot``, has its hash other entries that it must be compared
    with, or more than ``hot`` of them."""

    def answer(rows: pa.Table) -> pa.Table:
        sizes = np.array([len(x) // 8 for x in rows["hash"].to_pylist()])
        h, s = column(rows, "hash", _U), column(rows, "second", _U)
        count, doc, start = (column(rows, c, np.int64) for c in ("count", "doc", "start"))
        order = np.lexsort((start, doc, s, h))
        h, s = h[order], s[order]
        new_h = np.ones(len(h), bool)
        new_h[1:] = h[1:] != h[:-1]
        new = new_h.copy()
        new[1:] |= s[1:] != s[:-1]
        piece = np.cumsum(new) - 1
        total = np.add.reduceat(count[order], np.flatnonzero(new))
        code = np.where(total[piece] > 1, REPEATED, 0) | np.where(new, FIRST, 0)
        if hot:
            group = np.cumsum(new_h) - 1
            different = np.bincount(group[new], minlength=group[-1] + 1)[group]
            code |= np.where((different > 1) & (different <= hot) & new, COMPARE, 0)
            code |= np.where(different > hot, SPLIT, 0)
        back = np.zeros(len(h), np.uint8)
        back[order] = code
        cut = np.concatenate([[0], np.cumsum(sizes)])
        return pa.table([rows["block"], pa.array([kind] * len(sizes)), rows["shard"],
                         pa.array([back[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:],
                                                                       strict=True)],
                                  pa.binary())], schema=ANSWER_SCHEMA)

    return answer


def codes_of(replies: pa.Table, kind: str, size: int) -> np.ndarray:
    """The answers of all shards, in the order of the entries."""
    own = [(s, d) for s, d, k in zip(replies["shard"].to_pylist(), replies["data"].to_pylist(),
                                     replies["kind"].to_pylist(), strict=True) if k == kind]
    out = np.frombuffer(b"".join(d for _, d in sorted(own)), np.uint8)
    if len(out) != size:
        raise ValueError(f"{len(out)} answers for {size} entries")
    return out
