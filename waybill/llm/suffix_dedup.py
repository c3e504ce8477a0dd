"""Removal of repeated byte strings by hashes of runs and suffix ranks at a fixed depth.

A text is its UTF-8 bytes; matches never cross texts. A byte goes if a string of ``LENGTH`` bytes
that covers it occurs more than once: with ``keep="first"`` every occurrence but the first (in
order of doc_id and place) loses its bytes, with ``keep="none"`` every occurrence does. Strings
are judged on the input, and overlaps count.

One suffix array over all texts would not fit any machine, so the suffixes are dealt exactly. The
strings of LENGTH bytes that start in a text fall into runs that share an anchor, the place with
the smallest hash of ``ANCHOR`` bytes inside them. Equal strings have equal anchors, so only runs
with the same anchor need be compared:

1. each block asks, once a distinct run, how often its anchor and its content occur (by hash);
2. runs whose anchor is alone are done; runs found twice are repeated as a whole;
3. of an anchor with different runs one holder a run is sent to the anchor's shard, where the
   suffixes of its runs are sorted to depth LENGTH by prefix doubling. In that order equal strings
   are neighbours: one to the left with the same rank is an earlier copy (a previous factor of
   LENGTH bytes), one to the right a later one. No longer factors are computed;
4. an anchor with more than ``HOT`` different runs (a very common phrase in changing company) is
   split: its strings are sent as hashes, dealt by the whole string;
5. blocks gather the answers and rewrite their texts.

Runs that are copies of each other are one entry a block and one in the suffix array, however many
documents hold them.

Defined cases: null is empty; texts shorter than LENGTH stay. Rows without doc_id come last in the
order of documents; rows with the same doc_id are texts of their own, in order of place. Further
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.blocks import (
    ANSWER,
    ANSWER_SCHEMA,
    ASK,
    COMPARE,
    FIRST,
    REPEATED,
    SPLIT,
    Entries,
    answer_shard,
    asks,
    by_shard,
    codes_of,
    column,
    pack,
    shard_count,
    unpack,
)
from waybill.llm.storage import kept
from waybill.llm.texts import BYTE_VALUE, groups, mix, powers, utf8

LENGTH = 200
ANCHOR = 48
HOT = 1024
HELD = 2 << 20
PIECE = 1 << 16  # sums and minima of a piece fit a processor's cache
SORT_BYTES = 2 << 20
_U = np.uint64
_POS = _U((1 << 20) - 1)


@dataclass
class Runs:
    """Runs of strings with one anchor: first start, last start, hashes of anchor and content."""

    low: np.ndarray
    high: np.ndarray
    anchor: np.ndarray
    content: np.ndarray
    total: np.ndarray
    begin: int = 0

    def windows(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All strings that start in these runs: start, hash, run."""
        low, high = self.low[at], self.high[at]
        many = high - low + 1
        run = np.repeat(at, many)
        start = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(
            low, many)
        i = start - self.begin
        return start, mix((self.total[i + length] - self.total[i])
                          * powers(len(self.total), inverse=True)[i]), run


def _runs(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> Runs:
    """Runs of a piece of at most PIECE + length bytes; positions from its begin."""
    n = len(data)
    value = BYTE_VALUE[data]
    value *= powers(n)
    total = np.zeros(n + 1, _U)
    np.cumsum(value, out=total[1:])
    inverse = powers(n + 1, inverse=True)
    grams = mix((total[anchor:] - total[:-anchor]) * inverse[:n - anchor + 1])
    key = (grams & ~_POS) | np.arange(len(grams), dtype=_U)
    w = length - anchor + 1
    rows = -(-len(key) // w)
    padded = np.full(rows * w, ~_U(0))
    padded[:len(key)] = key
    padded = padded.reshape(rows, w)
    head = np.minimum.accumulate(padded, axis=1).ravel()
    tail = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - length + 1
    place = np.minimum(tail[:m], head[w - 1:w - 1 + m]) & _POS
    mark = np.zeros(m + 1, np.int32)
    long = np.diff(offsets) >= length
    np.add.at(mark, offsets[:-1][long], 1)
    np.add.at(mark, offsets[1:][long] - length + 1, -1)
    valid = np.cumsum(mark[:m]) > 0
    same = place[1:] == place[:-1]
    new = valid.copy()
    new[1:] &= ~(valid[:-1] & same)
    last = valid.copy()
    last[:-1] &= ~(valid[1:] & same)
    low, high = np.flatnonzero(new), np.flatnonzero(last)
    at = place[low].astype(np.int64)
    content = (total[high + length] - total[low]) * inverse[low]
    shape = ((high - low).astype(_U) << _U(32)) | (at - low).astype(_U)
    # anchors are small hashes; mixed again they spread evenly over the shards
    return Runs(low, high, mix(grams[at]), mix(content ^ mix(shape)), total)


def _pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(begin, end, offsets within) of pieces that hold every string of LENGTH bytes once."""
    for lo, hi in groups(offsets, PIECE):
        begin, end = int(offsets[lo]), int(offsets[hi])
        if hi - lo > 1 or end - begin <= PIECE + length:
            if end - begin >= length:
                yield begin, end, offsets[lo:hi + 1] - begin
            continue
        for at in range(begin, end - length + 1, PIECE):
            stop = min(at + PIECE + length - 1, end)
            yield at, stop, np.array([0, stop - at])


def _all_runs(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int
              ) -> Iterator[tuple[Runs, np.ndarray]]:
    """Runs piece by piece, with positions in the block, and the text of each."""
    for begin, end, own in _pieces(offsets, length):
        runs = _runs(data[begin:end], own, length, anchor)
        runs.low += begin
        runs.high += begin
        runs.begin = begin
        yield runs, np.searchsorted(offsets, runs.low, side="right") - 1


@dataclass
class Block:
    """A block's texts and their runs, which stay in memory up to ``HELD`` bytes of text (some
    ten times that in sums); those of a larger block are made again."""

    ids: pa.Array
    order: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    length: int
    anchor: int
    entries: Entries
    held: list[tuple[Runs, np.ndarray]] | None

    @classmethod
    def of(cls, packed: bytes, length: int, anchor: int, again: bool = False) -> Block:
        """``again``: whether the runs are read once more."""
        ids, order, texts = unpack(packed)
        data, offsets = utf8(texts)
        found = _all_runs(data, offsets, length, anchor)
        held = list(found) if again and len(data) <= HELD else None
        parts = [Entries([(runs.anchor, runs.content, np.ones(len(text)), order[text],
                           runs.low - offsets[text], runs.high - offsets[text], text)]).part()
                 for runs, text in held or found]
        return cls(ids, order, data, offsets, length, anchor, Entries(parts), held)

    def runs(self) -> Iterator[tuple[Runs, np.ndarray, np.ndarray, np.ndarray]]:
        """Runs, their texts, their entries, and which are their entry's first holder."""
        for runs, text in self.held or _all_runs(self.data, self.offsets, self.length,
                                                 self.anchor):
            at = self.entries.find(runs.anchor, runs.content)
            yield runs, text, at, ((self.entries.text[at] == text)
                                   & (self.entries.start[at] == runs.low - self.offsets[text]))

    def split(self, codes: np.ndarray) -> Entries:
        """The distinct strings of runs with split anchors, by string and anchor."""
        parts = []
        for runs, text, entry, _ in self.runs():
            at = np.flatnonzero(codes[entry] & SPLIT)
            if len(at):
                start, h, run = runs.windows(at, self.length)
                own = start - self.offsets[text[run]]
                parts.append(Entries([(h, runs.anchor[run], np.ones(len(run)),
                                       self.order[text[run]], own, own, text[run])]).part())
        return Entries(parts)


def suffix_ranks(data: np.ndarray, room: np.ndarray, length: int) -> np.ndarray:
    """Rank, in suffix order to this depth, of every position with that much room; else -1.

    ``room``: bytes from each position to the end of its string. Ranks of 8, 16, 32, ... bytes
    are made from pairs of ranks of half the depth; the last pair overlaps.
    """
    n = len(data)
    rank = np.full(n, -1, np.int64)
    depth = 1
    while depth * 2 <= min(length, 8):
        depth *= 2
    key = np.zeros(n, _U)
    for i in range(depth):
        key[:n - i] = (key[:n - i] << _U(8)) | data[i:]
        if i:
            key[n - i:] <<= _U(8)
    at = np.flatnonzero(room >= depth)
    rank[at] = np.unique(key[at], return_inverse=True)[1]
    while depth < length:
        step = min(depth, length - depth)
        at = np.flatnonzero(room >= depth + step)
        pair = (rank[at].astype(_U) << _U(32)) | rank[at + step].astype(_U)
        rank[:] = -1 if depth + step == length else rank
        rank[at] = np.unique(pair, return_inverse=True)[1]
        if depth + step < length:
            gone = np.ones(n, bool)
            gone[at] = False
            rank[gone] = -1
        depth += step
    return rank


def previous_and_next(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position: does an equal string start before it; does one start after it.

    Sorted by rank, and by position where ranks are equal, a position's previous smaller position
    with a common prefix of full depth is its neighbour to the left, if that has the same rank:
    its longest previous factor reaches the depth. The neighbour to the right is the next copy.
    """
    before, after = np.zeros(len(rank), bool), np.zeros(len(rank), bool)
    at = np.flatnonzero(rank >= 0)
    order = at[np.argsort(rank[at], kind="stable")]
    same = rank[order[1:]] == rank[order[:-1]]
    before[order[1:][same]] = True
    after[order[:-1][same]] = True
    return before, after


_SENT = pa.schema([("kind", pa.string()), ("shard", pa.int32()), ("block", pa.int64()),
                   *((c, pa.binary()) for c in ("hash", "second", "count", "doc", "start",
                                                "entry", "size", "text"))])
SENT = ("kind string, shard int, block long, hash binary, second binary, count binary, "
        "doc binary, start binary, entry binary, size binary, text binary")


def _send(length: int, anchor: int, shards: int):  # noqa: ANN202
    """The runs that must be compared, and the strings of split anchors."""

    def send(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        rows: list[dict] = []
        for number, packed in zip(blocks["block"].to_pylist(), blocks["data"].to_pylist(),
                                  strict=True):
            block = Block.of(packed, length, anchor)
            e = block.entries
            codes = codes_of(replies, "asked", len(e.hash))
            want = np.flatnonzero(codes & COMPARE)
            for shard, lo, hi in by_shard(e.hash[want], shards):
                at = want[lo:hi]
                begin = block.offsets[e.text[at]] + e.start[at]
                size = e.end[at] - e.start[at] + length
                inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                rows.append({"kind": "runs", "shard": shard, "block": number,
                             "hash": e.hash[at].tobytes(), "entry": at.tobytes(),
                             "doc": e.doc[at].tobytes(), "start": e.start[at].tobytes(),
                             "size": size.tobytes(),
                             "text": block.data[np.repeat(begin, size) + inside].tobytes()})
            if (codes & SPLIT).any():
                strings = block.split(codes)
                names = ("hash", "second", "count", "doc", "start")
                rows += [{"kind": "split", "shard": shard, "block": number}
                         | {c: x[lo:hi].tobytes() for c, x in zip(names, strings.part()[:5],
                                                                  strict=True)}
                         for shard, lo, hi in by_shard(strings.hash, shards)]
        return pa.Table.from_pylist(rows, _SENT)

    return send


def _compare(length: int, keep_first: bool):  # noqa: ANN202
    """Sorts the suffixes of a shard's runs, some whole anchors at a time."""

    def compare(rows: pa.Table) -> pa.Table:
        h, entry = column(rows, "hash", _U), column(rows, "entry", np.int64)
        doc, start = column(rows, "doc", np.int64), column(rows, "start", np.int64)
        size = column(rows, "size", np.int64)
        text = np.frombuffer(b"".join(rows["text"].to_pylist()), np.uint8)
        many = np.array([len(x) // 8 for x in rows["hash"].to_pylist()])
        block = np.repeat(np.array(rows["block"].to_pylist(), np.int64), many)
        begin = np.cumsum(size) - size
        order = np.lexsort((start, doc, h))
        cut = [0]
        held = 0
        for i in range(1, len(order)):
            held += size[order[i - 1]]
            if held >= SORT_BYTES and h[order[i]] != h[order[i - 1]]:
                cut.append(i)
                held = 0
        cut.append(len(order))
        out: dict[int, list[np.ndarray]] = {}
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            own = order[lo:hi]
            n = size[own]
            first = np.cumsum(n) - n
            inside = np.arange(n.sum()) - np.repeat(first, n)
            part = text[np.repeat(begin[own], n) + inside]
            room = np.repeat(n, n) - inside
            before, after = previous_and_next(suffix_ranks(part, room, length))
            hit = before if keep_first else before | after
            edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
            # a run's last length - 1 positions start no string, so hits never join two runs
            lows, highs = edge[::2], edge[1::2]
            run = np.searchsorted(first, lows, side="right") - 1
            for b in np.unique(block[own][run]).tolist():
                w = block[own][run] == b
                out.setdefault(b, []).append(np.stack(
                    [entry[own][run][w], lows[w] - first[run][w], highs[w] - first[run][w]], 1))
        shard = rows["shard"][0].as_py()
        return pa.table([pa.array(list(out), pa.int64()), pa.array(["runs"] * len(out)),
                         pa.array([shard] * len(out), pa.int32()),
                         pa.array([np.concatenate(v).astype(np.int64).tobytes()
                                   for v in out.values()], pa.binary())], schema=ANSWER_SCHEMA)

    return compare


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                     ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.string())])
RESULT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
          "text string")


def _rewrite(length: int, anchor: int, keep_first: bool, texts: bool):  # noqa: ANN202
    """Gathers a block's answers and cuts its texts."""

    def removed(block: Block, replies: pa.Table) -> np.ndarray:
        codes = codes_of(replies, "asked", len(block.entries.hash))
        hits: dict[int, list[np.ndarray]] = {}
        for kind, data in zip(replies["kind"].to_pylist(), replies["data"].to_pylist(),
                              strict=True):
            if kind == "runs":
                for row in np.frombuffer(data, np.int64).reshape(-1, 3):
                    hits.setdefault(int(row[0]), []).append(row[1:])
        strings = block.split(codes) if (codes & SPLIT).any() else None
        found = codes_of(replies, "split", len(strings.hash)) if strings else None
        mark = np.zeros(len(block.data) + 1, np.int32)

        def cut(begin: np.ndarray, last: np.ndarray) -> None:
            np.add.at(mark, begin, 1)
            np.add.at(mark, last + length, -1)

        for runs, text, entry, first in block.runs():
            code = codes[entry]
            stays = first & ((code & FIRST) > 0) if keep_first else np.zeros(len(first), bool)
            # a split anchor's repeated runs are cut string by string where the first must stay
            whole = ((code & REPEATED) > 0) & ~stays
            cut(runs.low[whole], runs.high[whole])
            for i in np.flatnonzero(first & ~whole & ((code & COMPARE) > 0)).tolist():
                for a, b in hits.get(int(entry[i]), ()):
                    cut(runs.low[i:i + 1] + a, runs.low[i:i + 1] + b - 1)
            at = np.flatnonzero(((code & SPLIT) > 0) & ~whole)
            if len(at):
                start, h, run = runs.windows(at, length)
                own = strings.find(h, runs.anchor[run])
                gone = (found[own] & REPEATED) > 0
                if keep_first:
                    gone &= ~(((found[own] & FIRST) > 0) & (strings.text[own] == text[run])
                              & (strings.start[own] == start - block.offsets[text[run]]))
                cut(start[gone], start[gone])
        return np.cumsum(mark[:-1]) > 0

    def rewrite(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        for packed in blocks["data"].to_pylist():
            block = Block.of(packed, length, anchor, again=True)
            gone = removed(block, replies)
            for i, doc_id in enumerate(block.ids.to_pylist()):
                a, b = int(block.offsets[i]), int(block.offsets[i + 1])
                own, data = gone[a:b], block.data[a:b]
                n = int(own.sum())
                spans = int((own[1:] & ~own[:-1]).sum() + own[:1].sum())
                left = (data[~own] if n else data).tobytes()
                rows.append((doc_id, b - a, n, spans, hashlib.sha256(left).hexdigest(),
                             left.decode("utf-8", "ignore") if texts else None))
        return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_RESULT)],
                        schema=_RESULT)

    return rewrite


def suffix_dedup(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR,
                 keep: str = "first", texts: bool = True, hot: int = HOT) -> DataFrame:
    """A row a text: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the text that is left.

    The text drops code points that were cut in two; the digest is of the exact bytes.
    """
    if keep not in ("first", "none"):
        raise ValueError(f"keep: {keep}")
    blocks = pack(docs, "suffix-blocks")
    shards = shard_count(blocks)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                      strict=True):
                asked = asks(Block.of(packed, length, anchor).entries, number, shards)
                if asked is not None:
                    yield asked

    asked = kept(blocks.select("block", "data").mapInArrow(ask, ASK).groupBy("shard").applyInArrow(
        answer_shard("asked", hot), ANSWER), "suffix-answers")
    sent = kept(blocks.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(
        _send(length, anchor, shards), SENT), "suffix-runs")
    compared = sent.where("kind = 'runs'").groupBy("shard").applyInArrow(
        _compare(length, keep == "first"), ANSWER)
    split = sent.where("kind = 'split'").groupBy("shard").applyInArrow(
        answer_shard("split"), ANSWER)
    return blocks.groupBy("block").cogroup(
        asked.union(compared).union(split).groupBy("block")).applyInArrow(
        _rewrite(length, anchor, keep == "first", texts), RESULT)


def digest(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
