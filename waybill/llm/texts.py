"""Vectorised work on whole texts inside a task: UTF-8 buffers, words, rolling hashes.

All functions take the bytes of a batch of texts as one array plus offsets (text ``i`` is
``data[offsets[i]:offsets[i + 1]]``) and work in pieces of bounded size, so a very long text costs
time, not memory. Hashes are 64 bit and depend on the bytes only: every task and every run agrees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19
SPACES = bytes([0x20, *range(0x09, 0x0E)])

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _mixed(x: int) -> int:
    x = (x + 0x9E3779B97F4A7C15) & _MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
    return x ^ (x >> 31)


BYTE_VALUE = np.array([_mixed(i + 1) for i in range(256)], dtype=_U)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

# bytes of words: anything but ASCII white space; or letters, digits and all of non-ASCII
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[list(SPACES)] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[ord("0"):ord("9") + 1] = True
ALNUM[ord("a"):ord("z") + 1] = True
ALNUM[ord("A"):ord("Z") + 1] = True
ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash; a bijection. Returns a new array."""
    x = x + _U(0x9E3779B97F4A7C15)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_POWERS: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64, or of the inverse of the base; at least n of them."""
    name = "inverse" if inverse else "forward"
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        size = max(n, PIECE + 1)
        have = np.full(size, base, dtype=_U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * PIECE:
            _POWERS[name] = have
    return have[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type)
                              or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1]
    at = at.astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def groups(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most this many bytes together; a larger text comes alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = j


def _cuts(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces that end at a text's end or outside a word."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    while lo < hi:
        end = min(lo + PIECE, hi)
        if end < hi:
            last = int(offsets[np.searchsorted(offsets, end, side="right") - 1])
            free = np.flatnonzero(~inside[data[lo:end]])
            cut = max(last, lo + int(free[-1]) + 1 if len(free) else 0)
            while cut <= lo:  # one word fills the piece: go on to its end
                stop = min(end + PIECE, hi)
                free = np.flatnonzero(~inside[data[end:stop]])
                bound = int(offsets[np.searchsorted(offsets, end)])
                cut = min([bound, *(end + free[:1])]) if bound <= stop or len(free) else 0
                if not cut and stop == hi:
                    cut = hi
                end = stop
            end = int(cut)
        yield lo, end
        lo = end


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray,
          lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words are maximal runs of bytes for which ``inside`` holds; A-Z count as a-z if ``lower``.

    Returns the words' hashes, first bytes, ends, and for each text the range of its words.
    """
    hashes, begins, ends = [], [], []
    for lo, hi in _cuts(data, offsets, inside):
        part = data[lo:hi]
        mask = inside[part]
        first = mask.copy()
        first[1:] &= ~mask[:-1]
        last = mask.copy()
        last[:-1] &= ~mask[1:]
        a, b = np.searchsorted(offsets, [lo, hi])
        at = offsets[a:b + 1] - lo
        at = at[(at > 0) & (at < hi - lo)]
        first[at] = mask[at]
        last[at - 1] = mask[at - 1]
        begin, end = np.flatnonzero(first), np.flatnonzero(last)
        total = BYTE_VALUE[LOWER[part] if lower else part]
        total *= powers(hi - lo)
        np.cumsum(total, out=total)
        h = total[end]
        inner = begin > 0
        h[inner] -= total[begin[inner] - 1]
        h *= powers(hi - lo, inverse=True)[begin]
        hashes.append(mix(h))
        begins.append(begin + lo)
        ends.append(end + lo + 1)
    none = np.zeros(0, np.int64)
    begin = np.concatenate([none, *begins])
    return (np.concatenate([none.astype(_U), *hashes]), begin, np.concatenate([none, *ends]),
            np.searchsorted(begin, offsets))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words, whatever text they belong to."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.zeros(n, _U)
    for i in range(k):
        out *= _U(_BASE)
        out += hashes[i:i + n]
    return mix(out)


def starts(ranges: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Word indexes where k words of one text begin, and the text of each."""
    size = np.maximum(np.diff(ranges) - k + 1, 0)
    text = np.repeat(np.arange(len(size)), size)
    skip = np.concatenate([[0], np.cumsum(size)])[:-1]
    return np.arange(size.sum()) - skip[text] + ranges[:-1][text], text


def text_hash(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One hash of the bytes of each text."""
    out = np.zeros(len(offsets) - 1, _U)
    for i, (lo, hi) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        h = hi - lo
        for at in range(int(lo), int(hi), PIECE):
            part = BYTE_VALUE[data[at:min(at + PIECE, int(hi))]]
            part *= powers(len(part))
            h = _mixed((int(h) * _BASE + int(part.sum())) & _MASK)
        out[i] = _U(int(h) & _MASK)
    return mix(out)
