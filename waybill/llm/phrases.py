"""A set of word sequences that is sent to every task, and its occurrences in texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from waybill.llm.texts import ALNUM, LOWER, grams, groups, utf8, words

_U = np.uint64
_BITS = 20


def normal(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> bytes:
    """The words, lower-cased, joined by one space."""
    return b" ".join(LOWER[data[a:b]].tobytes() for a, b in zip(begin, end, strict=True))


class Phrases:
    """Sequences of words by number of words; equal sequences are one entry."""

    def __init__(self, sequences: list[bytes]) -> None:
        self.entries = sorted(set(sequences))
        hashed: dict[int, list[tuple[int, int]]] = {}
        if self.entries:
            data, offsets = utf8(pa.array(self.entries, pa.large_binary()))
            h, _, _, ranges = words(data, offsets, ALNUM)
            for i in range(len(self.entries)):
                own = h[ranges[i]:ranges[i + 1]]
                hashed.setdefault(len(own), []).append((int(grams(own, len(own))[0]), i))
        self.sizes = {}
        for k, rows in hashed.items():
            rows.sort()
            hashes = np.array([r[0] for r in rows], _U)
            seen = np.zeros(1 << _BITS, bool)
            seen[hashes >> _U(64 - _BITS)] = True
            self.sizes[k] = (hashes, np.array([r[1] for r in rows]), seen)

    def find(self, hashes: np.ndarray, ranges: np.ndarray, data: np.ndarray, begin: np.ndarray,
             end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Verified occurrences: text, first word (from 0 in its text), words, entry."""
        found: list[tuple[int, int, int, int]] = []
        for k, (known, entry, seen) in self.sizes.items():
            g = grams(hashes, k)
            if not len(g):
                continue
            maybe = np.flatnonzero(seen[g >> _U(64 - _BITS)])
            at = np.searchsorted(known, g[maybe])
            at[at == len(known)] = 0
            same = known[at] == g[maybe]
            maybe, at = maybe[same], at[same]
            text = np.searchsorted(ranges, maybe, side="right") - 1
            fits = maybe + k <= ranges[text + 1]
            for w, e, t in zip(maybe[fits].tolist(), entry[at[fits]].tolist(),
                               text[fits].tolist(), strict=True):
                if normal(data, begin[w:w + k], end[w:w + k]) == self.entries[e]:
                    found.append((t, w - int(ranges[t]), k, e))
        out = np.array(sorted(found), np.int64).reshape(-1, 4)
        return out[:, 0], out[:, 1], out[:, 2], out[:, 3]


def item_windows(column: pa.Array, k: int) -> list[list[bytes]]:
    """The k-word windows of each text; a text of fewer words, but not none, is one window."""
    data, offsets = utf8(column)
    out: list[list[bytes]] = []
    for lo, hi in groups(offsets, 4 << 20):
        part, at = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        _, begin, end, ranges = words(part, at, ALNUM)
        for a, b in zip(ranges[:-1], ranges[1:], strict=True):
            size = min(k, int(b - a))
            out.append([normal(part, begin[i:i + size], end[i:i + size])
                        for i in range(int(a), int(b) - size + 1)] if size else [])
    return out


