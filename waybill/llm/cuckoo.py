"""A cuckoo filter on numpy arrays: batch insert, test and delete of 64-bit key hashes."""

from __future__ import annotations

import numpy as np

from waybill.llm.texts import mix

SLOTS = 4
LOAD = 0.8
_U = np.uint64


class Full(Exception):
    """The filter must be rebuilt larger from the exact table."""


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key may lie in either of two buckets.

    Never answers no for a key that was inserted; answers yes for about one of 8,000 others.
    ``delete`` takes out one copy of a fingerprint and must only be called for keys inside.
    """

    def __init__(self, table: np.ndarray) -> None:
        self.table = table

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * LOAD < n:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        out = cls.for_keys(len(keys))
        while True:
            try:
                out.insert(keys)
                return out
            except Full:
                out = cls(np.zeros((len(out.table) * 2, SLOTS), np.uint16))

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = mix(keys.astype(_U))
        mark = (h >> _U(48)).astype(np.uint16)
        mark[mark == 0] = 1
        one = (h & _U(len(self.table) - 1)).astype(np.int64)
        return mark, one, self._other(mark, one)

    def _other(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        step = mix(mark.astype(_U)) & _U(len(self.table) - 1)
        return bucket ^ step.astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self._places(keys)
        return ((self.table[one] == mark[:, None]) | (self.table[two] == mark[:, None])).any(1)

    def _settle(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Put what finds a free slot; which ones did not."""
        order = np.argsort(bucket, kind="stable")
        b = bucket[order]
        first = np.searchsorted(b, b, side="left")
        rank = np.arange(len(b)) - first
        free = self.table[b] == 0
        fits = rank < free.sum(1)
        slot = np.argsort(~free, axis=1, kind="stable")[np.arange(len(b)), np.minimum(rank, 3)]
        self.table[b[fits], slot[fits]] = mark[order][fits]
        left = np.zeros(len(b), bool)
        left[order[~fits]] = True
        return left

    def insert(self, keys: np.ndarray) -> None:
        mark, one, two = self._places(keys)
        if np.count_nonzero(self.table) + len(keys) > self.table.size * 0.95:
            raise Full
        left = self._settle(mark, one)
        mark, bucket = mark[left], two[left]
        for turn in range(500):
            left = self._settle(mark, bucket)
            mark, bucket = mark[left], bucket[left]
            if not len(mark):
                return
            # one item a bucket pushes out a resident, which goes on to its other bucket
            _, at = np.unique(bucket, return_index=True)
            slot = (mix(bucket[at].astype(_U) + _U(turn)) % _U(SLOTS)).astype(np.int64)
            out = self.table[bucket[at], slot].copy()
            self.table[bucket[at], slot] = mark[at]
            mark[at] = out
            bucket[at] = self._other(out, bucket[at])
        raise Full

    def _take(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Clear one copy for each item that has one in its bucket; which items had none."""
        order = np.lexsort((mark, bucket))
        b, m = bucket[order], mark[order]
        new = np.ones(len(b), bool)
        new[1:] = (b[1:] != b[:-1]) | (m[1:] != m[:-1])
        at = np.arange(len(b))
        rank = at - np.maximum.accumulate(np.where(new, at, 0))
        same = self.table[b] == m[:, None]
        hit = rank < same.sum(1)
        slot = np.argsort(~same, axis=1, kind="stable")[at, np.minimum(rank, SLOTS - 1)]
        self.table[b[hit], slot[hit]] = 0
        left = np.zeros(len(b), bool)
        left[order[~hit]] = True
        return left

    def delete(self, keys: np.ndarray) -> None:
        mark, one, two = self._places(keys)
        left = self._take(mark, one)
        left_too = self._take(mark[left], two[left])
        if left_too.any():
            raise KeyError(f"{int(left_too.sum())} keys are not in the filter")
