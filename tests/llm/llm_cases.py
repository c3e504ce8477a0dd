"""Small tables with every odd case, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterable

DOCUMENTS = ("doc_id long, text string, lang string, source string, n_chars long, row string, "
             "hits int, name string, size string, found string, label string, component string")

LOREM = ("the quick brown fox jumps over the lazy dog while seven old owls watch the moon rise "
         "above a quiet lake and nobody says a word until morning comes again")


def documents(spark, rows: Iterable[tuple]):
    """Rows (doc_id, text, lang, source) with columns whose names operators use themselves."""
    return spark.createDataFrame(
        [(i, t, lang, s, None if t is None else len(t), "r", 1, "n", "s", "f", "l", "c")
         for i, t, lang, s in rows], DOCUMENTS)


def odd_rows() -> list[tuple]:
    """Nulls, empty and long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977}x{i % 13}" for i in range(30000))
    return [
        (1, LOREM, "en", "a"), (2, LOREM, "en", "b"), (3, LOREM + " indeed", "en", "a"),
        (4, None, "en", "a"), (5, "", None, None), (6, " \n\t ", "en", None),
        (7, long, "en", "a"), (8, long + "\n" + LOREM, "en", "c"), (9, "one", None, "c"),
        (None, LOREM, "en", "a"), (None, None, None, None), (10, LOREM, "en", "a"),
        (10, LOREM, "en", "a"), (11, "!!! 123 ...", "de", "d"), (12, "Ünï çødé " * 60, "de", "d"),
        (13, LOREM.upper() + "\n" + LOREM, "en", "a"), (14, "a b c d e", "en", "a"),
        (15, "A  b\tc\nd e", "en", "b"), (16, "a b c", "en", "b"), (17, "a b c", "en", "b"),
        (18, "\x00\x01 zero \U0001F600 face " * 30, "en", "b"),
    ]


class Groups:
    """Union-find that names a group by its smallest member."""

    def __init__(self) -> None:
        self.up: dict = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def space_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))


def plain_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def removed(rows: list[tuple], length: int, keep: str) -> Counter:
    """Suffix dedup: (doc_id, n_bytes, n_removed, n_spans, digest), counted."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    data = [(rows[i][1] or "").encode() for i in range(len(rows))]
    seen, first = Counter(), {}
    for i in order:
        for at in range(len(data[i]) - length + 1):
            part = data[i][at:at + length]
            seen[part] += 1
            first.setdefault(part, (i, at))
    out = Counter()
    for i, (doc_id, *_) in enumerate(rows):
        gone = [False] * len(data[i])
        for at in range(len(data[i]) - length + 1):
            part = data[i][at:at + length]
            if seen[part] > 1 and (keep == "none" or first[part] != (i, at)):
                gone[at:at + length] = [True] * length
        left = bytes(b for b, g in zip(data[i], gone, strict=True) if not g)
        spans = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        out[(doc_id, len(data[i]), sum(gone), spans, hashlib.sha256(left).hexdigest())] += 1
    return out


def shingles(text: str | None, k: int = 5) -> frozenset:
    w = space_words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def jaccard(rows: list[tuple], k: int = 5, percent: int = 75) -> Counter:
    """(doc_id, n_shingles, component_id), counted."""
    sets = [shingles(r[1], k) for r in rows]
    groups, holders = Groups(), defaultdict(list)
    for i, s in enumerate(sets):
        if rows[i][0] is not None:
            groups.find(rows[i][0])
            for x in s:
                holders[x].append(i)
    seen = set()
    for at in holders.values():
        for a in at:
            for b in at:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                        groups.join(rows[a][0], rows[b][0])
    return Counter((r[0], len(s), None if r[0] is None else groups.find(r[0]))
                   for r, s in zip(rows, sets, strict=True))


def line_key(line: str) -> str:
    return lower(line.strip(" \t\n\x0b\f\r"))


def lines_left(rows: list[tuple], min_chars: int = 20, min_docs: int = 3) -> list[str | None]:
    """The texts after line dedup."""
    holders = defaultdict(set)
    for r in rows:
        if r[0] is not None:
            for line in (r[1] or "").split("\n"):
                holders[line_key(line)].add(r[0])
    gone = {k: max(v) for k, v in holders.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for r in rows:
        if r[0] is None or r[1] is None:
            out.append(r[1])
            continue
        out.append("\n".join(x for x in r[1].split("\n")
                             if gone.get(line_key(x), r[0]) == r[0]))
    return out


def hits(rows: list[tuple], benchmark: list[tuple], k: int = 10) -> list[tuple]:
    """For each row: number of words, places of hit words, items."""
    windows = defaultdict(set)
    for item, text in benchmark:
        w = plain_words(text)
        size = min(k, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i:i + size])] |= set() if item is None else {str(item)}
    out = []
    for r in rows:
        w = plain_words(r[1])
        places, items = set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                found = windows.get(tuple(w[i:i + size]))
                if found is not None:
                    places |= set(range(i, i + size))
                    items |= found
        out.append((len(w), places, sorted(items)))
    return out
