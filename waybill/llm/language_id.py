"""Language identification by rank-order profiles of character n-grams.

A text's letters, lower-cased, form words; a word is read with a boundary mark on either side, and
its n-grams of 1 to 3 characters are counted over the whole text. A profile is the ``PROFILE`` most
frequent n-grams in order. A text gets the language whose profile is nearest by out-of-place
distance: the sum, over the text's profile, of how far each n-gram's rank is from its rank in the
language's profile, or ``PROFILE`` where it is absent.

Profiles are learned from labelled rows only: at most about ``TRAIN_ROWS`` rows a language, chosen
by a hash of the id (all rows where there are fewer). Counts are summed by (language, n-gram) with
map-side aggregation; a language's profile is a top-``PROFILE`` query. What is sent to every task is
``PROFILE`` n-grams a language.

The score is 1 - distance / largest possible distance. Ties go to the alphabetically first
language. Characters beyond the basic plane share the codes of its private use area.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is every text
where nothing could be learned. Rows without lang or without doc_id are not learned from; a row
without doc_id is not held out. Every row is one text; further columns pass through ``identify``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from waybill.llm.texts import groups, utf8

PROFILE = 400
TRAIN_ROWS = 20_000
GROUP = 1 << 19
MARK = 0x5F
UNKNOWN = "und"
_U = np.uint64


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For the basic plane: is it a letter, and its lower case (in the plane)."""
    letter, lower = np.zeros(1 << 16, bool), np.arange(1 << 16, dtype=np.uint16)
    for i in range(1 << 16):
        c = chr(i)
        if unicodedata.category(c)[0] == "L":
            letter[i] = True
            low = c.lower()
            if len(low) == 1 and ord(low) < 1 << 16:
                lower[i] = ord(low)
    return letter, lower


def _codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """16-bit codes of all characters, whether each is a letter, and the texts' offsets."""
    text = data.tobytes().decode("utf-8", "replace")
    wide = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    letter, lower = _letters()
    high = wide >= 1 << 16
    code = np.where(high, 0, wide).astype(np.uint16)
    is_letter = letter[code]
    code = lower[code]
    if high.any():
        values, back = np.unique(wide[high], return_inverse=True)
        is_letter[high] = np.array([chr(int(v)).isalpha() for v in values])[back]
        code[high] = (0xE000 + values % 0x1900).astype(np.uint16)[back]
    return code, is_letter, lead[offsets]


def gram_counts(data: np.ndarray, offsets: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, n-gram, count), sorted by text and n-gram; at most 65,536 texts at once. A text of
    more than ``GROUP`` bytes comes alone and is counted in pieces."""
    if len(data) > GROUP and len(offsets) == 2:
        return _long_counts(data)
    code, letter, at = _codes(data, offsets)
    n = len(code)
    # every word becomes mark, letters, mark: one mark stands for each run of other characters
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    prev = np.zeros(n, bool)
    prev[1:] = letter[:-1] & (text[1:] == text[:-1])
    begins = letter & ~prev
    where = np.flatnonzero(letter)
    shift = np.cumsum(begins)[where]  # marks before each letter: one a word
    total = len(where) + int(begins.sum()) + 1
    line = np.full(total, MARK, np.uint16)
    place = where - np.searchsorted(np.flatnonzero(~letter), where) + shift
    line[place] = code[where]
    owner = np.full(total, -1, np.int64)
    owner[place] = text[where]
    is_letter = owner >= 0
    # the mark before a word belongs to its text as a start, the next mark as its end
    keys = []
    x = line.astype(_U)
    i = np.flatnonzero(is_letter)
    doc = owner[i].astype(_U) << _U(48)
    keys.append(doc | x[i])
    keys.append(doc | (x[i - 1] << _U(16)) | x[i])
    last = ~is_letter[i + 1]
    keys.append(doc[last] | (x[i[last]] << _U(16)) | _U(MARK))
    keys.append(doc | (x[i - 1] << _U(32)) | (x[i] << _U(16)) | x[i + 1])
    key = np.sort(np.concatenate(keys))
    if not len(key):
        return np.zeros(0, np.int64), key, np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return ((key[new] >> _U(48)).astype(np.int64), key[new] & _U((1 << 48) - 1),
            np.diff(np.append(new, len(key))))


def _long_counts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The counts of one long text. An n-gram is known by a letter and its neighbours, so a piece
    is read with one character more on either side, wherever it is cut."""
    grams, counts = np.zeros(0, _U), np.zeros(0, np.int64)
    lo, held = 0, []
    while lo < len(data):
        hi = min(lo + GROUP, len(data))
        while hi < len(data) and data[hi] & 0xC0 == 0x80:
            hi += 1
        a, b = max(lo - 1, 0), min(hi + 1, len(data))
        while a > 0 and data[a] & 0xC0 == 0x80:
            a -= 1
        while b < len(data) and data[b] & 0xC0 == 0x80:
            b += 1
        code, letter, at = _codes(data[a:b], np.array([0, lo - a, hi - a]))
        line = np.full(len(code) + 2, MARK, np.uint16)
        line[1:-1][letter] = code[letter]
        i = np.flatnonzero(letter) + 1
        i = i[(i > at[1]) & (i <= at[2])]
        x = line.astype(_U)
        last = line[i + 1] == MARK
        held.append(np.concatenate([
            x[i], (x[i - 1] << _U(16)) | x[i], (x[i[last]] << _U(16)) | _U(MARK),
            (x[i - 1] << _U(32)) | (x[i] << _U(16)) | x[i + 1]]))
        lo = hi
        if len(held) == 4 or lo == len(data):
            new, n = np.unique(np.concatenate(held), return_counts=True)
            every, back = np.unique(np.concatenate([grams, new]), return_inverse=True)
            counts = np.bincount(back, weights=np.concatenate([counts, n])).astype(np.int64)
            grams, held = every, []
    return np.zeros(len(grams), np.int64), grams, counts


def _batches(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = utf8(column)
    for lo, hi in groups(offsets, GROUP):
        for a in range(lo, hi, 1 << 15):
            b = min(hi, a + (1 << 15))
            yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]


def learn(labelled: DataFrame, train_rows: int = TRAIN_ROWS, profile: int = PROFILE) -> DataFrame:
    """(lang, rank, gram) from rows with doc_id, text and lang."""
    rows = labelled.where("lang is not null and text is not null and doc_id is not null")
    sizes = rows.groupBy("lang").count().select("lang", (F.lit(float(train_rows)) / F.col("count"))
                                                .alias("part"))
    draw = F.pmod(F.xxhash64(F.lit(11), F.col("doc_id").cast("string")), F.lit(1 << 20)) / (1 << 20)
    chosen = rows.select("doc_id", "text", "lang").join(F.broadcast(sizes), "lang").where(
        draw < F.col("part")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for a, b, data, offsets in _batches(batch.column(1)):
                text, gram, n = gram_counts(data, offsets)
                names = sorted(set(langs[a:b]))
                number = np.array([names.index(x) for x in langs[a:b]])
                key = (number[text].astype(_U) << _U(48)) | gram
                values, back = np.unique(key, return_inverse=True)
                sums = np.bincount(back, weights=n, minlength=len(values)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i] for i in (values >> _U(48)).tolist()], pa.string()),
                     pa.array((values & _U((1 << 48) - 1)).astype(np.int64)), pa.array(sums)],
                    ["lang", "gram", "n"])

    counted = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= profile)
            .select("lang", "rank", "gram"))


class Profiles:
    """Ranks of all profiles' n-grams: one row an n-gram, one column a language."""

    def __init__(self, rows: list[tuple[str, int, int]], profile: int) -> None:
        self.profile = profile
        self.langs = sorted({r[0] for r in rows})
        self.grams = np.array(sorted({r[2] for r in rows}), _U)
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        at = {x: i for i, x in enumerate(self.langs)}
        for lang, rank, gram in rows:
            self.ranks[np.searchsorted(self.grams, _U(gram)), at[lang]] = rank - 1

    def nearest(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        langs, scores = [UNKNOWN] * len(column), np.zeros(len(column))
        if not self.langs:
            return langs, scores
        for a, b, data, offsets in _batches(column):
            text, gram, n = gram_counts(data, offsets)
            if not len(text):
                continue
            order = np.argsort((text.astype(_U) << _U(32)) | (_U((1 << 32) - 1) - n.astype(_U)),
                               kind="stable")
            first = np.searchsorted(text, np.arange(b - a + 1))
            rank = np.arange(len(text)) - first[text]
            order, rank = order[rank < self.profile], rank[rank < self.profile]
            own, gram = text[order], gram[order]
            at = np.searchsorted(self.grams, gram)
            at[at == len(self.grams)] = 0
            at[self.grams[at] != gram] = len(self.grams)
            begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            best = np.full(len(begin), np.iinfo(np.int64).max)
            pick = np.zeros(len(begin), np.int64)
            for lang in range(len(self.langs)):
                theirs = self.ranks[at, lang]
                far = np.where(theirs < 0, self.profile, np.abs(theirs - rank))
                distance = np.add.reduceat(far, begin)
                better = distance < best
                best[better], pick[better] = distance[better], lang
            size = np.diff(np.append(begin, len(own)))
            for t, lang, d, k in zip(own[begin].tolist(), pick.tolist(), best.tolist(),
                                     size.tolist(), strict=True):
                langs[a + t] = self.langs[lang]
                scores[a + t] = 1 - d / (k * self.profile)
        return langs, scores


def identify(docs: DataFrame, profiles: DataFrame, profile: int = PROFILE,
             columns: list[str] | None = None) -> DataFrame:
    """(row, lang_pred, score): ``row`` is a struct of the documents' columns (or some)."""
    spark: SparkSession = docs.sparkSession
    sent = spark.sparkContext.broadcast(
        [(r["lang"], r["rank"], r["gram"]) for r in profiles.collect()])
    row = F.struct(*(F.col(f"`{c}`") for c in columns or docs.columns)).alias("row")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Profiles(sent.value, profile)
        for batch in batches:
            langs, scores = known.nearest(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores)],
                ["row", "lang_pred", "score"])

    out = docs.select(row, "text")
    return out.mapInArrow(predict, T.StructType([
        T.StructField("row", out.schema["row"].dataType, False),
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def held_out(doc_id: Column) -> Column:
    """A quarter of the ids, never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_id(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Learn from the rows that are not held out, predict all."""
    profiles = learn(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, profiles, columns=columns)


def digest(predicted: DataFrame) -> DataFrame:
    return predicted.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"),
                            "lang_pred", "score")
