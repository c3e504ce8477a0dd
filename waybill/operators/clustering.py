"""Rows in the order of a curve through several columns, so that each of them can skip files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

C = F.col
BITS = 6
SAMPLE = 20_000


def quantiles(df: DataFrame, columns: Sequence[str], parts: int, sample: int = SAMPLE
              ) -> dict[str, list]:
    """Values that cut each column into about equal parts, from one sample of about ``sample``
    rows, whatever the size of the table."""
    rows = df.select(*columns)
    n = df.count()
    if n > sample:
        rows = rows.sample(sample / n, seed=7)
    seen = rows.limit(2 * sample).collect()
    out = {}
    for c in columns:
        values = sorted(r[c] for r in seen if r[c] is not None)
        out[c] = [values[len(values) * i // parts] for i in range(1, parts)] if values else []
    return out


def rank(column: Column, cuts: list) -> Column:
    """How many of the sorted cuts lie below the value, by halving; null comes first. A value that
    holds many cuts takes their places, so that the next one lies as far off as its rows reach."""
    apart = sorted(set(cuts))

    def among(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(sum(c < apart[lo] for c in cuts) if lo < len(apart) else len(cuts))
        m = (lo + hi) // 2
        return F.when(column <= F.lit(apart[m]), among(lo, m)).otherwise(among(m + 1, hi))

    return F.when(column.isNull(), 0).otherwise(among(0, len(apart)))


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """One number whose bits are those of the ranks in turn, high bits first."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for j, r in enumerate(ranks):
            one = F.shiftright(r, bit).bitwiseAND(F.lit(1)).cast("long")
            out = out.bitwiseOR(F.shiftleft(one, bit * len(ranks) + len(ranks) - 1 - j))
    return out


def along_curve(df: DataFrame, columns: Sequence[str], first: Sequence[str] = (),
                bits: int = BITS) -> DataFrame:
    """The rows dealt out and sorted along the curve; ``first`` (partitions) before it.

    Each column is cut at sampled quantiles, so that its ranks use all bits evenly however its
    values are distributed. Rows of one place on the curve, such as those of a frequent value, are
    dealt further by a hash of the whole row, so they may fill many files.
    """
    cuts = quantiles(df, columns, 1 << bits)
    ranks = [rank(C(c), cuts[c]) for c in columns]
    hashed = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    placed = df.withColumns({"_place": interleaved(ranks, bits), "_salt": F.xxhash64(*hashed)})
    return placed.repartitionByRange(*first, "_place", "_salt").sortWithinPartitions(
        *first, "_place").drop("_place", "_salt")
