"""Near-duplicate embeddings by an inverted multi-index.

Unit vectors are cut into two halves, each with its own codebook (k-means on a bounded sample); the
product of the codebooks is a grid of cells, and every vector lies in the cell of its two nearest
codewords. A vector visits cells in order of distance (a multi-sequence traversal of the two sorted
lists of codewords) until the excess over its own cell passes a cut, and is compared with all
vectors of the cells it visits, by cosine in double precision. The cut is calibrated: for a bounded
sample of queries all links are found by brute force over all vectors, and the cut is the smallest
that reaches ``TARGET`` of them, plus a tenth. It is never below the cut that finds
``AT_THRESHOLD`` of partners placed at exactly the least cosine, so links that are too rare for
the sample are found as well. ``recall`` measures on other queries.

Two vectors are compared when either visits the other's cell; a link counts once for either end.

Equal vectors are collapsed into classes first, so a hot vector is one row of the index. Cells are
dealt in tiles of at most about ``HOME`` residents and ``PROBE`` visitors, so a hot cell is many
tasks; a tile emits counts and a spanning forest of its links, never its pairs. Codebooks, cell
counts (at most ``MAX_CODES`` squared) and samples are what the driver sees.

Defined cases: vectors that are null, zero, empty, or hold null or non-finite components link with
nothing. Vectors of different length don't link. A row without vec_id counts for nothing: no
links, no component, not kept. Rows with the same vec_id are vectors of their own. Further columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.graph import components
from waybill.llm.storage import kept

MIN_COS = 0.9
SAMPLE = 20_000
QUERIES = 1024
TARGET = 0.999
CELL = 256  # vectors a cell, on average, while the codebooks are below MAX_CODES
MAX_CODES = 256
HOME, PROBE = 1024, 4096
BINS, STEP = 800, 0.005
DEFAULT_CUT = 0.4
AT_THRESHOLD = 0.98


@dataclass(frozen=True)
class Grid:
    left: np.ndarray
    right: np.ndarray

    def excess(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distance of each half to each codeword, less that to the nearest."""
        half = self.left.shape[1]
        out = []
        for part, codes in ((x[:, :half], self.left), (x[:, half:], self.right)):
            d = (part ** 2).sum(1)[:, None] - 2 * part @ codes.T + (codes ** 2).sum(1)
            out.append(d - d.min(1, keepdims=True))
        return out[0], out[1]

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.excess(x)
        return a.argmin(1) * len(self.right) + b.argmin(1)

    def visits(self, x: np.ndarray, cut: float, full: np.ndarray) -> list[np.ndarray]:
        """For each vector the cells with residents (``full``) within the cut, nearest first."""
        first, second = self.excess(x)
        out = []
        for a, b in zip(first, second, strict=True):
            i, j = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
            i = i[:np.searchsorted(a[i], cut, side="right")]
            many = np.searchsorted(b[j], cut - a[i], side="right")
            own = np.repeat(i, many)
            other = j[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
            cell = own * len(self.right) + other
            order = np.argsort(a[own] + b[other], kind="stable")
            cell = cell[order]
            out.append(cell[full[cell]])
        return out


def kmeans(x: np.ndarray, k: int, turns: int = 10) -> np.ndarray:
    rng = np.random.default_rng(7)
    codes = x[np.sort(rng.choice(len(x), size=min(k, len(x)), replace=False))].copy()
    for _ in range(turns):
        d = -2 * x @ codes.T + (codes ** 2).sum(1)
        at = d.argmin(1)
        n = np.bincount(at, minlength=len(codes))
        sums = np.zeros_like(codes)
        np.add.at(sums, at, x)
        codes[n > 0] = sums[n > 0] / n[n > 0][:, None]
    return codes


def units(column: pa.Array, size: int) -> np.ndarray:
    """Rows of unit length from lists of doubles."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow of the squares
    return x / np.sqrt((x ** 2).sum(1, keepdims=True))


def _valid(vectors: DataFrame) -> DataFrame:
    e = F.col("embedding").cast("array<double>")
    odd = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    good = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~odd
            & F.exists(e, lambda v: v != 0))
    return vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding"),
        F.coalesce(good, F.lit(False)).alias("good")).select(
        "vec_id", "embedding", "good",
        F.when(F.col("good"), F.xxhash64("embedding")).alias("h1"),
        F.when(F.col("good"), F.xxhash64(F.lit(3), "embedding")).alias("h2"))


def fit(classes: DataFrame, size: int, n: int, sample: int = SAMPLE, cell: int = CELL) -> Grid:
    """Codebooks from at most about ``sample`` vectors, chosen by a hash of their id."""
    draw = F.pmod(F.xxhash64(F.lit(5), "rep"), F.lit(1 << 20)) / (1 << 20)
    rows = classes.where(draw < sample / max(n, 1)).orderBy("rep").select("embedding").toArrow()
    if not rows.num_rows:
        rows = classes.orderBy("rep").limit(1).select("embedding").toArrow()
    x = units(rows["embedding"].combine_chunks(), size)
    codes = max(1, min(MAX_CODES, int(np.sqrt(n / cell))))
    half = size // 2
    return Grid(kmeans(x[:, :half], codes), kmeans(x[:, half:], codes))


def _queries(classes: DataFrame, size: int, n: int, queries: int, seed: int) -> tuple:
    draw = F.pmod(F.xxhash64(F.lit(seed), "rep"), F.lit(1 << 20)) / (1 << 20)
    rows = classes.where(draw < queries / max(n, 1)).select("rep", "embedding").toArrow()
    if not rows.num_rows:
        return np.zeros(0, np.int64), np.zeros((0, size))
    return rows["rep"].to_numpy(), units(rows["embedding"].combine_chunks(), size)


def calibrate(classes: DataFrame, grid: Grid, size: int, n: int, min_cos: float,
              target: float, queries: int = QUERIES, seed: int = 9) -> tuple[float, np.ndarray]:
    """The cut, and the histogram of excess over all true links of the sampled queries."""
    reps, x = _queries(classes, size, n, queries, seed)
    sent = classes.sparkSession.sparkContext.broadcast((reps, x, grid))

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reps, x, grid = sent.value
        a, b = grid.excess(x)
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            y = units(batch.column(1), size)
            own = batch.column(0).to_numpy()
            cell = grid.cells(y)
            for lo in range(0, len(y), 4096):
                s = y[lo:lo + 4096] @ x.T >= min_cos
                r, q = np.nonzero(s & (own[lo:lo + 4096, None] != reps))
                c = cell[lo:lo + 4096][r]
                need = a[q, c // len(grid.right)] + b[q, c % len(grid.right)]
                total += np.bincount(np.minimum((need / STEP).astype(int), BINS - 1),
                                     minlength=BINS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bin", "n"])

    counts = np.zeros(BINS, np.int64)
    least = threshold_cut(grid, x, min_cos)
    if len(reps):
        for row in (classes.select("rep", "embedding").mapInArrow(needed, "bin long, n long")
                    .groupBy("bin").agg(F.sum("n").alias("n")).collect()):
            counts[row["bin"]] = row["n"]
    if not counts.sum():
        return least, counts
    reach = np.cumsum(counts) >= target * counts.sum()
    return max(least, float(np.argmax(reach) + 1) * STEP * 1.1), counts


def threshold_cut(grid: Grid, x: np.ndarray, min_cos: float) -> float:
    """The cut that finds ``AT_THRESHOLD`` of partners at exactly the least cosine, in random
    directions from the sampled vectors: the hardest links there are."""
    if len(x) < 2 or x.shape[1] < 2:
        return DEFAULT_CUT
    away = np.random.default_rng(3).normal(size=x.shape)
    away -= (away * x).sum(1, keepdims=True) * x
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    y = min_cos * x + np.sqrt(1 - min_cos ** 2) * away
    need = []
    for p, q in ((x, y), (y, x)):
        (a, b), c, at = grid.excess(p), grid.cells(q), np.arange(len(x))
        need.append(a[at, c // len(grid.right)] + b[at, c % len(grid.right)])
    return float(np.quantile(np.minimum(*need), AT_THRESHOLD)) + STEP


def recall(counts: np.ndarray, cut: float) -> float:
    """Share of the true links, by ``calibrate``'s histogram of other queries, within a cut."""
    whole = counts.sum()
    return 1.0 if not whole else float(counts[:int(cut / STEP)].sum() / whole)


def _forest(links: np.ndarray, homes: np.ndarray, probes: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) over a matrix probes x homes of links."""
    p, h = np.flatnonzero(links.any(1)), np.flatnonzero(links.any(0))
    part = links[np.ix_(p, h)]
    high = np.iinfo(np.int64).max
    low_p, low_h = probes[p].copy(), homes[h].copy()
    while True:
        new_p = np.minimum(low_p, np.where(part, low_h[None, :], high).min(1, initial=high))
        new_h = np.minimum(low_h, np.where(part, new_p[:, None], high).min(0, initial=high))
        if (new_p == low_p).all() and (new_h == low_h).all():
            break
        low_p, low_h = new_p, new_h
    node, low = np.concatenate([probes[p], homes[h]]), np.concatenate([low_p, low_h])
    return node[node != low], low[node != low]


def _tile(size: int, min_cos: float):  # noqa: ANN202
    def compare(rows: pa.Table) -> pa.Table:
        is_home = rows["home"].combine_chunks().to_numpy(zero_copy_only=False)
        rep, n = rows["rep"].to_numpy(), rows["n"].to_numpy()
        cell = rows["cell"].to_numpy()
        x = np.frombuffer(b"".join(rows["vec"].to_pylist()), np.float64).reshape(-1, size)
        visits = rows["visits"].combine_chunks().take(pa.array(np.flatnonzero(is_home)))
        h, p = np.flatnonzero(is_home), np.flatnonzero(~is_home)
        links = (x[p] @ x[h].T >= min_cos) & (rep[p][:, None] != rep[h])
        p_hit, h_hit = np.flatnonzero(links.any(1)), np.flatnonzero(links.any(0))
        found = links[np.ix_(p_hit, h_hit)]
        # a resident that does not visit the visitor's cell will not find the link itself
        cells, at = np.unique(cell[p][p_hit], return_inverse=True)
        goes = np.zeros((len(h_hit), len(cells)), bool)
        for i, k in enumerate(h_hit):
            goes[i] = np.isin(cells, visits[int(k)].values.to_numpy())
        extra = found & ~goes[:, at].T if len(cells) else found
        node, low = _forest(links, rep[h], rep[p])
        ids = np.concatenate([rep[p][p_hit], rep[h][h_hit], node])
        more = np.concatenate([found @ n[h][h_hit], n[p][p_hit] @ extra,
                               np.zeros(len(node), np.int64)]).astype(np.int64)
        to = np.concatenate([rep[p][p_hit], rep[h][h_hit], low])
        return pa.table({"rep": pa.array(ids, pa.int64()), "links": pa.array(more, pa.int64()),
                         "to": pa.array(to, pa.int64())})

    return compare


def _links(classes: DataFrame, size: int, min_cos: float, target: float) -> DataFrame:
    """(rep, links, to): counts of linked vectors to add up, and edges rep - to."""
    spark = classes.sparkSession
    n = classes.count()
    grid = fit(classes, size, n)
    cut, _ = calibrate(classes, grid, size, n, min_cos, target)
    sent = spark.sparkContext.broadcast(grid)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = units(batch.column(2), size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1),
                     pa.array(sent.value.cells(x).astype(np.int32)),
                     pa.array([row.tobytes() for row in x], pa.binary())],
                    ["rep", "n", "cell", "vec"])

    homes = kept(classes.select("rep", "n", "embedding").mapInArrow(
        place, "rep long, n long, cell int, vec binary"), "homes")
    full = np.zeros(len(grid.left) * len(grid.right), bool)
    full[[r["cell"] for r in homes.select("cell").distinct().collect()]] = True
    sent_full = spark.sparkContext.broadcast(full)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                x = np.frombuffer(b"".join(part.column(3).to_pylist()), np.float64)
                went = sent.value.visits(x.reshape(-1, size), cut, sent_full.value)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(4)),
                     pa.array([w.astype(np.int32) for w in went], pa.list_(pa.int32()))],
                    ["rep", "n", "cell", "vec", "visits"])

    walked = kept(homes.mapInArrow(
        walk, "rep long, n long, cell int, vec binary, visits array<int>"), "visits")
    # tiles: a cell's residents and visitors in pieces
    visitors = walked.select(F.explode("visits").alias("at")).groupBy("at").agg(
        F.count("*").alias("visitors"))
    cells = walked.groupBy(F.col("cell").alias("at")).agg(F.count("*").alias("residents")).join(
        visitors, "at").select(
        "at", F.ceil(F.col("residents") / HOME).cast("int").alias("h_all"),
        F.ceil(F.col("visitors") / PROBE).cast("int").alias("p_all"))
    cells = kept(cells, "cells")
    salt = F.xxhash64(F.lit(13), "rep")
    one = walked.withColumn("at", F.col("cell")).join(cells, "at").select(
        "at", F.pmod(salt, F.col("h_all")).cast("int").alias("h"),
        F.explode(F.sequence(F.lit(0), F.col("p_all") - 1)).alias("p"),
        F.lit(True).alias("home"), "rep", "n", "cell", "vec", "visits")
    two = walked.select("rep", "n", "cell", "vec", F.explode("visits").alias("at")).join(
        cells, "at").select(
        "at", F.explode(F.sequence(F.lit(0), F.col("h_all") - 1)).alias("h"),
        F.pmod(salt, F.col("p_all")).cast("int").alias("p"), F.lit(False).alias("home"), "rep",
        "n", "cell", "vec", F.array().cast("array<int>").alias("visits"))
    return one.union(two).groupBy("at", "h", "p").applyInArrow(
        _tile(size, min_cos), "rep long, links long, to long")


def near_duplicates(vectors: DataFrame, min_cos: float = MIN_COS, target: float = TARGET
                    ) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept."""
    rows = _valid(vectors)
    classes = kept(rows.where("good").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"),
        F.first("embedding").alias("embedding")), "classes")
    sizes = [r["size"] for r in classes.select(F.size("embedding").alias("size")).distinct()
             .collect()]
    found = None
    for size in sorted(sizes):
        own = _links(classes.where(F.size("embedding") == size), size, min_cos, target)
        found = own if found is None else found.union(own)
    slim = classes.select("h1", "h2", "rep", "n")
    if found is None:
        info = slim.select("*", F.lit(0).cast("long").alias("links"), F.col("rep").alias("comp"))
    else:
        found = kept(found, "links")
        joined = components(found.select(F.col("rep").alias("u"), F.col("to").alias("v")))
        info = kept(
            slim.join(found.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left")
            .join(joined.select(F.col("node").alias("rep"), F.col("component").alias("comp")),
                  "rep", "left"), "class-info")
    out = rows.select("vec_id", "h1", "h2").join(info, ["h1", "h2"], "left")
    alone = F.col("rep").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.coalesce("comp", "rep"))
    return out.select(
        "vec_id", F.when(alone, 0).otherwise(F.col("n") - 1 + F.coalesce("links", F.lit(0)))
        .cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


SQL = """
with recursive v as (
  select vec_id, cast(embedding as double[]) as e from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
u as (select vec_id, e, sqrt(list_dot_product(e, e)) as n from v),
links as (select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id <> b.vec_id
          where len(a.e) = len(b.e) and list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.9),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l
                on r.b = l.a),
c as (select a, min(b) as low from reach group by a),
d as (select a, count(*) as n from links group by a)
select vec_id, coalesce(d.n, 0) as n_links, coalesce(least(c.low, vec_id), vec_id) as component_id,
       coalesce(least(c.low, vec_id), vec_id) = vec_id as kept
from embeddings left join c on vec_id = c.a left join d on vec_id = d.a
"""
