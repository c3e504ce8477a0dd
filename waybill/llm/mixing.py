"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, and the rates lie as near to one (in relative entropy) as the token
constraints allow: the words a source gives, its documents' sizes times their rates, must equal its
target. The solution is an exponential tilt, rate = exp(lambda * size / mean size of the source),
cut at ``MAX_COPIES``; lambda is one number a source. The convex dual is solved for all sources at
once by safeguarded Newton steps; each step is one distributed sum over (source, size, number of
documents), a table pre-aggregated once, as documents of one source and size share a rate.

Rates are rounded into whole copies by carrying the error along, from large to small documents,
within buckets of about ``BUCKET`` documents of one source, so that a source with a third of all
rows is dealt over many tasks and every bucket's words come within half a small document of what
its rates ask for. Buckets, order and rounding depend on ids and sizes only: reruns agree.

Targets: sources in code point order, null last, weigh 5, 2, 1, repeating, and share the size of
all documents; a target stops at ``MAX_COPIES`` times its source's size and the excess is shared
again by weight among the others until none is above.

Defined cases: null texts have size 0; documents of size 0 and sources without words take nothing.
Null is a source of its own. Rows that repeat an id are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm.storage import kept

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3
BUCKET = 1024
CLOSE = 1e-9
STEPS = 60


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _name(source: Column) -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def with_targets(sources: DataFrame, weights: Iterable[float] = WEIGHTS) -> DataFrame:
    """Adds ``target`` to (source, name, words, ...), one row a source."""
    weights = list(weights)
    spark = sources.sparkSession
    order = sources.select("source", "name").orderBy(F.col("source").asc_nulls_last()).rdd
    number = spark.createDataFrame(
        order.zipWithIndex().map(lambda x: (x[0]["name"], weights[x[1] % len(weights)])),
        "name string, weight double")
    rows = kept(sources.join(number, "name").withColumn("cap", F.col("words") * MAX_COPIES),
                "sources")
    total = rows.agg(F.sum("words")).first()[0] or 0
    level, capped = 0.0, -1
    while True:  # the level only rises, and every turn caps one more source at least
        above = F.col("weight") * level > F.col("cap")
        n, held, free = rows.agg(
            F.count_if(above), F.sum(F.when(above, F.col("cap")).otherwise(0)),
            F.sum(F.when(~above, F.col("weight")).otherwise(0.0))).first()
        if n == capped or not free:
            break
        level, capped = (total - held) / free, n
    return rows.withColumn("target", F.least(F.col("weight") * level, F.col("cap").cast("double")))


def solve(sizes: DataFrame, targets: DataFrame, steps: int = STEPS) -> DataFrame:
    """Adds ``tilt`` (lambda, per mean size) to the targets. ``sizes``: name, size, n."""
    state = targets.withColumn("mean", F.col("words") / F.col("docs")).select(
        "*", F.lit(0.0).alias("tilt"), F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        ((F.col("target") <= 0) | (F.col("target") >= F.col("cap"))).alias("done"))
    for _ in range(steps):
        state = kept(state, "tilts")
        if state.where("not done").isEmpty():
            return state
        x = F.col("size") / F.col("mean")
        rate = F.exp(F.least(F.col("tilt") * x, F.lit(50.0)))
        cut = rate >= MAX_COPIES
        sums = sizes.join(state.where("not done").select("name", "tilt", "mean"), "name").select(
            "name", (F.col("n") * F.col("size") * F.least(rate, F.lit(float(MAX_COPIES))))
            .alias("f"), F.when(cut, 0.0).otherwise(F.col("n") * F.col("size") * x * rate)
            .alias("d")).groupBy("name").agg(F.sum("f").alias("f"), F.sum("d").alias("d"))
        below = F.col("f") < F.col("target")
        low = F.when(below, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(below, F.col("high")).otherwise(F.col("tilt"))
        # Newton on the logarithm, within the bracket; a step that leaves it becomes a bisection
        newton = F.col("tilt") + F.when(
            (F.col("d") > 0) & (F.col("f") > 0),
            F.log(F.col("target") / F.col("f")) * F.col("f") / F.col("d"))
        inside = newton.isNotNull() & (F.col("low2").isNull() | (newton > F.col("low2"))) & (
            F.col("high2").isNull() | (newton < F.col("high2")))
        middle = (F.when(F.col("low2").isNull(), F.least(F.col("high2") * 2, F.lit(-1.0)))
                  .when(F.col("high2").isNull(), F.greatest(F.col("low2") * 2, F.lit(1.0)))
                  .otherwise((F.col("low2") + F.col("high2")) / 2))
        near = F.abs(F.col("f") - F.col("target")) <= F.col("target") * CLOSE
        narrow = (F.col("high2") - F.col("low2")) <= 1e-13
        done = F.col("done") | F.coalesce(near | narrow, F.lit(False))
        state = (state.join(sums, "name", "left").withColumns({"low2": low, "high2": high})
                 .withColumn("done2", done)
                 .withColumn("tilt", F.when(F.col("done2"), F.col("tilt"))
                             .when(inside, newton).otherwise(middle))
                 .select(*(c for c in state.columns if c not in ("low", "high", "done")),
                         F.col("low2").alias("low"), F.col("high2").alias("high"),
                         F.col("done2").alias("done")))
    return kept(state, "tilts")


def rate() -> Column:
    """The rate of a document with ``size``, from its source's row."""
    x = F.col("size") / F.col("mean")
    return (F.when(F.col("target") <= 0, 0.0)
            .when(F.col("target") >= F.col("cap"), float(MAX_COPIES))
            .otherwise(F.least(F.exp(F.least(F.col("tilt") * x, F.lit(50.0))),
                               F.lit(float(MAX_COPIES)))))


def round_rates(sizes: list[int], rates: list[float]) -> list[int]:
    """Whole copies near the rates, from the first to the last, carrying the words left over."""
    carry, copies = 0.0, []
    for size, r in zip(sizes, rates, strict=True):
        want = carry + r * size
        low = min(int(r), MAX_COPIES)
        n = min(max(low, round(want / size)), low + 1, MAX_COPIES) if size else 0
        carry = want - n * size
        copies.append(n)
    return copies


def _rounded(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by([("size", "descending"), ("mark", "ascending")])
    copies = round_rates(rows["size"].to_pylist(), rows["rate"].to_pylist())
    return (rows.select(["row", "size", "source_size", "target"])
            .append_column("copies", pa.array(copies, pa.int64())))


def mix(docs: DataFrame, weights: Iterable[float] = WEIGHTS, bucket: int = BUCKET,
        columns: list[str] | None = None) -> DataFrame:
    """(row, size, source_size, target, copies): ``row`` is a struct of the documents' columns
    (or some of them)."""
    row = F.struct(*(F.col(f"`{c}`") for c in columns or docs.columns)).alias("row")
    source = F.col("source").cast("string")
    sized = docs.select(row, source.alias("source"), _name(source).alias("name"),
                        word_count(F.col("text")).alias("size"),
                        F.xxhash64(F.col("doc_id").cast("string"), source, "text").alias("mark"))
    if columns is not None:  # small rows: count the words once
        sized = kept(sized, "sizes")
    hist = kept(sized.groupBy("name", "source", "size").agg(F.count("*").alias("n")), "counts")
    sources = hist.groupBy("name", "source").agg(
        F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("docs"))
    state = solve(hist.select("name", "size", "n"), with_targets(sources, weights))
    dealt = sized.drop("source").join(
        state.select("name", "words", "docs", "target", "cap", "mean", "tilt"), "name").select(
        "row", "name", "size", F.col("words").alias("source_size"), "target", "mark",
        rate().alias("rate"),
        F.pmod(F.col("mark"), F.ceil(F.col("docs") / bucket)).alias("bucket"))
    fields = {f.name: f for f in dealt.schema.fields}
    out = T.StructType([*(fields[c] for c in ("row", "size", "source_size", "target")),
                        T.StructField("copies", T.LongType())])
    return dealt.groupBy("name", "bucket").applyInArrow(_rounded, out)


def digest(mixed: DataFrame) -> DataFrame:
    return mixed.select("row.doc_id", "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"))


def copied(mixed: DataFrame, name: str = "copies") -> DataFrame:
    """The documents the mix takes, each with its number of copies in a last column. Where the
    documents have a column of that name, it gets an underscore more."""
    taken = {f.name.lower() for f in mixed.schema["row"].dataType.fields}
    while name.lower() in taken:
        name += "_"
    return mixed.where("copies > 0").select("row.*", F.col("copies").alias(name))
