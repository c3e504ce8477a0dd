import random

import pytest
from pyspark.sql import functions as F

from waybill.operators import scans

MACHINE = scans.Machine(("none", "a", "b"), ("x", "y", "z"),
                        {("none", "x"): "a", ("a", "y"): "b", ("b", "z"): "none", ("a", "x"): "a",
                         ("b", "x"): "a"}, "none")


def data(n, seed=1):
    """One key holds half of all rows; one is null; times repeat but for the id."""
    rng = random.Random(seed)
    return [(i, None if i % 17 == 0 else "hot" if i % 2 else f"k{i % 5}", rng.randrange(40),
             rng.choice(["x", "y", "z", "?", None])) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, k string, t int, e string")


def ordered(rows):
    keys = {}
    for r in rows:
        keys.setdefault(r[1], []).append(r)
    return {k: sorted(v, key=lambda r: (r[2], r[0])) for k, v in keys.items()}


@pytest.mark.parametrize("size", [1, 2, 7, 1024])
def test_previous_rows_and_numbers(spark, size):
    rows = data(300)
    got = {r.id: (r.sequence, r.previous and (r.previous.id, r.previous.e)) for r in scans.placed(
        frame(spark, rows).repartition(6), ["k"], ["t", "id"], ["id", "e"], size).collect()}
    want = {r[0]: (i + 1, (own[i - 1][0], own[i - 1][3]) if i else None)
            for own in ordered(rows).values() for i, r in enumerate(own)}
    assert got == want


@pytest.mark.parametrize("size", [2, 5, 1024])
def test_a_machine_runs_as_one_row_after_another(spark, size):
    rows = data(400, size)
    out = scans.run(frame(spark, rows).repartition(6), ["k"], ["t", "id"], "e", MACHINE, size)
    assert out.columns == ["id", "k", "t", "e", "state_before", "allowed"]
    got = {r.id: (r.state_before, r.allowed) for r in out.collect()}
    want = {}
    for own in ordered(rows).values():
        state = "none"
        for r in own:
            want[r[0]] = (state, (state, r[3]) in MACHINE.steps)
            state = MACHINE.steps.get((state, r[3]), state)
    assert got == want


def test_small_keys_are_not_numbered(spark, monkeypatch):
    """Nulls in the order come first, and columns without an order pass through."""
    numbered, seen = scans.numbered, []
    monkeypatch.setattr(scans, "numbered", lambda df, *a: seen.append(
        df.select("_row.k").distinct().collect()) or numbered(df, *a))
    rows = [("few", 2, "y"), ("few", None, "x"), ("few", 1, "?"), (None, 1, "x"), (None, 2, "x"),
            *(("many", i, "x") for i in range(9))]
    events = spark.createDataFrame(rows, "k string, t int, e string").withColumn(
        "m", F.create_map(F.lit("t"), "t"))
    few = scans.run(events.filter("k is null or k = 'few'"), ["k"], ["t"], "e", MACHINE, 4)
    assert sorted((str(r.k), r.t or 0, r.m["t"], r.state_before, r.allowed)
                  for r in few.collect()) == [
        ("None", 1, 1, "none", True), ("None", 2, 2, "a", True), ("few", 0, None, "none", True),
        ("few", 1, 1, "a", False), ("few", 2, 2, "a", True)]
    assert not seen
    assert scans.run(events, ["k"], ["t"], "e", MACHINE, 4).filter("allowed").count() == 13
    assert [r.k for r in seen[0]] == ["many"]


def test_a_hot_key_is_many_tasks(spark):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 900))
        .alias("k"), F.lit(1).alias("t"), "id", F.lit("x").alias("e"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = scans.run(rows, ["k"], ["t", "id"], "e", MACHINE, 256)
        part = out.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count_if(F.col("k") == "hot").alias("hot"), F.count("*").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(r.n for r in part) == 40_000 and sum(r.hot for r in part) == 20_000
    assert sum(r.hot > 0 for r in part) >= 12 and max(r.hot for r in part) < 5_000


def test_nothing_to_scan(spark):
    none = frame(spark, [])
    assert scans.run(none, ["k"], ["t"], "e", MACHINE).count() == 0
    assert scans.placed(none, ["k"], ["t"], ["e"]).count() == 0
