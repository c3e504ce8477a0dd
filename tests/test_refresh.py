import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from waybill.operators import refresh, storage

SCHEMA = "id string, n int, day string"


def day(n):
    return dt.date(2024, 1, n)


def rows(spark, *found):
    return spark.createDataFrame(list(found), SCHEMA).withColumn("day", F.to_date("day"))


def total(name):
    return lambda df: df.groupBy("day").agg(F.sum("n").alias(name))


def graph(first=None, second=None):
    """Two tables of one source, one of both, and a sum over three days."""
    both = refresh.Daily("both", ("sums", "counts"), lambda a, b: a.join(b, "day"))

    def three(df):
        spread = df.select(F.explode(F.sequence("day", F.date_add("day", 2))).alias("day"), "s")
        return spread.groupBy("day").agg(F.sum("s").alias("s"))

    return [refresh.Daily("three", ("both",), three,
                          affects=lambda d: [d + dt.timedelta(k) for k in range(3)],
                          needs=lambda d: [d - dt.timedelta(k) for k in range(3)]),
            both,
            refresh.Daily("sums", ("rows",), first or total("s")),
            refresh.Daily("counts", ("rows",), second or (
                lambda df: df.groupBy("day").agg(F.count("*").alias("c"))))]


def files(folder):
    return {str(p.relative_to(folder)) for p in folder.rglob("*.parquet")}


def held(spark, root, name):
    return {r.day: tuple(r[:-1]) for r in storage.table(
        spark, f"{root}/{name}", "day", storage.schema_of("day date")["day"].dataType).collect()}


def test_a_late_row_refreshes_exactly_its_days(spark, tmp_path):
    root, log = str(tmp_path), refresh.Changes(spark, str(tmp_path))
    first = rows(spark, *((f"k{i}", i, f"2024-01-{i % 9 + 1:02d}") for i in range(30)))
    log.record("rows", storage.upsert(first, f"{root}/rows", ["id"], "day"), 1)
    report = refresh.refresh(spark, root, graph(), {"rows": "day"}, 1)
    assert report["both"] == [day(n) for n in range(1, 10)]
    assert report["three"] == [day(n) for n in range(1, 12)]
    before = {n: files(tmp_path / n) for n in ("sums", "counts", "both", "three")}
    late = rows(spark, ("k4", 100, "2024-01-05"), ("k99", 1, "2024-01-05"))
    log.record("rows", storage.upsert(late, f"{root}/rows", ["id"], "day"), 2)
    report = refresh.refresh(spark, root, graph(), {"rows": "day"}, 2)
    assert report == {"sums": [day(5)], "counts": [day(5)], "both": [day(5)],
                      "three": [day(5), day(6), day(7)]}
    for name, old in before.items():
        gone = {f.split("/")[0] for f in old - files(tmp_path / name)}
        assert gone == {f"day={d}" for d in report[name]}
    # as if computed anew
    want = {}
    for r in spark.read.parquet(f"{root}/rows").collect():
        want[r.day] = want.get(r.day, 0) + r.n
    assert {d: v[0] for d, v in held(spark, root, "sums").items()} == want
    assert {d: v[0] for d, v in held(spark, root, "three").items()} == {
        day(n): sum(want.get(day(n) - dt.timedelta(k), 0) for k in range(3)) for n in range(1, 10)
    } | {day(10): want[day(9)] + want[day(8)], day(11): want[day(9)]}
    # nothing new: nothing is written
    before = {n: files(tmp_path / n) for n in before}
    assert set(map(tuple, refresh.refresh(spark, root, graph(), {"rows": "day"}, 2).values())) == {()}
    assert before == {n: files(tmp_path / n) for n in before}


def test_independent_tables_are_computed_at_once_and_failures_made_good(spark, tmp_path):
    root, log = str(tmp_path), refresh.Changes(spark, str(tmp_path))
    log.record("rows", storage.upsert(rows(spark, ("a", 1, "2024-01-01")), f"{root}/rows", ["id"],
                                      "day"), 1)
    meet = threading.Barrier(2)

    def waits(name):
        def compute(df):
            meet.wait(60)  # both are running
            return total(name)(df)
        return compute

    refresh.refresh(spark, root, graph(waits("s"), waits("c")), {"rows": "day"}, 1)

    def fails(df):
        raise OSError("no room")

    log.record("rows", storage.upsert(rows(spark, ("b", 5, "2024-01-02")), f"{root}/rows", ["id"],
                                      "day"), 2)
    report = refresh.refresh(spark, root, graph(second=fails), {"rows": "day"}, 2)
    assert report["sums"] == [day(2)] and report["counts"] == "failed: no room"
    assert "counts failed" in report["both"] and "both failed" in report["three"]
    log.record("rows", storage.upsert(rows(spark, ("c", 7, "2024-01-04")), f"{root}/rows", ["id"],
                                      "day"), 3)
    report = refresh.refresh(spark, root, graph(), {"rows": "day"}, 3)
    assert report["counts"] == report["both"] == [day(2), day(4)] and report["sums"] == [day(4)]
    assert set(held(spark, root, "both")) == {day(1), day(2), day(4)}


def test_cycles_and_unknown_sources_are_refused(spark, tmp_path):
    a = refresh.Daily("a", ("b",), total("s"))
    b = refresh.Daily("b", ("a",), total("s"))
    with pytest.raises(ValueError, match="each other"):
        refresh.refresh(spark, str(tmp_path), [a, b], {}, 1)
    with pytest.raises(ValueError, match="unknown"):
        refresh.refresh(spark, str(tmp_path), [a], {}, 1)


def test_the_refresh_stores_only_what_its_tables_read(spark):
    from waybill.catalog import base, jobs
    t = base.tables_of(spark, "/root/testdata/sf0.001")
    assert base.QUERIES["mnt_3_refresh_all"](t).count() == 5
    held = base.stored(t, jobs.REFRESHED_COLUMNS)
    for name, columns in jobs.REFRESHED_COLUMNS.items():
        assert spark.read.parquet(f"{held.path}/{name}").columns == list(columns)
