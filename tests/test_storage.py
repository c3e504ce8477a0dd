import datetime as dt

import pytest
from pyspark.sql import functions as F

from waybill.operators import governance as gov
from waybill.operators import storage


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, status string, version int, day string") \
        .withColumn("day", F.to_date("day"))


def stored(spark, path):
    return {r.id: (r.status, str(r.day)) for r in spark.read.parquet(path).collect()}


def test_upsert_moves_rows_and_drops_empty_days(spark, tmp_path):
    path = str(tmp_path / "t")
    storage.upsert(orders(spark, ("1", "Pending", 1, "2024-01-01"),
                          ("2", "Pending", 1, "2024-01-02"),
                          ("3", "Pending", 1, "2024-01-03")), path, ["id"], "day")
    storage.upsert(orders(spark, ("1", "Shipped", 2, "2024-01-02"),
                          ("4", "Pending", 2, "2024-01-04")), path, ["id"], "day")
    assert stored(spark, path) == {
        "1": ("Shipped", "2024-01-02"), "2": ("Pending", "2024-01-02"),
        "3": ("Pending", "2024-01-03"), "4": ("Pending", "2024-01-04")}
    assert not (tmp_path / "t" / "day=2024-01-01").exists()


def test_upsert_leaves_other_days_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    storage.upsert(orders(spark, ("1", "a", 1, "2024-01-01"), ("2", "a", 1, "2024-01-02")), path,
                   ["id"], "day")
    before = sorted(p.name for p in (tmp_path / "t" / "day=2024-01-01").glob("*.parquet"))
    storage.upsert(orders(spark, ("2", "b", 2, "2024-01-02")), path, ["id"], "day")
    after = sorted(p.name for p in (tmp_path / "t" / "day=2024-01-01").glob("*.parquet"))
    assert before == after and stored(spark, path)["2"][0] == "b"


def test_upsert_twice_is_the_same(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = orders(spark, ("1", "a", 1, "2024-01-01"), ("2", "b", 1, "2024-01-01"))
    for _ in range(2):
        storage.upsert(rows, path, ["id"], "day")
    assert spark.read.parquet(path).count() == 2


def test_upsert_keeps_later_version(spark, tmp_path):
    path = str(tmp_path / "t")
    storage.upsert(orders(spark, ("1", "new", 5, "2024-01-01")), path, ["id"], "day",
                   version="version")
    storage.upsert(orders(spark, ("1", "old", 3, "2024-01-02"), ("2", "x", 1, "2024-01-02")), path,
                   ["id"], "day", version="version")
    assert stored(spark, path) == {"1": ("new", "2024-01-01"), "2": ("x", "2024-01-02")}


def test_a_new_table_is_written_once(spark, tmp_path, monkeypatch):
    packed = []
    monkeypatch.setattr(storage, "_packed", lambda df, by: packed.append(by) or df)
    for name in ("t", "marked"):
        path = str(tmp_path / name)
        if name == "marked":  # a marker file makes no table
            (tmp_path / name).mkdir()
            (tmp_path / name / "_SUCCESS").touch()
        assert storage.upsert(orders(spark, ("1", "a", 1, "2024-01-01"), ("2", "b", 1, None)), path,
                              ["id"], "day", version="version", moves=False)
        assert stored(spark, path) == {"1": ("a", "2024-01-01"), "2": ("b", "None")}
        assert packed == ["day"]
        packed.clear()


@pytest.mark.parametrize("moves", [True, False])
def test_stale_rows_are_found_by_keys_and_versions(spark, tmp_path, moves):
    path = str(tmp_path / "t")

    def upsert(*rows):
        return storage.upsert(orders(spark, *rows), path, ["id"], "day", version="version",
                              moves=moves)

    upsert(("1", "a", 5, "2024-01-01"), ("2", "a", None, "2024-01-01"), (None, "a", 1, "2024-01-02"))
    # later, equal, without version, null key; then only stale ones
    upsert(("1", "b", 5, "2024-01-01"), ("2", "b", 1, "2024-01-01"), (None, "b", 0, "2024-01-02"))
    upsert(("1", "c", None, "2024-01-01"), ("2", "c", 2, "2024-01-01"))
    assert upsert(("1", "d", 4, "2024-01-01"), ("2", "d", None, "2024-01-01")) == []
    assert sorted(spark.read.parquet(path).select("id", "status").collect(), key=str) == [
        ("1", "b"), ("2", "c"), (None, "a"), (None, "b")]


def test_upsert_rejects_repeated_keys_and_takes_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="share the key"):
        storage.upsert(orders(spark, ("1", "a", 1, "2024-01-01"), ("1", "b", 1, "2024-01-01")),
                       path, ["id"], "day")
    storage.upsert(orders(spark, ("1", "a", 1, "2024-01-01")).filter("false"), path, ["id"], "day")
    assert not storage.exists(spark, path)


def test_replace_removes_vanished_groups(spark, tmp_path):
    path = str(tmp_path / "t")
    storage.replace_partitions(orders(spark, ("1", "a", 1, "2024-01-01"),
                                      ("2", "b", 1, "2024-01-02")), path, "day")
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    storage.replace_partitions(orders(spark, ("9", "c", 1, "2024-01-01")), path, "day", days)
    assert stored(spark, path) == {"9": ("c", "2024-01-01")}


def test_snapshot_may_read_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    storage.snapshot(spark.range(4), path)
    storage.snapshot(spark.read.parquet(path).filter("id > 1"), path)
    assert {r.id for r in spark.read.parquet(path).collect()} == {2, 3}


def test_compact_keeps_rows_and_sorts(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(5):
        storage.append(orders(spark, *[(str(j), "s", i, f"2024-01-0{1 + j % 2}")
                                       for j in range(i * 10, i * 10 + 10)]), path, "day")
    storage.compact(spark, path, ["id"], "day")
    assert spark.read.parquet(path).count() == 50
    files = list((tmp_path / "t" / "day=2024-01-01").glob("*.parquet"))
    assert len(files) < 5
    ids = [r.id for r in spark.read.parquet(str(files[0])).collect()]
    assert ids == sorted(ids)


def test_quarantine_splits_and_null_is_bad(spark, tmp_path):
    df = spark.createDataFrame([(1, "ORDERS"), (2, None), (3, "BAD")], "id int, kind string")
    good = storage.quarantine(df, ~F.col("kind").isin("ORDERS"), "unknown type",
                              str(tmp_path / "q"), as_of="2024-01-01 00:00:00")
    assert [r.id for r in good.collect()] == [1]
    bad = spark.read.parquet(str(tmp_path / "q")).collect()
    assert {r.id for r in bad} == {2, 3} and bad[0].error_reason == "unknown type"


def test_steps_retry_and_report():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 2:
            raise RuntimeError("lost")

    def broken():
        raise RuntimeError("always")

    report = {r["step"]: (r["status"], r["attempts"])
              for r in storage.run_steps({"a": flaky, "b": broken, "c": lambda: None})}
    assert report == {"a": ("Succeeded", 2), "b": ("Failed", 3), "c": ("Succeeded", 1)}


def test_purge_by_day(spark, tmp_path):
    path = str(tmp_path / "t")
    storage.append(orders(spark, ("1", "a", 1, "2023-01-01"), ("2", "a", 1, "2024-01-01"),
                          ("3", "a", 1, "2024-01-02")), path, "day")
    # 2024 has 366 days: the first of January is exactly 365 days old here, and stays
    dropped = gov.purge(spark, path, "day", 365, as_of="2024-12-31 12:00:00")
    assert [str(d) for d in dropped] == ["2023-01-01"]
    assert set(stored(spark, path)) == {"2", "3"}


def test_purge_by_timestamp(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.sql("select id, timestamp(concat('2000-01-0', id, ' 12:30:00')) t "
                     "from range(1, 5)")
    storage.append(rows, path, "t")
    dropped = gov.purge(spark, path, "t", 10, as_of="2000-01-13 00:00:00")
    assert [str(d) for d in dropped] == ["2000-01-01 12:30:00", "2000-01-02 12:30:00"]
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [3, 4]


@pytest.mark.parametrize("first, then", [("A:B", "C/D=1%"), ("007", "7"), ("x y", None)])
def test_rows_move_out_of_oddly_named_partitions(spark, tmp_path, first, then):
    path = str(tmp_path / "t")
    kind = "id int, part string"
    storage.upsert(spark.createDataFrame([(1, first), (2, "stays")], kind), path, ["id"], "part")
    storage.upsert(spark.createDataFrame([(1, then)], kind), path, ["id"], "part")
    got = {r.id: r.part for r in storage.table(spark, path, "part").collect()}
    assert got == {1: then, 2: "stays"}
    assert first not in storage.folders(spark, path, "part")


def test_compact_keeps_the_names_of_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    storage.append(spark.createDataFrame([(1, "007"), (2, "08")], "id int, part string"), path,
                   "part")
    storage.compact(spark, path, ["id"], "part", ["007"])
    assert set(storage.folders(spark, path, "part")) == {"007", "08"}
    assert spark.read.parquet(path).count() == 2


def test_removal_of_a_missing_partition_raises(spark, tmp_path):
    path = str(tmp_path / "t")
    storage.append(spark.createDataFrame([(1, "a")], "id int, part string"), path, "part")
    with pytest.raises(ValueError, match="no partitions"):
        storage._drop(spark, path, "part", ["b"])


@pytest.mark.parametrize("partition", [None, "day"])
def test_a_failed_write_keeps_the_old_table(spark, tmp_path, partition):
    path = str(tmp_path / "t")
    old = orders(spark, ("1", "a", 1, "2024-01-01"))
    storage.create_or_replace(old, path, partition)
    bad = old.withColumn("status", F.expr("raise_error('stop')").cast("string"))
    with pytest.raises(Exception, match="stop"):
        storage.create_or_replace(bad, path, partition)
    assert stored(spark, path) == {"1": ("a", "2024-01-01")}
    storage.create_or_replace(orders(spark, ("2", "b", 1, "2024-01-02")), path, partition)
    assert stored(spark, path) == {"2": ("b", "2024-01-02")}


def test_erase_rewrites_only_the_subjects_days(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("C1", "Ann", "2024-01-01"), ("C2", "Bob", "2024-01-01"),
                                  ("C2", "Bob", "2024-01-02")],
                                 "customer_id string, customer_name string, day string") \
        .withColumn("day", F.to_date("day"))
    storage.append(rows, path, "day")
    subjects = spark.createDataFrame([("C1",)], "customer_id string")
    touched = gov.erase(spark, path, "day", subjects, "customer_id", ["customer_name"])
    assert [str(d) for d in touched] == ["2024-01-01"]
    got = spark.read.parquet(path).collect()
    assert len(got) == 3 and {r.customer_name for r in got} == {"ANONYMIZED", "Bob"}
    assert "C1" not in {r.customer_id for r in got}


def test_export_subject(spark, tmp_path):
    df = spark.createDataFrame([("C1", 1), ("C2", 2)], "customer_id string, n int")
    gov.export_subject({"orders": df}, "C1", str(tmp_path / "e"), fmt="csv")
    got = spark.read.option("header", True).csv(str(tmp_path / "e" / "orders")).collect()
    assert [r.n for r in got] == ["1"]


def test_immutable_after_thirty_days(spark):
    old = spark.createDataFrame([("I1", "2024-01-01", 10), ("I2", "2024-01-31", 10)],
                                "number string, d string, total int")
    new = spark.createDataFrame([("I1", "2024-01-01", 11), ("I2", "2024-01-31", 11),
                                 ("I3", "2023-01-01", 5)], "number string, d string, total int")
    ok, bad = gov.split_immutable(new, old, "number", "d", ["total"], as_of="2024-02-01 00:00:00")
    assert {r.number for r in ok.collect()} == {"I2", "I3"}
    assert [r.number for r in bad.collect()] == ["I1"]


def test_lifecycle(spark):
    rows = [("o", "Pending", 1), ("o", "Shipped", 2), ("o", "Cancelled", 3), ("p", "Pending", 1),
            ("p", "Cancelled", 2), ("q", "Delivered", 1), ("q", "Shipped", 2)]
    df = spark.createDataFrame(rows, "k string, status string, n int").withColumn(
        "ts", F.timestamp_seconds(F.lit(1700000000) + F.col("n") * 90000))
    got = {(r.k, r.violation) for r in
           gov.lifecycle_violations(df, "k", "status", "ts", "n").collect()}
    assert got == {("o", "cancelled after shipping"), ("q", "moved backwards")}


def test_weekly_report(spark):
    results = spark.createDataFrame(
        [("R1", "Fail", "2024-01-02 00:00:00"), ("R2", "Pass", "2024-01-02 00:00:00"),
         ("R1", "Pass", "2024-01-10 00:00:00"), ("R2", "Fail", "2024-01-10 00:00:00"),
         ("R3", "Pass", "2024-01-10 00:00:00")], "rule_id string, status string, c string") \
        .withColumn("checked_at", F.col("c").cast("timestamp"))
    log = spark.createDataFrame([("2024-01-10 00:00:00", "u1", "P"), ("2024-01-11 00:00:00", "u2", None),
                                 ("2023-12-01 00:00:00", "u3", "P")],
                                "c string, user string, partner string") \
        .withColumn("ts", F.col("c").cast("timestamp"))
    row = gov.weekly_report(results, log, as_of="2024-01-14 00:00:00").first()
    assert (float(row.quality_score), float(row.score_change)) == (66.67, 16.67)
    assert (row.open_issues, row.resolved_issues) == (1, 1)
    assert (row.api_calls, row.unique_users, row.access_violations) == (2, 2, 1)
    name = gov.partner_of_text(F.lit("SESSION PartnerID = 'ACME' x"))
    assert spark.range(1).select(name.alias("v")).first().v == "ACME"


def test_batches_share_a_day_and_replace_themselves(spark, tmp_path):
    path, day = str(tmp_path / "t"), dt.date(2024, 1, 1)

    def rows(*ids):
        return spark.createDataFrame([(i,) for i in ids], "id int")

    storage.replace_batch(rows(1, 2), path, 0, day)
    storage.replace_batch(rows(3), path, 1, day)
    storage.replace_batch(rows(4), path, 0, day)
    storage.replace_batch(rows(5), path, 2, day + dt.timedelta(days=1))
    got = spark.read.parquet(path).collect()
    assert sorted((r.id, r.batch_id) for r in got) == [(3, 1), (4, 0), (5, 2)]
    assert len(storage.folders(spark, path, "batch_day")) == 2


def test_refresh_pushes_the_range_of_days(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.sql("select timestamp(concat('2024-01-0', id)) ts from range(1, 9)").write.parquet(path)
    seen = []

    def compute(df):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return df.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))

    storage.refresh(compute, spark.read.parquet(path), str(tmp_path / "g"), "ts", "day",
                    [dt.date(2024, 1, 3), dt.date(2024, 1, 5)])
    assert "GreaterThanOrEqual(ts," in seen[0]
    assert sorted(str(r.day) for r in spark.read.parquet(str(tmp_path / "g")).collect()) == [
        "2024-01-03", "2024-01-05"]


@pytest.mark.parametrize("stop", [2, 3])
def test_a_swap_that_stopped_half_way_is_undone(spark, tmp_path, monkeypatch, stop):
    """The driver dies before the second rename, or before the old table is removed."""
    path = str(tmp_path / "t")
    storage.create_or_replace(orders(spark, ("1", "a", 1, "2024-01-01")), path)

    class Dies(BaseException):
        pass

    class Files:
        def __init__(self, fs):
            self.fs, self.renames = fs, 0

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            self.renames += 1
            if self.renames == stop:
                raise Dies
            return self.fs.rename(a, b)

    real, made = storage._fs, []

    def fs_of(session, where):
        fs, p = real(session, where)
        made[:] = made or [Files(fs)]
        return made[0], p

    with monkeypatch.context() as m:
        m.setattr(storage, "_fs", fs_of)
        if stop == 3:
            m.setattr(storage, "remove", lambda *a: (_ for _ in ()).throw(Dies))
        with pytest.raises(Dies):
            storage.create_or_replace(orders(spark, ("2", "b", 1, "2024-01-02")), path)
    assert (tmp_path / "t").exists() == (stop == 3)
    assert storage.recover(spark, path) == (stop == 2)
    assert set(stored(spark, path)) == {"1" if stop == 2 else "2"}
    assert not storage.recover(spark, path)
    storage.create_or_replace(orders(spark, ("3", "c", 1, "2024-01-02")), path)
    assert set(stored(spark, path)) == {"3"}


def test_replacing_partitions_computes_the_frame_once(spark, tmp_path):
    path = str(tmp_path / "t")
    storage.create_or_replace(orders(spark, ("1", "a", 1, "2024-01-01"), ("2", "a", 1, "2024-01-02"),
                                     ("3", "a", 1, None)), path, "day")
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    df = orders(spark, ("9", "b", 1, "2024-01-02"))
    storage.replace_partitions(df.mapInArrow(count, df.schema), path, "day",
                               [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3), None])
    assert made.value == 1 and set(stored(spark, path)) == {"9"}


def test_batches_are_merged_and_repeated_ones_replaced(spark, tmp_path):
    path, day = str(tmp_path / "b"), dt.date(2024, 1, 1)
    df = spark.range(3).withColumn("v", F.lit("x"))
    for n in range(7):
        storage.replace_batch(df.withColumn("v", F.lit(str(n))), path, n, day)
    storage.replace_batch(df.limit(0), path, 6, day)  # the repeated batch has nothing now
    storage.merge_batches(spark, path, df.schema, before=6, most=3)
    got = spark.read.parquet(path)
    assert got.count() == 18 and {r.batch_id for r in got.select("batch_id").distinct().collect()} \
        == {5}
    storage.replace_batch(df, path, 6, day)
    assert spark.read.parquet(path).count() == 21
