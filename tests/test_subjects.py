import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from waybill.operators import governance as gov
from waybill.operators import storage
from waybill.operators.subject_index import SubjectIndex, rows_of
from waybill.sources import ledger

SCHEMA = "customer_id string, customer_name string, n int, day string"


def people(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "customer_id string")


@pytest.fixture
def indexed(spark, tmp_path):
    """Nine days with fifty customers each, one with none, one without a date."""
    path = str(tmp_path / "t")
    rows = [(f"C{d * 50 + k}", "Ann", k, f"2024-01-0{d}") for d in range(1, 10) for k in range(50)]
    rows += [(None, "x", 1, "2024-01-10"), ("C60", "Bea", 2, "2024-01-09"), ("C7", "Cy", 3, None)]
    storage.append(spark.createDataFrame(rows, SCHEMA), path, "day")
    index = SubjectIndex(spark, path, "day", "customer_id")
    assert len(index.refresh()) == 11 and index.refresh() == []
    return path, index


def spoil(tmp_path, *days):
    for d in days:
        for f in (tmp_path / "t" / f"day={d}").glob("*.parquet"):
            size = f.stat().st_size
            f.write_bytes(b"x" * size)  # the same name and length: not stale
            f.with_name(f".{f.name}.crc").unlink(missing_ok=True)


def test_only_partitions_that_may_hold_a_subject_are_named(spark, indexed):
    path, index = indexed
    assert index.may_hold(people(spark, "C60")) == ["2024-01-01", "2024-01-09"]
    assert index.may_hold(people(spark, "C7")) == [storage.NO_VALUE]
    named = [len(index.may_hold(people(spark, f"X{i}"))) for i in range(25)]
    assert sum(named) <= 5  # 25 unknown ones in eleven partitions
    assert index.may_hold(people(spark)) == []
    every = index.may_hold(people(spark, *(f"C{i}" for i in range(50, 500))))
    assert set(every) >= {f"2024-01-0{d}" for d in range(1, 10)}


def test_erasure_and_export_open_only_those(spark, tmp_path, indexed):
    path, index = indexed
    spoil(tmp_path, *(f"2024-01-0{d}" for d in range(2, 9)))
    gone = people(spark, "C60")
    gov.export_indexed({"t": index}, gone, str(tmp_path / "e"))
    got = spark.read.schema(SCHEMA).json(str(tmp_path / "e" / "t")).collect()
    assert sorted((r.customer_name, r.n) for r in got) == [("Ann", 10), ("Bea", 2)]
    touched = gov.erase(spark, path, "day", gone, "customer_id", ["customer_name"], index)
    assert sorted(touched) == ["2024-01-01", "2024-01-09"]
    assert index.stale() == [] and index.may_hold(gone) == []
    back = spark.read.schema(SCHEMA).parquet(path).filter("day in ('2024-01-01', '2024-01-09')")
    assert back.filter("customer_name = 'ANONYMIZED'").count() == 2 and back.count() == 101


def test_partitions_that_were_written_count_until_read_again(spark, indexed):
    path, index = indexed
    storage.append(spark.createDataFrame([("N1", "New", 1, "2024-01-03"), ("N1", "New", 1, "2024-02-01")],
                                         SCHEMA), path, "day")
    assert sorted(index.stale()) == ["2024-01-03", "2024-02-01"]
    assert set(index.may_hold(people(spark, "C60"))) == {"2024-01-01", "2024-01-03", "2024-01-09",
                                                         "2024-02-01"}
    assert rows_of(index, people(spark, "N1")).count() == 2
    index.refresh()
    assert index.may_hold(people(spark, "N1")) == ["2024-01-03", "2024-02-01"]


def test_corrections(spark, indexed):
    path, index = indexed
    new = spark.createDataFrame([("C60", "Bert", None), ("C61", None, 99)],
                                "customer_id string, customer_name string, n int")
    gov.rectify(spark, path, "day", new, "customer_id", ["customer_name", "n"], index)
    got = {(r.customer_id, r.customer_name, r.n) for r in spark.read.parquet(path).filter(
        "customer_id in ('C60', 'C61', 'C62')").collect()}
    assert got == {("C60", "Bert", 10), ("C60", "Bert", 2), ("C61", "Ann", 99), ("C62", "Ann", 12)}
    with pytest.raises(ValueError, match="share the key"):
        gov.rectify(spark, path, "day", new.union(new), "customer_id", ["n"], index)


# ---- ledger

def messages(spark, *found):
    return spark.createDataFrame([(p, o, f"{p}-{o}") for p, o in found],
                                 "partition int, offset long, body string")


@pytest.mark.parametrize("size", [4, 1 << 20])
def test_intervals_are_the_runs(spark, size):
    rng = random.Random(size)
    found = [(p, o) for p in (0, 1, None) for o in range(60) if rng.random() < 0.7] + [(0, None)]
    want = set()
    for p in (0, 1):
        own = sorted(o for q, o in found if q == p and o is not None)
        begin = own[0]
        for a, b in zip(own, [*own[1:], 10**9], strict=True):
            if b != a + 1:
                want.add((p, begin, a))
                begin = b
    got = ledger.intervals(messages(spark, *found, *found), size)
    assert {tuple(r) for r in got.select("partition", "first", "last").collect()} == want
    assert ledger.unseen(messages(spark, *found), got, size).count() == 0


def test_a_reloaded_file_adds_nothing(spark, tmp_path):
    paths, day = (str(tmp_path / "ledger"), str(tmp_path / "t")), dt.date(2024, 1, 1)
    first = messages(spark, *((0, o) for o in range(10)), (1, 5), (1, 5))
    assert ledger.load(first, *paths, 0, day) == 11
    assert ledger.load(first, *paths, 0, day) == 11  # the same batch, repeated
    assert ledger.load(first, *paths, 1, day) == 0  # the file comes again
    assert ledger.load(messages(spark, *((0, o) for o in range(5, 30) if o != 20)), *paths, 2,
                       day) == 19
    entries = ledger.read(spark, paths[0])
    assert sorted(tuple(r) for r in ledger.report(entries).collect()) == [
        (0, 0, 19, 20, 0), (0, 21, 29, 9, 1), (1, 5, 5, 1, 0)]
    assert ledger.overlaps(entries).count() == 0
    table = spark.read.parquet(paths[1])
    assert table.count() == table.select("partition", "offset").distinct().count() == 30
    twice = entries.select("partition", "first", "last").union(entries.select(
        "partition", "first", (F.col("first") + 1).alias("last")))
    assert {r.partition for r in ledger.overlaps(twice).collect()} == {0, 1}
