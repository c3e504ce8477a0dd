import random

import pytest
from pyspark.sql import functions as F

from waybill.operators import buckets, key_index, storage
from waybill.operators.key_index import KeyIndex

SCHEMA = "id string, n int, day string"


def rows(spark, *found):
    return spark.createDataFrame(list(found), SCHEMA)


def stored(spark, path):
    return {r.id: (r.n, str(r.day)) for r in spark.read.schema(SCHEMA).parquet(path).collect()}


def index_of(spark, path, size=4):
    return KeyIndex(spark, path, storage.schema_of(SCHEMA), ["id"], "day", size)


def spoil(folder):
    """Makes the files of a folder unreadable."""
    files = list(folder.glob("*.parquet"))
    assert files
    for f in files:
        f.write_bytes(b"not parquet")
        crc = f.with_name(f".{f.name}.crc")
        crc.unlink(missing_ok=True)


def test_linear_hashing_moves_rows_of_one_bucket_only(spark):
    df = spark.range(2000).select(F.xxhash64("id").alias("h"))
    before = None
    for n in range(1, 40):
        now = {r.h: r.b for r in df.select("h", buckets.address(F.col("h"), n).alias("b")).collect()}
        assert set(now.values()) <= set(range(n))
        if before:
            moved = {h for h in now if now[h] != before[h]}
            assert {now[h] for h in moved} <= {n - 1}
            assert {before[h] for h in moved} <= {buckets.parent(n - 1)}
            assert buckets.divided(n - 1, n) == [buckets.parent(n - 1)]
        before = now
    assert buckets.divided(3, 9) == [0, 1, 2] and buckets.divided(4, 6) == [0, 1]


def test_upsert_opens_only_the_keys_buckets_and_places(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "BUCKET_KEYS", 20)
    monkeypatch.setattr(KeyIndex.__init__, "__defaults__", (20,))
    path = str(tmp_path / "t")
    storage.upsert(rows(spark, *((f"k{i}", 0, f"d{i % 9}") for i in range(195))), path, ["id"],
                   "day")
    index = index_of(spark, path, 20)
    assert index.state().buckets == 10
    asked = rows(spark, ("k1", 1, "d5"), ("k10", 1, "d1"))  # both lie in d1; one moves
    used = index.buckets_of(asked)
    assert 1 <= len(used) <= 2
    for b in set(range(10)) - set(used):
        spoil(tmp_path / "t__keys" / f"_bucket={b}")
    for d in (2, 3, 4, 6, 7, 8):  # the footer of d0 tells the schema
        spoil(tmp_path / "t" / f"day=d{d}")
    storage.upsert(asked, path, ["id"], "day")
    got = spark.read.schema(SCHEMA).parquet(path).filter("day in ('d0', 'd1', 'd5')").collect()
    held = {r.id: (r.n, r.day) for r in got}
    assert held["k1"] == (1, "d5") and held["k10"] == (1, "d1") and len(got) == 3 * 22


@pytest.mark.parametrize("version", [None, "n"])
def test_many_upserts_are_as_a_dictionary(spark, tmp_path, monkeypatch, version):
    """Keys move to and fro, buckets are divided and merged on the way."""
    monkeypatch.setattr(KeyIndex.__init__, "__defaults__", (8,))
    monkeypatch.setattr(key_index, "MOST_FILES", 2)
    rng, path, want = random.Random(4), str(tmp_path / "t"), {}
    for step in range(9):
        batch = {f"k{rng.randrange(12 * (step + 1))}": (rng.randrange(20), f"d{rng.randrange(4)}")
                 for _ in range(14)}
        storage.upsert(rows(spark, *((k, *v) for k, v in batch.items())), path, ["id"], "day",
                       version=version)
        for k, v in batch.items():
            if not version or k not in want or want[k][0] <= v[0]:
                want[k] = v
        assert stored(spark, path) == want
    state = index_of(spark, path).state()
    assert state.buckets > 4 and state.open == () and state.last == 8
    places = {r.id: r._at for r in index_of(spark, path).locate(
        spark.read.schema(SCHEMA).parquet(path)).collect()}
    assert places == {k: v[1] for k, v in want.items()}


@pytest.mark.parametrize("where", ["_overwrite", "_drop"])
def test_an_upsert_that_failed_is_made_good_by_the_next(spark, tmp_path, monkeypatch, where):
    path = str(tmp_path / "t")
    storage.upsert(rows(spark, ("a", 0, "d1"), ("b", 0, "d1"), ("c", 0, "d2")), path, ["id"], "day")
    with monkeypatch.context() as m:
        m.setattr(storage, where, lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            storage.upsert(rows(spark, ("a", 1, "d3")), path, ["id"], "day")
    assert index_of(spark, path).state().open == (1,)
    storage.upsert(rows(spark, ("c", 2, "d1")), path, ["id"], "day")
    storage.upsert(rows(spark, ("a", 3, "d2")), path, ["id"], "day")
    assert stored(spark, path) == {"a": (3, "d2"), "b": (0, "d1"), "c": (2, "d1")}


def test_other_writes_drop_the_index(spark, tmp_path):
    path = str(tmp_path / "t")
    first = rows(spark, ("a", 0, "d1"), ("b", 0, "d2"))
    for write in (lambda: storage.create_or_replace(first, path, "day"),
                  lambda: storage.append(rows(spark, ("x", 0, "d7")), path, "day"),
                  lambda: storage.replace_partitions(rows(spark, ("y", 0, "d8")), path, "day")):
        storage.create_or_replace(first, path, "day")
        storage.upsert(rows(spark, ("a", 1, "d2")), path, ["id"], "day")
        assert index_of(spark, path).state()
        write()
        assert index_of(spark, path).state() is None
        storage.upsert(rows(spark, ("a", 2, "d3"), ("x", 2, "d3"), ("y", 2, "d3")), path, ["id"],
                       "day")
        got = stored(spark, path)
        assert {k: got[k] for k in "abxy"} == {"a": (2, "d3"), "b": (0, "d2"), "x": (2, "d3"),
                                               "y": (2, "d3")}
        assert spark.read.parquet(path).count() == 4


def test_a_key_that_holds_the_partition_needs_no_index(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2):
        storage.upsert(rows(spark, ("a", n, "d1"), ("a", n, "d2")), path, ["day", "id"], "day")
    assert spark.read.parquet(path).filter("n = 2").count() == 2
    assert not (tmp_path / "t__keys").exists()
