"""Which partitions of a table may hold rows of a subject, known without opening them.

The index is a table beside the indexed one (``<path>__subjects``): for every partition a membership
filter of the subjects in it, a hashed bitmap in pieces of 4 KB, of which each subject sets
``HASHES`` bits. A question reads only the pieces of its subjects' bits. A subject that is in a
partition is always found; one in a few hundred others is named in vain.

With each partition the index keeps a fingerprint of its files' names. A partition whose files are
others now, or that is new, counts as one that may hold anybody until ``refresh`` reads its keys
again; one whose files are as they were is never read. So no writer has to know of the index.

Subjects' ids are not in the index. The driver sees partition values and file names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.operators import storage

C = F.col
PIECE = 32_768  # bits of Spark's bitmaps
HASHES = 4
BITS_EACH = 16  # bits a subject of the fullest partition


def _piece_and_bit(key: Column, i: int, pieces: int) -> Column:
    at = F.pmod(F.xxhash64(F.lit(i), key.cast("string")), F.lit(pieces * PIECE))
    return F.struct(F.floor(at / PIECE).cast("int").alias("piece"), (at % PIECE).alias("bit"))


def _bits(key: Column, pieces: int) -> Column:
    return F.array(*(_piece_and_bit(key, i, pieces) for i in range(HASHES)))


class SubjectIndex:
    SCHEMA = T.StructType([
        T.StructField("piece", T.IntegerType()), T.StructField("bits", T.BinaryType()),
        T.StructField("pieces", T.IntegerType()), T.StructField("print", T.StringType()),
        T.StructField("part", T.StringType())])

    def __init__(self, spark: SparkSession, path: str, partition: str, key: str) -> None:
        self.spark, self.path, self.partition, self.key = spark, path.rstrip("/"), partition, key
        self.folder = f"{self.path}__subjects/{quote(key)}"

    def _prints(self) -> dict[str, str]:
        """The fingerprint of each partition's files."""
        out = {}
        for value, where in storage.folders(self.spark, self.path, self.partition).items():
            fs, p = storage._fs(self.spark, where)
            names = sorted(f"{f.getPath().getName()} {f.getLen()}" for f in fs.listStatus(p)
                           if not f.getPath().getName().startswith(("_", ".")))
            out[value] = hashlib.sha256("\n".join(names).encode()).hexdigest()
        return out

    def _read(self) -> DataFrame:
        if not storage.exists(self.spark, self.folder):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.folder)

    def _known(self) -> dict[str, str]:
        """Fingerprints that the index was made from."""
        return {r["part"][1:]: r["print"] for r in
                self._read().select("part", "print").distinct().collect()}

    def stale(self) -> list[str]:
        """Partitions that were written since they were read."""
        known = self._known()
        return [v for v, p in self._prints().items() if known.get(v) != p]

    def refresh(self) -> list[str]:
        """Reads the keys of the partitions that have changed; returns these."""
        now = self._prints()
        changed = self.stale()
        if not changed:
            return []
        rows = storage.table(self.spark, self.path, self.partition).filter(
            storage._in(self.partition, [None if v == storage.NO_VALUE else v for v in changed]))
        # a letter before the value, for Spark reads the folder of no value back as null
        part = F.concat(F.lit("p"), F.coalesce(C(self.partition), F.lit(storage.NO_VALUE)))
        keys = rows.select(part.alias("part"), C(self.key).cast("string").alias("key")).filter(
            C("key").isNotNull()).distinct()
        with storage.staged(keys, self.folder) as held:
            most = held.groupBy("part").count().agg(F.max("count")).first()[0] or 0
            pieces = max(1, -(-most * BITS_EACH // PIECE))
            maps = held.select("part", F.inline(_bits(C("key"), pieces))).groupBy("part", "piece").agg(
                F.bitmap_construct_agg("bit").alias("bits"))
            prints = self.spark.createDataFrame(
                [(f"p{v}", now[v]) for v in changed], "part string, print string")
            # a partition without subjects has one row without bits, so that it counts as read
            new = prints.join(maps, "part", "left").select(
                F.coalesce("piece", F.lit(-1)).alias("piece"), "bits",
                F.lit(pieces).alias("pieces"), "print", "part")
            storage._overwrite(new, self.folder, "part")
        return changed

    def may_hold(self, subjects: DataFrame) -> list[str]:
        """Values of the partitions that may hold rows of these subjects (column of the key)."""
        stale = set(self.stale())
        ids = subjects.select(C(self.key).cast("string").alias("id")).filter(
            "id is not null").distinct()
        sizes = [r[0] for r in self._read().select("pieces").distinct().collect()]
        found = set()
        for pieces in sizes:  # a handful of sizes, as partitions grow
            asked = ids.select("id", F.inline(_bits(C("id"), pieces)))
            at = F.expr("substring(bits, cast(bit div 8 as int) + 1, 1)")
            byte = F.conv(F.hex(at), 16, 10).cast("int")
            isset = F.expr("shiftright(byte, cast(bit % 8 as int)) & 1") == 1
            hits = (self._read().filter(C("pieces") == pieces).join(asked, "piece")
                    .withColumn("byte", byte).filter(isset).groupBy("part", "id").agg(
                F.count_distinct("piece", "bit").alias("hit")))
            wanted = asked.groupBy("id").agg(F.count_distinct("piece", "bit").alias("all"))
            found |= {r[0][1:] for r in hits.join(wanted, "id").filter("hit = all").select(
                "part").distinct().collect()}
        return sorted(stale | found & set(self._prints()))


def rows_of(index: SubjectIndex, subjects: DataFrame) -> DataFrame:
    """The table's rows of the subjects, from the partitions that may hold some."""
    table = storage.table(index.spark, index.path, index.partition)
    ids = subjects.select(C(index.key).alias("_id")).distinct()
    near = _values(index.may_hold(subjects))
    return table.filter(storage._in(index.partition, near)).join(
        ids, C(index.key) == C("_id"), "left_semi")


def _values(parts: Sequence[str]) -> list:
    return [None if v == storage.NO_VALUE else v for v in parts]
