"""A small state beside a table: a JSON object, replaced as a whole.

Each state is a file of its own, renamed into place under the next number, so a reader finds the
old one or the new one; the highest number counts.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class StateFile:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, f"{folder.rstrip('/')}/_state"

    def _at(self, name: str = ""):  # noqa: ANN202
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}".rstrip("/"))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self) -> list[str]:
        fs, p = self._at()
        return sorted(f.getPath().getName() for f in fs.listStatus(p)
                      if f.getPath().getName().endswith(".json")) if fs.exists(p) else []

    def read(self) -> dict | None:
        names = self._names()
        if not names:
            return None
        fs, p = self._at(names[-1])
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(
                stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, state: dict) -> None:
        names = self._names()
        number = int(names[-1].split(".")[0]) + 1 if names else 0
        fs, new = self._at(f"{number:012d}.tmp")
        stream = fs.create(new, True)
        try:
            stream.write(bytearray(json.dumps(state).encode()))
        finally:
            stream.close()
        if not fs.rename(new, self._at(f"{number:012d}.json")[1]):
            raise OSError(f"the state in {self.folder} could not be written")
        for name in names:
            fs.delete(self._at(name)[1], False)
