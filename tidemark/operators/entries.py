"""Numbered entries in a folder: the log behind stored tables and ledgers.

An entry is a small JSON file under its number. It is written aside and then renamed to a name that must be free, so
readers find whole entries only, and of two writers that want one number the second is refused. Neither needs a Spark job.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from types import SimpleNamespace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.csv_release import names_in

_DIGITS = 12
_TAKEN = "FileAlreadyExistsException"


class ConcurrentWrite(RuntimeError):
    """Another writer has taken the number."""


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this run has written and nothing refers to."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


class NumberedLog:
    """The entries of one folder; ``schema`` holds their fields besides ``number``."""

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.schema = f"number bigint, {schema}"

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def numbers(self) -> list[int]:
        return sorted(int(n[:_DIGITS]) for n in names_in(self.spark, self.folder) if n.endswith(".json") and n[:_DIGITS].isdigit())

    def get(self, number: int) -> SimpleNamespace:
        path = self._path(f"{number:0{_DIGITS}d}.json")
        stream = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).open(path)
        try:
            return SimpleNamespace(**json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def last(self) -> SimpleNamespace | None:
        found = self.numbers()
        return self.get(found[-1]) if found else None

    def add(self, number: int, values: Mapping[str, object]) -> None:
        """Create an entry; ``ConcurrentWrite`` if the number is taken."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        aside, final = self._path(f"_{uuid.uuid4().hex}"), self._path(f"{number:0{_DIGITS}d}.json")
        files = aside.getFileSystem(conf)
        stream = files.create(aside, False)
        stream.write(bytearray(json.dumps({"number": number, **values}).encode()))
        stream.close()
        place = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), conf)
        keep_existing = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            place.rename(files.makeQualified(aside), files.makeQualified(final), keep_existing)
        except Py4JJavaError as error:
            files.delete(aside, False)
            if _TAKEN in error.java_exception.getClass().getName():
                raise ConcurrentWrite(f"{final} was written by another run") from error
            raise

    def append(self, values: Mapping[str, object], tries: int = 20) -> int:
        """Create an entry under the next free number, for entries that do not depend on the ones before."""
        for _ in range(tries):
            number = (self.numbers() or [0])[-1] + 1
            try:
                self.add(number, values)
                return number
            except ConcurrentWrite:
                continue
        raise ConcurrentWrite(f"no free number under {self.folder} after {tries} tries")

    def read(self) -> DataFrame:
        if not self.numbers():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).json(self.folder).filter(F.col("number").isNotNull())
