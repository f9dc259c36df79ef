"""Column selection, tables and task helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
ARROW_ROWS = 2_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(frame: DataFrame, **wanted: str) -> DataFrame:
    """The given columns under the operator's own names, whatever else the frame holds.

    Columns are found by exact name, the first of several. All others are dropped first, so an extra
    ``TEXT`` beside ``text`` or a second ``text`` is never ambiguous.
    """
    names = list(frame.columns)
    positions = {}
    for own, name in wanted.items():
        if name not in names:
            raise ValueError(f"column {name} is missing; there are {names}")
        positions[own] = names.index(name)
    plain = frame.toDF(*[f"_c{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"_c{i}").alias(own) for own, i in positions.items()])


def carry(frame: DataFrame, prefix: str = "_in") -> tuple[DataFrame, list[str]]:
    """The frame with columns named by position, and the original names, to be put back at the end."""
    return frame.toDF(*[f"{prefix}{i}" for i in range(len(frame.columns))]), list(frame.columns)


def kept(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back."""
    path = scratch(frame.sparkSession, f"llm-{name}")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    return [b"" if x is None else x for x in batch.column(column).cast(pa.binary()).to_pylist()]


def released(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The task, after which its worker gives freed memory back: Spark keeps idle workers for the tasks to come."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
            if trim:
                trim(0)

    return run


def words_column(text: Column) -> Column:
    """Words of a text as an array; null and blank texts give an empty one."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != F.lit(""))


def reachable(spark: SparkSession) -> SparkSession:
    """Lets Python workers on this file system import the package, wherever the driver was started.

    A cluster gets the package with ``--py-files`` or installed, as any other. Batches of rows with whole texts
    are kept smaller than Spark's default, which bounds the memory of the workers.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark
