"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on. Joins and shuffles are sized by adaptive
# execution, so nothing here depends on the size of the data or of the cluster.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even where that costs one more shuffle after it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    # Tables are written whole and read a few times: a third less to write for little more work.
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` overrides or adds to them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: What a task of a table query takes, whatever the size of the tables: a hash aggregate, a sort or a join side holds as many rows
#: as its task is given. Files are cut, and shuffles dealt finely enough to be put together again, to about this much.
TABLE_TASKS = {
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0b",
}

#: For joins of wide rows with narrow ones: where one side of a shuffled join fits a task everywhere, it is hashed and neither sorted.
HASHED_JOINS = {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "8m"}


def tune(spark: SparkSession, more: Mapping[str, str] | None = None) -> SparkSession:
    """Apply the runtime settings, and ``more``, to a session somebody else built."""
    for key, value in {**RUNTIME, **(more or {})}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` where it is set.

    Only a session on one machine may go without one and gets a fresh local folder; on a cluster
    executors would each write to their own disk, so that is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    # A context that already checkpoints somewhere keeps that place.
    current = context.getCheckpointDir()
    if current:
        return os.path.dirname(current.rstrip("/"))
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    fresh = tempfile.mkdtemp(prefix="tidemark-")
    context.setCheckpointDir(fresh)
    return fresh


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    For frames that several checks read: the work is done once, the plan starts anew at a table
    scan with its own column pruning, and a lost executor costs no recomputation.
    """
    path = scratch(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
