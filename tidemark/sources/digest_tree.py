"""Digests of files of any size: byte ranges are hashed in parallel, and their digests joined in a tree.

A file is cut into ranges of equal length, each read by one task in small pieces, so neither a file nor a range is ever held
whole. A node above the ranges is the SHA-256 of the digests of up to ``FAN_OUT`` nodes below it, in order; the root tells
two states of a file apart. Two trees are compared from the roots down, and only below nodes that differ.

Defined results: a file without bytes has no range and is not listed; one that lost all its bytes misses all its ranges. Files are named by their path below the folder, so that copies in
different places compare. An empty folder gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE_BYTES = 64 << 20
FAN_OUT = 1024
PIECE_BYTES = 1 << 20
LEAVES = "file string, number bigint, start bigint, length bigint, sha256 string, line_feeds bigint"


def file_ranges(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES, glob: str = "*") -> DataFrame:
    """file, start, length: the ranges of all files below a folder. Only the listing is read."""
    files = spark.read.format("binaryFile").options(pathGlobFilter=glob, recursiveFileLookup=True).load(folder).select(
        "path", "length").filter("length > 0")
    inside = F.substring_index("path", folder.split("://")[-1].rstrip("/") + "/", -1)
    step = F.lit(range_bytes).cast("bigint")
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, step))
    return files.select(inside.alias("file"), "length", starts.alias("start")).select(
        "file", "start", F.least(step, F.col("length") - F.col("start")).alias("length"))


def range_digests(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES, glob: str = "*", tasks: int | None = None) -> DataFrame:
    """The ranges with their number, digest and line feeds; ranges are dealt evenly, whichever file they are of."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for r in batch.to_pylist():
                digest, lines, left = hashlib.sha256(), 0, r["length"]
                with system.open_input_file(f"{root}/{r['file']}") as source:
                    source.seek(r["start"])
                    while left:
                        piece = source.read(min(left, PIECE_BYTES))
                        if not piece:
                            raise EOFError(f"{r['file']} ends {left} bytes before it should")
                        digest.update(piece)
                        lines += piece.count(b"\n")
                        left -= len(piece)
                yield pa.RecordBatch.from_pylist([{
                    "file": r["file"], "number": r["start"] // range_bytes, "start": r["start"], "length": r["length"],
                    "sha256": digest.hexdigest(), "line_feeds": lines}])

    ranges = file_ranges(spark, folder, range_bytes, glob)
    tasks = tasks or spark.sparkContext.defaultParallelism * 4
    return ranges.repartition(tasks, "file", "start").mapInArrow(read, LEAVES)


def tree(leaves: DataFrame, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """(file, number, sha256) of each level, from the ranges up to the roots. ``leaves`` is read once a level: store it."""
    levels = [leaves.select("file", "number", "sha256")]
    nodes = (leaves.agg(F.max("number")).first()[0] or 0) + 1
    while nodes > 1:
        below = levels[-1].groupBy("file", F.floor(F.col("number") / fan_out).alias("parent")).agg(
            F.array_sort(F.collect_list(F.struct("number", "sha256"))).alias("children"))
        joined = F.array_join(F.transform("children", lambda c: c["sha256"]), "")
        levels.append(below.select("file", F.col("parent").alias("number"), F.sha2(joined, 256).alias("sha256")))
        nodes = -(-nodes // fan_out)
    return levels


def changed_ranges(now: list[DataFrame], then: list[DataFrame], fan_out: int = FAN_OUT) -> DataFrame:
    """(file, number, change) of the ranges that are ``changed``, ``added`` or ``missing``.

    Trees of different heights are compared from the height of the lower one down.
    """
    found = None
    for level in reversed(range(min(len(now), len(then)))):
        a, b = now[level], then[level]
        if found is not None:
            parents = found.select("file", F.col("number").alias("parent"))
            a, b = (t.withColumn("parent", F.floor(F.col("number") / fan_out)).join(parents, ["file", "parent"], "left_semi")
                    .drop("parent") for t in (a, b))
        both = a.withColumnRenamed("sha256", "now").join(b.withColumnRenamed("sha256", "then"), ["file", "number"], "full")
        found = both.filter(~F.col("now").eqNullSafe(F.col("then"))).select(
            "file", "number", F.when(F.col("now").isNull(), "missing").when(F.col("then").isNull(), "added").otherwise("changed").alias("change"))
    return found

