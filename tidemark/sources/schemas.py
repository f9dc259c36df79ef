"""The schemas of stored parquet files, file by file.

A table of files written at different times may hold files of different schemas, which a reader of the folder does not show.
Only footers are read, by as many tasks as there are files to share out.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def _columns(path: str) -> list[tuple[str, str, int]]:
    """Name and type of each column of a file, and its rows."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    files, inside = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    with files.open_input_file(inside) as handle:
        footer = pq.ParquetFile(handle)
        rows, known = footer.metadata.num_rows, footer.metadata.metadata or {}
        if _SPARK_SCHEMA in known:
            return [(f["name"], f["type"] if isinstance(f["type"], str) else json.dumps(f["type"], sort_keys=True), rows)
                    for f in json.loads(known[_SPARK_SCHEMA])["fields"]]
        return [(f.name, str(f.type), rows) for f in footer.schema_arrow]


def file_columns(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(file, column_name, type, row_count)`` of every parquet file of some folders."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(list(paths)).select("path")

    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(file, *column) for file in batch["path"] for column in _columns(file)]
            yield pd.DataFrame(rows, columns=["file", "column_name", "type", "row_count"])

    return listed.mapInPandas(footers, "file string, column_name string, type string, row_count bigint")


def schema_differences(dataset: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns by name, from ``file_columns`` of two builds: ``(dataset, column_name, left_type, right_type, files, row_count)``
    with the files of the second build that do not have the type of the first, and the rows they hold; type null: absent."""
    expected = left.groupBy("column_name").agg(F.array_join(F.array_sort(F.collect_set("type")), " or ").alias("left_type"))
    found = right.groupBy("column_name", F.col("type").alias("right_type")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("row_count"))
    other = found.join(expected, "column_name", "left").filter(~F.col("right_type").eqNullSafe(F.col("left_type")))
    # A column that is absent from a file has no row; its files are all files but those that have it.
    whole = right.groupBy("file").agg(F.max("row_count").alias("r")).agg(F.count(F.lit(1)).alias("all_files"), F.sum("r").alias("all_rows"))
    having = found.groupBy("column_name").agg(F.sum("files").alias("files"), F.sum("row_count").alias("row_count"))
    short = expected.join(having, "column_name", "left").select(
        "column_name", "left_type", F.lit(None).cast("string").alias("right_type"),
        (whole.select("all_files").scalar() - F.coalesce("files", F.lit(0))).alias("files"),
        (whole.select("all_rows").scalar() - F.coalesce("row_count", F.lit(0))).alias("row_count")).filter("files > 0")
    return other.select("column_name", "left_type", "right_type", "files", "row_count").unionByName(short).select(
        F.lit(dataset).alias("dataset"), "*")
