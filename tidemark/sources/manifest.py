"""A manifest of landed files and its checks, as Spark jobs over the files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quality import union_rows
from tidemark.plans.schema import Dataset
from tidemark.sources import csv_release as csv

KEYS = ["dataset", "release_tag", "file"]


def _header_names(content: Column) -> Column:
    """Column names of a file, from its first line, by the rules of the CSV reader: a quoted name may hold
    commas and doubled quotes. The line is cut from the bytes, at whatever length; nothing behind it is read."""
    first = F.substring_index(content.cast("string"), "\n", 1)
    line = F.regexp_replace(first, "[\r\ufeff]", "")
    # Every name is ended by a comma, the last one by one added here.
    fields = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit('("(?:[^"]|"")*"|[^,]*),'), F.lit(1))
    quoted = '^"(.*)"$'
    return F.transform(fields, lambda f: F.when(
        f.rlike(quoted), F.replace(F.regexp_extract(f, quoted, 1), F.lit('""'), F.lit('"'))).otherwise(f))


def file_facts(spark: SparkSession, landing: str, dataset: str, tag: str) -> DataFrame:
    """Digest, size and header of each file. Whole files are hashed, one file per task row, so a file must
    stay below the 2 GiB that one binary value can hold; larger releases come in more files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(
        csv.release_path(landing, dataset, tag))
    return files.select(
        F.lit(dataset).alias("dataset"), F.lit(tag).alias("release_tag"), F.col("_metadata.file_path").alias("file"),
        "length", F.sha2("content", 256).alias("sha256"), _header_names(F.col("content")).alias("columns"))


def row_facts(spark: SparkSession, landing: str, dataset: str, tag: str) -> DataFrame:
    """Rows and malformed rows of each file, read by position: the header may itself be at fault.

    Short and long rows land in the rescue column. The parser only sees them if every column is
    asked for, so each rescued row counts through a hash of all of them (always as one).
    """
    path = csv.release_path(landing, dataset, tag)
    columns = [f"c{i}" for i in range(len(csv.header(spark, path)))]
    rows = (
        spark.read.options(**csv.CSV_OPTIONS).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", csv.RESCUED)
        .schema(csv.text_schema(columns, rescued=True)).csv(path)
    )
    one = F.greatest(F.lit(1), F.least(F.lit(1), F.hash(*columns)))
    return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col(csv.RESCUED).isNotNull(), one)), F.lit(0)).cast("bigint").alias("malformed"))


def build_manifest(spark: SparkSession, landing: str, releases: Mapping[str, list[str]]) -> DataFrame:
    """One row per file of the given releases, by dataset."""
    parts = []
    for dataset, tags in releases.items():
        for tag in tags:
            counts = row_facts(spark, landing, dataset, tag)
            joined = file_facts(spark, landing, dataset, tag).join(counts, "file", "left")
            parts.append(joined.select(
                *KEYS, "length", "sha256", "columns",
                *[F.coalesce(c, F.lit(0)).alias(c) for c in ("row_count", "malformed")]))
    return union_rows(parts)


def table_manifest(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Rows of each file of a stored parquet table, from its footers: what must arrive of it, told by nobody who reads it."""
    rows = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("row_count"))
    return rows.select(F.lit(dataset).alias("dataset"), "file", "row_count")


def expected_rows(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("dataset", "release_tag").agg(F.sum("row_count").alias("row_count"))


def manifest_violations(manifest: DataFrame, datasets: Mapping[str, Dataset]) -> DataFrame:
    """``(dataset, release_tag, file, violation)`` for bad headers, bad rows and empty releases."""
    required = F.lit(None).cast("array<string>")
    exempt = [name for name, d in datasets.items() if d.may_be_empty]
    for name, dataset in datasets.items():
        demanded = F.array(*[F.lit(c) for c in dataset.required_raw])
        required = F.when(F.col("dataset") == name, demanded).otherwise(required)
    lowered = F.transform("columns", lambda c: F.lower(c))
    rules = {
        "blank_header": F.exists("columns", lambda c: F.trim(c) == ""),
        "duplicate_header": F.size(F.array_distinct(lowered)) < F.size("columns"),
        "missing_column": F.size(F.array_except(required, F.col("columns"))) > 0,
        "reserved_column": F.exists("columns", lambda c: c.startswith("_") | (c == "release_tag")),
        "malformed_rows": F.col("malformed") > 0,
    }
    named = F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    per_file = manifest.select(*KEYS, F.explode(F.filter(named, lambda v: v.isNotNull())).alias("violation"))
    empty = expected_rows(manifest).filter((F.col("row_count") == 0) & ~F.col("dataset").isin(exempt)).select(
        "dataset", "release_tag", F.lit(None).cast("string").alias("file"), F.lit("empty_release").alias("violation"))
    return per_file.unionByName(empty)


def verify_manifest(current: DataFrame, stored: DataFrame) -> DataFrame:
    """Files whose bytes, row count or columns no longer are what the stored manifest says."""
    facts = ["sha256", "row_count", "columns"]
    a = current.select(*KEYS, *[F.col(f).alias(f"now_{f}") for f in facts], F.lit(True).alias("_now"))
    b = stored.select(*KEYS, *facts, F.lit(True).alias("_then"))
    joined = b.join(a, KEYS, "full")
    both = F.col("_now").isNotNull() & F.col("_then").isNotNull()
    named = F.array(
        F.when(F.col("_now").isNull(), "file_missing"), F.when(F.col("_then").isNull(), "file_unlisted"),
        *[F.when(both & ~F.col(f).eqNullSafe(F.col(f"now_{f}")), f"{f}_changed") for f in facts])
    return joined.select(*KEYS, F.explode(F.filter(named, lambda v: v.isNotNull())).alias("violation"))
