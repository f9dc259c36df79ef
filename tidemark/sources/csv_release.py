"""CSV files of releases: ``<landing>/<dataset>/release_tag=<tag>/*.csv``, read as text by header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

RESCUED = "_rescued_data"
SOURCE_FILE = "_source_file"
INGESTED_AT = "_ingested_at"

# Quoted fields may span lines, and a quote inside one is doubled.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"'}


def release_path(landing: str, dataset: str, tag: str) -> str:
    return f"{landing.rstrip('/')}/{dataset}/release_tag={tag}"


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any file system, none if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []


def landed_releases(spark: SparkSession, landing: str, dataset: str) -> list[str]:
    """Tags with a folder for the dataset; one name per release, no data is read."""
    names = names_in(spark, f"{landing.rstrip('/')}/{dataset}")
    return sorted(n.split("=", 1)[1] for n in names if n.startswith("release_tag="))


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a release, from the first line of its first file."""
    return spark.read.options(**CSV_OPTIONS).csv(path).columns


def text_schema(columns: Sequence[str], rescued: bool = False) -> StructType:
    names = [*columns, RESCUED] if rescued else columns
    return StructType([StructField(name, StringType()) for name in names])


def _reader(reader, columns: Sequence[str], strict: bool):
    """Text columns only. Files whose header is not ``columns`` in that order are an error, never a
    silent shift; malformed rows fail (strict) or are kept whole in the rescue column."""
    reader = reader.format("csv").options(**CSV_OPTIONS).option("enforceSchema", "false")
    if strict:
        return reader.schema(text_schema(columns)).option("mode", "FAILFAST")
    return (reader.schema(text_schema(columns, rescued=True))
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RESCUED))


def _with_provenance(frame: DataFrame, columns: Sequence[str], tag: str, strict: bool) -> DataFrame:
    rescued = F.lit(None).cast("string") if strict else F.col(RESCUED)
    return frame.select(
        *[F.col(f"`{c}`") for c in columns], F.lit(tag).alias("release_tag"), rescued.alias(RESCUED),
        F.col("_metadata.file_path").alias(SOURCE_FILE), F.current_timestamp().alias(INGESTED_AT))


def read_snapshot(spark: SparkSession, landing: str, dataset: str, tag: str, strict: bool = True) -> DataFrame:
    """One release as a static read, with the columns of a raw table."""
    path = release_path(landing, dataset, tag)
    columns = header(spark, path)
    return _with_provenance(_reader(spark.read, columns, strict).load(path), columns, tag, strict)


def stream_snapshot(spark: SparkSession, landing: str, dataset: str, tag: str, strict: bool = True,
                    max_files: int | None = None) -> DataFrame:
    """The same rows as a file stream; ``max_files`` bounds a micro-batch."""
    path = release_path(landing, dataset, tag)
    columns = header(spark, path)
    reader = _reader(spark.readStream, columns, strict)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _with_provenance(reader.load(path), columns, tag, strict)


def raw_schema(columns: Sequence[str]) -> StructType:
    """Schema of a stored raw segment."""
    text = text_schema([*columns, "release_tag", RESCUED, SOURCE_FILE])
    return text.add(INGESTED_AT, "timestamp")


def write_releases(frame: DataFrame, landing: str, dataset: str, tags: Sequence[str]) -> None:
    """Land several releases of a dataset in one pass, as compressed files: ``release_tag`` tells the release of a row.

    A release without rows still gets its folder, with a header.
    """
    frame.write.options(header="true", escape='"', compression="gzip").partitionBy("release_tag").csv(f"{landing.rstrip('/')}/{dataset}")
    landed = landed_releases(frame.sparkSession, landing, dataset)
    for tag in tags:
        if tag not in landed:
            nothing = frame.sparkSession.createDataFrame([], frame.drop("release_tag").schema)
            write_release(nothing, landing, dataset, tag)


def write_release(frame: DataFrame, landing: str, dataset: str, tag: str) -> str:
    """Land a frame of text columns as CSV files of one release: one per partition of the frame."""
    path = release_path(landing, dataset, tag)
    frame.write.options(header="true", escape='"').csv(path)
    return path
