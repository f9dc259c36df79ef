"""Named parquet tables and declared empty tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def register(frame: DataFrame, name: str) -> None:
    """Hand a frame to SQL under a name."""
    frame.createOrReplaceTempView(name)


def scan(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few parameter rows with a declared schema."""
    return spark.createDataFrame(list(rows), schema)
