"""Query results as files, and coverage of files outside the contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.csv_release import CSV_OPTIONS


def export(frame: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write in parallel, one file per task, as CSV with header or as JSON lines."""
    if fmt == "csv":
        frame.write.options(header="true", escape='"').csv(path)
    elif fmt == "json":
        frame.write.json(path)
    else:
        raise ValueError(f"unknown export format: {fmt}")


def member_coverage(spark: SparkSession, path: str, name: str, seasons: Sequence[str],
                    season_column: str = "year") -> DataFrame:
    """Rows, columns and rows per selected season of an extra file, one row per season."""
    rows = spark.read.options(**CSV_OPTIONS).csv(path)
    columns = rows.columns
    per_season = rows.groupBy(season_column).agg(F.count(F.lit(1)).alias("n"))
    total = per_season.agg(F.sum("n")).scalar()
    return per_season.filter(F.col(season_column).isin(list(seasons))).select(
        F.lit(name).alias("member"), total.alias("total_rows"), F.lit(",".join(columns)).alias("column_list"),
        F.col(season_column).alias("season"), F.col("n").alias("season_rows"))
