"""Bag equality and schema equality of two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def bag_diff(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows the two bags do not share, with ``surplus`` > 0 on the left and < 0 on the right.

    One shuffle with map-side sums gives both directions; columns are aligned by name. Copies of
    one row meet as partial sums, so a row that fills a third of a table does no harm.
    """
    names = list(columns or left.columns)
    signed = left.select(*names, F.lit(1).alias("_side")).unionByName(
        right.select(*names, F.lit(-1).alias("_side")))
    return signed.groupBy(*names).agg(F.sum("_side").alias("surplus")).filter("surplus <> 0")


def bag_report(name: str, left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(dataset, missing, extra)``: rows only on the left, rows only on the right."""
    return both_ways(name, bag_diff(left, right, columns))


def both_ways(name: str, diff: DataFrame) -> DataFrame:
    """``(dataset, missing, extra)`` of rows with ``surplus``."""
    return diff.agg(
        F.coalesce(F.sum(F.greatest("surplus", F.lit(0))), F.lit(0)).cast("bigint").alias("missing"),
        F.coalesce(F.sum(F.greatest(-F.col("surplus"), F.lit(0))), F.lit(0)).cast("bigint").alias("extra"),
    ).select(F.lit(name).alias("dataset"), "missing", "extra")


def except_both_ways(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The differing rows themselves, tagged with the side that has them in surplus."""
    names = list(columns or left.columns)
    a, b = left.select(*names), right.select(*names)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(
        b.exceptAll(a).withColumn("side", F.lit("right")))


def schema_diff(spark: SparkSession, left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns whose presence or type differs; reads no data."""
    a, b = dict(left.dtypes), dict(right.dtypes)
    rows = [(c, a.get(c), b.get(c)) for c in sorted(set(a) | set(b)) if a.get(c) != b.get(c)]
    return spark.createDataFrame(rows, "column_name string, left_type string, right_type string")
