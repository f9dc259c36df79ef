"""Exact global ranks and top-k without sending every row to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_dir

_PARTITION_SHIFT = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def global_rank(frame: DataFrame, name: str, order: Sequence[Column]) -> DataFrame:
    """Add ``row_number() over (order by ...)`` as BIGINT, computed in parallel.

    The rows are range-sorted (``order`` must end in a unique column, so ties split evenly), each
    row's partition and position are frozen by a reliable checkpoint, and the rank is the position
    plus the number of rows in earlier partitions. The offsets hold one row per partition.
    """
    shared_dir(frame.sparkSession)  # makes sure a reliable checkpoint folder is set
    placed = (
        frame.orderBy(*order)
        .withColumn("_row", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("_row", _PARTITION_SHIFT)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    # Offsets: at most one row per partition of the sort, so this broadcast is bounded.
    ranked = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    position = F.col("_row").bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1))
    return ranked.withColumn(name, position + F.col("_offset") + F.lit(1)).drop("_row", "_part", "_offset")


def top_k(frame: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """The first ``k`` rows: each task keeps ``k``, one merges them."""
    return frame.orderBy(*order).limit(k)


def top_k_per_group(frame: DataFrame, keys: Sequence[str], k: int, order: Sequence[Column],
                    name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group; the rank limit is applied before the shuffle too."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return frame.withColumn(name, F.row_number().over(window).cast("bigint")).filter(F.col(name) <= k)
