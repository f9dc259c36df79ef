"""Group totals next to their rows, running totals, and dense series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored


def with_group_totals(frame: DataFrame, keys: Sequence[str], *totals: Column,
                      store: str | None = None) -> DataFrame:
    """``agg(...) over (partition by keys)`` as an aggregate joined back.

    A window would send all rows of a group to one task. Here a group crosses the shuffle as
    partial totals; the totals are broadcast if adaptive execution finds them small, and else a
    skewed side of the join is split. Null keys match themselves, as in a window.

    The frame is read twice. Where it is itself a result of joins or aggregates, name it with
    ``store``: it is then written once, since each reading would otherwise run all of that again.
    """
    if store:
        frame = stored(frame, store)
    per_group = frame.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(*totals)
    same_group = F.lit(True)
    for k in keys:
        same_group = same_group & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    return frame.join(per_group, same_group).drop(*[f"_g_{k}" for k in keys])


def running_total(frame: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Running sum by rows, for series whose length the data model bounds."""
    window = (Window.partitionBy(*keys).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return frame.withColumn(name, F.sum(value).over(window))


def chunked_running_total(frame: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column,
                          value: str, name: str) -> DataFrame:
    """The same sum for series of any length.

    ``chunk`` must not decrease along ``order``. Each chunk is summed on its own, in parallel, on top
    of the total of the chunks before it; only chunk totals meet in one window.
    """
    cut = frame.withColumn("_chunk", chunk)
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*keys, "_chunk").agg(F.sum(value).alias("_total"))
    base = totals.select(*keys, "_chunk", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    within = (Window.partitionBy(*keys, "_chunk").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = cut.withColumn("_within", F.sum(value).over(within))
    return summed.join(base, [*keys, "_chunk"]).withColumn(name, F.col("_base") + F.col("_within")).drop(
        "_chunk", "_base", "_within")


def dense_running_total(frame: DataFrame, key: str, step: str, value: str, total: str,
                        last: Column) -> DataFrame:
    """A running total with a row for every step from the first one seen up to ``last``.

    ``frame`` holds at most one row per (key, step). Each row is carried forward to the step before
    the next one, so the gaps fill without crossing keys with a calendar. Filled rows get value 0.
    Rows after ``last`` are no part of the series.
    """
    frame = frame.filter(F.col(step) <= last)
    window = Window.partitionBy(key).orderBy(step)
    summed = frame.withColumn(total, F.sum(value).over(window))
    until = F.lead(F.col(step)).over(window) - F.lit(1)
    spread = summed.withColumn("_until", F.coalesce(until, last)).withColumn("_from", F.col(step))
    filled = spread.withColumn(step, F.explode(F.sequence("_from", "_until", F.lit(1).cast(frame.schema[step].dataType))))
    zero = F.lit(0).cast(frame.schema[value].dataType)
    kept = F.when(F.col(step) == F.col("_from"), F.col(value)).otherwise(zero)
    return filled.withColumn(value, kept).drop("_from", "_until")
