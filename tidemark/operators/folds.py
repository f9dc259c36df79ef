"""Totals by a sorted scan: a second way to a sum, which has no operator in common with an aggregate.

Rows are dealt by ranges of their keys and of a further column, so a key that holds much of a table is spread over several
ranges, and sorted. A scan adds up runs of equal keys. What is left of a key are few rows, which a second scan by the keys
alone adds up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _run_sums(batch: pa.RecordBatch, keys: Sequence[str]) -> pa.RecordBatch:
    """One row for each run of equal keys, with the sum of ``total``."""
    new = np.ones(batch.num_rows, bool)
    new[1:] = False
    for name in keys:
        column = batch.column(name)
        a, b = column[1:], column[:-1]
        both_null = pc.and_(pc.is_null(a), pc.is_null(b))
        same = pc.if_else(both_null, True, pc.fill_null(pc.equal(a, b), False))
        new[1:] |= ~same.to_numpy(zero_copy_only=False)
    first = np.flatnonzero(new)
    total = np.add.reduceat(batch.column("total").to_numpy(), first)
    return pa.RecordBatch.from_arrays(
        [*(batch.column(k).take(pa.array(first)) for k in keys), pa.array(total)], names=[*keys, "total"])


def _scan(ordered: DataFrame, keys: Sequence[str]) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.select([*keys, "total"])
            if held is not None:  # the last run may go on
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            sums = _run_sums(batch, keys)
            yield sums.slice(0, sums.num_rows - 1)
            held = sums.slice(sums.num_rows - 1)
        if held is not None:
            yield held

    types = ", ".join(f"`{k}` {ordered.schema[k].dataType.simpleString()}" for k in keys)
    return ordered.mapInArrow(work, f"{types}, total bigint")


def sorted_totals(frame: DataFrame, keys: Sequence[str], value: str, spread: str) -> DataFrame:
    """``keys`` and ``total``, the sum of a BIGINT column; ``spread`` is any column that tells rows of a key apart."""
    rows = frame.select(*keys, F.col(spread).alias("_spread"), F.col(value).alias("total"))
    partial = _scan(rows.repartitionByRange(*keys, "_spread").sortWithinPartitions(*keys), keys)
    return _scan(partial.repartitionByRange(*keys).sortWithinPartitions(*keys), keys)


def recomputed(name: str, first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two results of ``keys`` and ``total``: how many keys either has, how many differ, and the first that does."""
    a = first.select(*keys, F.col("total").alias("_one"))
    b = second.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("total").alias("_two"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    same = F.col("_one").eqNullSafe(F.col("_two"))
    written = F.concat_ws("/", *[F.coalesce(k, f"_{k}").cast("string") for k in keys])
    return a.join(b, on, "full").agg(
        F.count(F.lit(1)).alias("n_keys"), F.count_if(~same).alias("differing"),
        F.min(F.when(~same, written)).alias("first_differing")).select(F.lit(name).alias("result"), "*")
