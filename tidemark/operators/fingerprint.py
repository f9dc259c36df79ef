"""Comparison of two builds of a table without sorting or joining them.

Each build is folded, in one pass, to a count and two sums of row hashes per range of key hashes: an order-free fingerprint of
as many rows as there are ranges. Only ranges whose fingerprints differ are looked at row by row, so builds that agree cost one
scan each, and builds that differ in few keys shuffle few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.parity import bag_diff

RANGE_BITS = 10


def key_range(keys: Sequence[str], bits: int = RANGE_BITS) -> Column:
    """The range of a key: the leading bits of its hash."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits).cast("int")


def _hash(columns: Sequence[str], seed: int) -> Column:
    # A hash passes over nulls, so each value is told apart from a missing one.
    parts = [part for c in columns for part in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(seed), *parts)


def _hash_sums(column: str) -> list[Column]:
    """The sum of a hash as those of its halves: longs, which hold the halves of two billion rows of a range."""
    low = F.col(column).bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    return [F.sum(low).alias(f"{column}_low"), F.sum(F.shiftright(F.col(column), 32)).alias(f"{column}_high")]


def fingerprints(frame: DataFrame, keys: Sequence[str], columns: Sequence[str], bits: int = RANGE_BITS) -> DataFrame:
    """``(range, n)`` and sums of two hashes: the rows of each range of keys; columns are taken in the order of their names."""
    names = sorted(columns)
    rows = frame.select(key_range(keys, bits).alias("range"), *[_hash(names, seed).alias(f"h{seed}") for seed in (1, 2)])
    return rows.groupBy("range").agg(F.count(F.lit(1)).alias("n"), *_hash_sums("h1"), *_hash_sums("h2"))


def differing_ranges(sides: DataFrame) -> DataFrame:
    """``(dataset, range)`` from fingerprints of both builds, tagged ``dataset`` and ``side`` (1 or -1): those that do not cancel."""
    sums = ("n", "h1_low", "h1_high", "h2_low", "h2_high")
    signed = [F.sum(F.col(c) * F.col("side")).alias(c) for c in sums]
    return sides.groupBy("dataset", "range").agg(*signed).filter(" OR ".join(f"{c} <> 0" for c in sums)).select("dataset", "range")


def differences(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], ranges: DataFrame,
                bits: int = RANGE_BITS) -> DataFrame:
    """Rows of the given ranges that the builds do not share, with ``surplus`` as in ``bag_diff``."""
    def inside(frame: DataFrame) -> DataFrame:
        return frame.select(*columns).withColumn("range", key_range(keys, bits)).join(ranges, "range", "left_semi").drop("range")

    return bag_diff(inside(left), inside(right), columns)


def surplus(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], ranges: DataFrame,
            bits: int = RANGE_BITS) -> DataFrame:
    """``surplus`` of each row of the given ranges that the builds do not share, without the row: for reports that count.

    Rows meet by both of their hashes, 16 bytes a row whatever its width.
    """
    names = sorted(columns)

    def hashed(frame: DataFrame, side: int) -> DataFrame:
        inside = frame.withColumn("range", key_range(keys, bits)).join(F.broadcast(ranges), "range", "left_semi")
        return inside.select(*[_hash(names, seed).alias(f"h{seed}") for seed in (1, 2)], F.lit(side).alias("_side"))

    return hashed(left, 1).unionByName(hashed(right, -1)).groupBy("h1", "h2").agg(
        F.sum("_side").alias("surplus")).filter("surplus <> 0").select("surplus")
