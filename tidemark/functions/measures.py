"""Conditional counts, zero fill and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(condition: Column) -> Column:
    return F.count_if(condition).cast("bigint")


def flag(condition: Column) -> Column:
    """1 or 0; unknown counts as 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def known(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def zero_fill(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def quotient(part: Column, whole: Column) -> Column:
    """Exact ``part / whole`` to at least twelve decimals; NULL where ``whole`` is zero.

    Decimal division, since a binary quotient can land on the wrong side of a rounding tie.
    """
    return part.cast("decimal(28,4)") / F.nullif(whole.cast("decimal(22,2)"), F.lit(0))


def ratio(part: Column, whole: Column, digits: int, scale: int = 1) -> Column:
    """``scale * part / whole`` rounded half up, as DOUBLE."""
    return F.round(quotient(part, whole) * F.lit(scale), digits).cast("double")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return ratio(part, whole, digits, 100)


def mean_where(value: Column, condition: Column, digits: int) -> Column:
    """Rounded mean of the known values that meet the condition."""
    chosen = F.when(condition, value)
    return ratio(F.sum(chosen), F.count(chosen), digits)
