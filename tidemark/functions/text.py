"""Blank handling, strict casts and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LAST_PLACE = 9999  # fixed value: sorts unplaced entries after all placed ones


def blank_to_null(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def strict(column: Column, dtype: str) -> Column:
    """Typed value of a raw text column; bad text raises under ANSI."""
    value = blank_to_null(column)
    return value if dtype == "string" else value.cast(dtype)


def is_blank(column: Column) -> Column:
    return column.isNull() | (F.trim(column) == "")


def order_key(position: Column) -> Column:
    return F.coalesce(position, F.lit(LAST_PLACE).cast("bigint"))


def position_label(position: Column, status: Column) -> Column:
    return F.coalesce(position.cast("string"), status)


def result_status(position: Column, status: Column) -> Column:
    return F.when(position.isNotNull(), F.lit("Classified")).otherwise(status)


def round_label(number: Column, slug: Column) -> Column:
    """``01 - AUSTRALIA`` from a round number and a dashed identifier."""
    padded = F.lpad(number.cast("string"), 2, "0")
    return F.concat(padded, F.lit(" - "), F.upper(F.replace(slug, F.lit("-"), F.lit(" "))))


def shared_label(name: Column, qualifier: Column, is_shared: Column) -> Column:
    """``name / QUALIFIER`` where the name alone is ambiguous."""
    return F.when(is_shared, F.concat(name, F.lit(" / "), F.upper(qualifier))).otherwise(name)
