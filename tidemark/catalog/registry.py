"""Registration of queries and the comparison form of their results."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.catalog.oracle_tables import with_tables
from tidemark.session import TABLE_TASKS, tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
SURVEY_IDS: dict[str, list[str]] = {}


def plain(frame: DataFrame) -> DataFrame:
    """Exact sums leave as DOUBLE and counts as BIGINT, so both engines show the same types."""
    columns = []
    for field in frame.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return frame.select(*columns)


def rounded(expression: str, digits: int) -> str:
    """Half-up rounding for the comparison statement, where ROUND works on binary doubles."""
    return f"round(({expression}) + sign({expression}) * 1e-9, {digits})"


def query(ids: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name for the given survey items."""
    def add(function: Query) -> Query:
        @functools.wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(function(tune(spark, TABLE_TASKS), folder))

        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        SURVEY_IDS[name] = re.split(r"\s+", ids.strip())
        if sql is not None:
            ORACLE[name] = with_tables(sql)
        return function

    return add
