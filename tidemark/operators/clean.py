"""Raw text rows of one release to typed rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import strict


def select_release(raw: DataFrame, tag: str) -> DataFrame:
    """Rows of one release. On a table partitioned by tag this prunes the others."""
    return raw.filter(F.col("release_tag") == tag)


def in_scope(raw: DataFrame, column: str, minimum: int) -> DataFrame:
    """Rows from season ``minimum`` on. Check for blanks first: they would vanish here."""
    return raw.filter(F.col(column).cast("bigint") >= minimum)


def type_columns(
    raw: DataFrame,
    columns: Iterable[tuple[str, str, str]],
    derived: Mapping[str, str] | None = None,
    release_seq: int | None = None,
) -> DataFrame:
    """Rename, blank-to-null and strictly cast in one projection.

    Only the named raw columns are read. A raw column the release does not carry yields NULL.
    """
    present = set(raw.columns)
    out = [
        (strict(F.col(f"`{source}`"), dtype) if source in present else F.lit(None).cast(dtype)).alias(name)
        for source, name, dtype in columns
    ]
    out += [F.expr(expression).alias(name) for name, expression in (derived or {}).items()]
    if release_seq is not None:
        # A plain literal would be INT; the ledger and the history are BIGINT.
        out.append(F.lit(release_seq).cast("bigint").alias("_release_seq"))
    return raw.select(*out)
