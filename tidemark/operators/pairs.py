"""Unordered pairs of group members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stored

CHUNK_ROWS = 10_000


def member_pairs(frame: DataFrame, keys: Sequence[str], member: str, values: Sequence[str],
                 chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Join each group with itself on ``a.member < b.member``.

    Output: keys, ``member_a``, ``member_b``, each value with suffix ``_a`` and ``_b``, and
    ``weight``, the number of row pairs the output row stands for.

    Equal rows are folded into one with a count first, so copies add no work. A group with more
    than ``chunk_rows`` distinct rows is cut into a grid: a left row belongs to one grid row and a
    right row to one grid column, and each cell is joined on its own, so no task ever meets more than
    about ``chunk_rows`` rows of either side. Every pair falls into exactly one cell.
    """
    columns = [*keys, member, *values]
    # Read three times below: for the group sizes and for each side.
    folded = stored(frame.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")), "pair-members")
    large = (
        folded.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
        .filter(F.col("_size") > chunk_rows)
        .select(*keys, F.ceil(F.col("_size") / chunk_rows).cast("int").alias("_chunks"))
    )
    sized = folded.join(large, list(keys), "left").withColumn("_chunks", F.coalesce("_chunks", F.lit(1)))

    def side(suffix: str) -> list:
        return [F.col(member).alias(f"member_{suffix}"), F.col("_n").alias(f"_n_{suffix}"),
                *[F.col(v).alias(f"{v}_{suffix}") for v in values]]

    own = F.pmod(F.xxhash64(member, *values), F.col("_chunks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))
    left = sized.select(*keys, own.alias("_row"), every.alias("_column"), *side("a"))
    right = sized.select(*keys, own.alias("_column"), every.alias("_row"), *side("b"))
    return (
        left.join(right, [*keys, "_row", "_column"])
        .filter(F.col("member_a") < F.col("member_b"))
        .withColumn("weight", F.col("_n_a") * F.col("_n_b"))
        .drop("_n_a", "_n_b", "_row", "_column")
    )
