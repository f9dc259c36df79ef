"""Type-2 history over release sequences: intervals ``[valid_from, valid_to)``, open when NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.quality import check_rows, duplicate_keys, failures, predicate_checks, union_rows

START = "valid_from_release"
END = "valid_to_release"


def _same(columns: Sequence[str], left: str, right: str) -> Column:
    same = F.lit(True)
    for name in columns:
        same = same & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return same


def empty_history(snapshot: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    typed = snapshot.select(*keys, *tracked, F.lit(0).cast("bigint").alias(START),
                            F.lit(None).cast("bigint").alias(END))
    return snapshot.sparkSession.createDataFrame([], typed.schema)


def close_versions(history: DataFrame, snapshot: DataFrame, seq: int,
                   keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """First half: end the open version of each changed or removed key."""
    live = history.filter(F.col(END).isNull()).alias("h")
    s = snapshot.select(*keys, *tracked, F.lit(True).alias("_present")).alias("s")
    on = [F.col(f"h.{k}") == F.col(f"s.{k}") for k in keys]
    keeps = F.coalesce(F.col("s._present"), F.lit(False)) & _same(tracked, "h", "s")
    ended = F.when(~keeps, F.lit(seq).cast("bigint"))
    closed_now = live.join(s, on, "left").select(
        *[F.col(f"h.{c}") for c in (*keys, *tracked, START)], ended.alias(END))
    return history.filter(F.col(END).isNotNull()).unionByName(closed_now)


def open_versions(history: DataFrame, snapshot: DataFrame, seq: int,
                  keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Second half: start a version for each key that has no open one."""
    live = history.filter(F.col(END).isNull()).select(*keys)
    opened = snapshot.select(*keys, *tracked).join(live, list(keys), "left_anti").select(
        *keys, *tracked, F.lit(seq).cast("bigint").alias(START), F.lit(None).cast("bigint").alias(END))
    return history.unionByName(opened)


def version_changes(live: DataFrame, snapshot: DataFrame, seq: int,
                    keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Only what a snapshot changes: ended versions (``_kind`` closed) and new ones (opened), from one join."""
    columns = [*keys, *tracked, START, END]
    h = live.select(*keys, *tracked, START, F.lit(True).alias("_live")).alias("h")
    s = snapshot.select(*keys, *tracked, F.lit(True).alias("_present")).alias("s")
    joined = h.join(s, [F.col(f"h.{k}") == F.col(f"s.{k}") for k in keys], "full")
    was, present = F.coalesce(F.col("h._live"), F.lit(False)), F.coalesce(F.col("s._present"), F.lit(False))
    keeps = was & present & _same(tracked, "h", "s")
    now, never = F.lit(seq).cast("bigint"), F.lit(None).cast("bigint")
    ended = F.struct(*[F.col(f"h.{c}").alias(c) for c in (*keys, *tracked, START)], now.alias(END), F.lit("closed").alias("_kind"))
    begun = F.struct(*[F.col(f"s.{c}").alias(c) for c in (*keys, *tracked)], now.alias(START), never.alias(END),
                     F.lit("opened").alias("_kind"))
    rows = F.array(F.when(was & ~keeps, ended), F.when(present & ~keeps, begun))
    return joined.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("v")).select("v.*").select(*columns, "_kind")


def apply_snapshot(history: DataFrame, snapshot: DataFrame, seq: int,
                   keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Both halves in one plan with one join of the open versions and the snapshot.

    Applying a snapshot again changes nothing, also when only the first half had been stored. The
    history is read twice, so that closed versions pass through without a shuffle; publish the
    result before applying the next snapshot to it.
    """
    columns = [*keys, *tracked, START, END]
    h = history.filter(F.col(END).isNull()).select(*columns, F.lit(True).alias("_live")).alias("h")
    s = snapshot.select(*keys, *tracked, F.lit(True).alias("_present")).alias("s")
    joined = h.join(s, [F.col(f"h.{k}") == F.col(f"s.{k}") for k in keys], "full")

    live = F.coalesce(F.col("h._live"), F.lit(False))
    present = F.coalesce(F.col("s._present"), F.lit(False))
    keeps = live & present & _same(tracked, "h", "s")
    now = F.lit(seq).cast("bigint")
    never = F.lit(None).cast("bigint")

    old = F.struct(*[F.col(f"h.{c}").alias(c) for c in (*keys, *tracked, START)],
                   F.when(~keeps, now).alias(END))
    new = F.struct(*[F.col(f"s.{c}").alias(c) for c in (*keys, *tracked)],
                   now.alias(START), never.alias(END))
    rows = F.array(F.when(live, old), F.when(present & ~keeps, new))
    step = joined.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("v")).select("v.*")
    return history.filter(F.col(END).isNotNull()).select(*columns).unionByName(step.select(*columns))


def check_sequence(history: DataFrame, seq: int) -> DataFrame:
    """A snapshot older than the newest one already applied must be refused."""
    newest = F.greatest(F.max(START), F.max(END))
    return history.agg((F.coalesce(newest, F.lit(seq)) > seq).cast("bigint").alias("failures")).select(
        F.lit("no_older_snapshot").alias("check_name"), "failures")


def release_steps(releases: DataFrame) -> DataFrame:
    """``(seq, step, next_seq)`` of the releases; one row per release, so one task is enough."""
    order = Window.orderBy("seq")
    return releases.select("seq").distinct().select(
        "seq", F.row_number().over(order).alias("step"), F.lead("seq").over(order).alias("next_seq"))


def rebuild_history(snapshots: DataFrame, releases: DataFrame,
                    keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """The same history from all snapshots at once.

    ``snapshots`` holds ``seq``, keys and tracked columns; a key has at most one row per release, so
    no window partition exceeds the number of releases. A version starts at a key's first row, after
    a missed release, and where a tracked value differs null-safely from the row before.
    """
    rows = snapshots.select("seq", *keys, *tracked).join(release_steps(releases), "seq")
    order = Window.partitionBy(*keys).orderBy("step")
    before = rows.withColumn("_step0", F.lag("step").over(order)).withColumn(
        "_row0", F.lag(F.struct(*tracked)).over(order))
    starts = (
        F.col("_step0").isNull()
        | (F.col("_step0") != F.col("step") - 1)
        | ~F.col("_row0").eqNullSafe(F.struct(*tracked))
    )
    numbered = before.withColumn("_version", F.sum(starts.cast("int")).over(order))
    return (
        numbered.groupBy(*keys, "_version")
        .agg(*[F.max_by(c, "step").alias(c) for c in tracked],
             F.min("seq").alias(START), F.max_by("next_seq", "step").alias(END))
        .select(*keys, *tracked, START, END)
    )


def check_history(history: DataFrame, keys: Sequence[str], current: DataFrame) -> DataFrame:
    """Unique (key, start), one open version for exactly each current key, positive intervals."""
    live = history.filter(F.col(END).isNull())
    here, there = live.select(*keys), current.select(*keys)
    return union_rows([
        check_rows(history, [*keys, START], [*keys, START]),
        failures("one_open_version", duplicate_keys(live, keys)),
        failures("open_without_current", here.join(there, list(keys), "left_anti")),
        failures("current_without_open", there.join(here, list(keys), "left_anti")),
        predicate_checks(history, {"positive_interval": F.coalesce(F.col(END) > F.col(START), F.lit(True))}),
    ])
