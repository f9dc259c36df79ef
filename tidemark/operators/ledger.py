"""Release and attempt bookkeeping as set queries.

Every guard returns the rows that break it. ``by`` names columns that separate independent
ledgers kept in one table; with none, the table is one ledger.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.entries import NumberedLog

RELEASE_STATE = ("release_seq bigint, release_tag string, archive_sha256 string, min_season bigint, "
                 "status string, published_at timestamp, attempt_id string")
COMPLETIONS = "release_seq bigint, attempt_id string, task_key string"
EXPANSIONS = ("release_seq bigint, previous_min_season bigint, min_season bigint, "
              "previous_attempt_id string, attempt_id string, requested_at timestamp")

# What happens to releases, in the order of ``number``; the tables above are folds of it.
EVENT_FIELDS = ("kind string, release_seq bigint, release_tag string, archive_sha256 string, min_season bigint, "
                "attempt_id string, task_key string, previous_min_season bigint, previous_attempt_id string, at timestamp")
OPENED = "OPENED"      # an attempt at a release begins
FINISHED = "FINISHED"  # a task of an attempt is done
WIDENED = "WIDENED"    # the scope changes with an attempt
CLOSED = "CLOSED"      # the release is published

RUNNING = "RUNNING"
PREPARED = "PREPARED"
COMPLETE = "COMPLETE"
PUBLISHED = "PUBLISHED"  # the status of completed releases that predate attempts


def upsert(table: DataFrame, rows: DataFrame, keys: Sequence[str], update: Sequence[str]) -> DataFrame:
    """Matched keys take only the ``update`` columns of ``rows``; other keys are inserted whole."""
    names = table.columns
    given = [c for c in names if c in rows.columns]
    new = rows.select(*[F.col(c).alias(f"_new_{c}") for c in given], F.lit(True).alias("_given"))
    old = table.withColumn("_stored", F.lit(True))
    on = [F.col(k) == F.col(f"_new_{k}") for k in keys]

    def value(name: str) -> Column:
        offered = F.col(f"_new_{name}") if name in given else F.lit(None)
        matched = offered if name in update else F.col(name)
        return (
            F.when(F.col("_stored").isNull(), offered)
            .when(F.col("_given").isNull(), F.col(name))
            .otherwise(matched).cast(table.schema[name].dataType).alias(name)
        )

    return old.join(new, on, "full").select(*[value(n) for n in names])


def update_where(table: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    changed = F.coalesce(condition, F.lit(False))
    return table.select(*[
        F.when(changed, values[c]).otherwise(F.col(c)).cast(table.schema[c].dataType).alias(c)
        if c in values else F.col(c)
        for c in table.columns
    ])


def add_columns(table: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the columns the table lacks, as NULLs."""
    for name, dtype in columns.items():
        if name not in table.columns:
            table = table.withColumn(name, F.lit(None).cast(dtype))
    return table


def state_of(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The latest state of each release: identity from its first attempt, the rest from its last.

    A release is COMPLETE if it was closed after its last attempt began. One aggregate with map-side combine.
    """
    kind, number = F.col("kind"), F.col("number")
    opened, closed = F.when(kind == OPENED, number), F.when(kind == CLOSED, number)
    folded = events.filter(kind.isin(OPENED, CLOSED)).groupBy(*by, "release_seq").agg(
        F.min_by(F.struct("release_tag", "archive_sha256"), opened).alias("first"),
        F.max_by(F.struct("min_season", "attempt_id"), opened).alias("last"), F.max(opened).alias("opened"),
        F.max_by("at", closed).alias("at"), F.max(closed).alias("closed")).filter("opened IS NOT NULL")
    done = F.coalesce(F.col("closed") > F.col("opened"), F.lit(False))
    return folded.select(
        *by, "release_seq", "first.release_tag", "first.archive_sha256", "last.min_season",
        F.when(done, COMPLETE).otherwise(RUNNING).alias("status"), F.when(done, F.col("at")).alias("published_at"), "last.attempt_id")


def completions_of(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return events.filter(F.col("kind") == FINISHED).select(*by, "release_seq", "attempt_id", "task_key")


def expansions_of(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return events.filter(F.col("kind") == WIDENED).select(
        *by, "release_seq", "previous_min_season", "min_season", "previous_attempt_id", "attempt_id", F.col("at").alias("requested_at"))


class Folded:
    """A view of an event log that reads like a table."""

    def __init__(self, events: NumberedLog, fold: Callable[[DataFrame], DataFrame]):
        self.events, self.fold = events, fold

    def read(self) -> DataFrame:
        return self.fold(self.events.read())


class EventLedger:
    """A stored ledger: every step appends one entry, and nothing is rewritten."""

    def __init__(self, spark: SparkSession, folder: str):
        self.events = NumberedLog(spark, folder, EVENT_FIELDS)
        self.state = Folded(self.events, state_of)
        self.completions = Folded(self.events, completions_of)
        self.expansions = Folded(self.events, expansions_of)

    def last(self) -> int:
        return (self.events.numbers() or [0])[-1]

    def add(self, kind: str, after: int | None = None, **values: object) -> int:
        """Append an event. One that was decided on the state up to ``after`` is refused if others came since."""
        entry = {"kind": kind, **values, "at": dt.datetime.now(dt.timezone.utc).isoformat()}
        if after is None:
            return self.events.append(entry)
        self.events.add(after + 1, entry)
        return after + 1


def completion_counts(completions: DataFrame, required: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Distinct required tasks per attempt; repeated markers count once."""
    return (
        completions.filter(F.col("task_key").isin(list(required)))
        .groupBy(*by, "release_seq", "attempt_id", "task_key").agg(F.lit(1).alias("_one"))
        .groupBy(*by, "release_seq", "attempt_id").agg(F.count(F.lit(1)).alias("tasks_done"))
    )


def completed_releases(state: DataFrame, completions: DataFrame, required: Sequence[str],
                       by: Sequence[str] = ()) -> DataFrame:
    """The ledger rows with ``is_complete``: all markers of the *current* attempt, or legacy."""
    done = completion_counts(completions, required, by)
    joined = state.join(done, [*by, "release_seq", "attempt_id"], "left")
    legacy = F.coalesce(F.col("status") == PUBLISHED, F.lit(False)) & F.col("attempt_id").isNull()
    return joined.withColumn(
        "is_complete", legacy | (F.coalesce("tasks_done", F.lit(0)) == len(required))).drop("tasks_done")


def _violation(*cases: tuple[Column, str]) -> Column:
    """All rules that apply to one row, as an array of names."""
    named = F.array(*[F.when(F.coalesce(condition, F.lit(False)), F.lit(name)) for condition, name in cases])
    return F.filter(named, lambda v: v.isNotNull())


def _renamed(frame: DataFrame, prefix: str, by: Sequence[str]) -> DataFrame:
    return frame.select(*by, *[F.col(c).alias(f"{prefix}{c}") for c in frame.columns if c not in by])


def release_order_violations(state: DataFrame, completions: DataFrame, candidates: DataFrame,
                             required: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Why a candidate release may not run: ``(by, release_seq, violation)``, no rows when it may.

    ``candidates``: by, release_seq, min_season, archive_sha256, allow_scope_expansion, one per ledger.
    Rows of a ledger are folded to one summary before they meet the candidates.
    """
    group = list(by) or ["_ledger"]
    if not by:
        state, completions, candidates = (
            f.withColumn("_ledger", F.lit(1)) for f in (state, completions, candidates))
    checked = completed_releases(state, completions, required, group)
    tagged = candidates.select(*group, F.col("release_seq").alias("c_seq"), F.col("min_season").alias("c_scope"),
                               F.col("archive_sha256").alias("c_hash"),
                               F.col("allow_scope_expansion").alias("c_allow"))
    facts = checked.join(tagged, group)
    earlier, same = F.col("release_seq") < F.col("c_seq"), F.col("release_seq") == F.col("c_seq")
    latest = F.struct("min_season", "release_seq", "is_complete")
    summary = facts.groupBy(*group, "c_seq", "c_scope", "c_hash", "c_allow").agg(
        F.max_by(latest, "release_seq").alias("latest"),
        F.max((F.col("release_seq") > F.col("c_seq")).cast("int")).alias("newer"),
        F.max((same & ~F.col("archive_sha256").eqNullSafe(F.col("c_hash"))).cast("int")).alias("rehashed"),
        F.max((earlier & ~F.col("is_complete")).cast("int")).alias("unfinished"),
    )
    rescoped = F.col("latest.min_season") != F.col("c_scope")
    widening = (F.coalesce(F.col("c_allow"), F.lit(False))
                & (F.col("c_scope") < F.col("latest.min_season"))
                & (F.col("c_seq") == F.col("latest.release_seq")))
    rules = _violation(
        (rescoped & ~widening, "scope_change"),
        (rescoped & widening & ~F.col("latest.is_complete"), "unfinished_latest"),
        (F.col("newer") == 1, "rollback"),
        (F.col("rehashed") == 1, "identity_changed"),
        (F.col("unfinished") == 1, "unfinished_earlier"),
    )
    return summary.select(*by, F.col("c_seq").alias("release_seq"), F.explode(rules).alias("violation"))


def scope_expansions(state: DataFrame, candidates: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Audit rows of candidates that change the scope of the latest release."""
    group = list(by) or ["_ledger"]
    if not by:
        state, candidates = (f.withColumn("_ledger", F.lit(1)) for f in (state, candidates))
    latest = state.groupBy(*group).agg(
        F.max_by(F.struct("min_season", "attempt_id"), "release_seq").alias("latest"))
    return (
        candidates.join(latest, group)
        .filter(F.col("latest.min_season") != F.col("min_season"))
        .select(*by, "release_seq", F.col("latest.min_season").alias("previous_min_season"), "min_season",
                F.col("latest.attempt_id").alias("previous_attempt_id"), "attempt_id")
    )


def run_gate_violations(state: DataFrame, runs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Runs that may not write: not exactly one RUNNING row of the same scope with an attempt."""
    keys = [*by, "release_seq"]
    rows = state.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("status").alias("s_status"), F.max("status").alias("s_status2"),
        F.min("min_season").alias("s_scope"), F.max("min_season").alias("s_scope2"),
        F.count("attempt_id").alias("n_attempts"))
    joined = runs.join(rows, keys, "left")
    scope = F.col("min_season")
    running = (F.col("s_status") == RUNNING) & (F.col("s_status2") == RUNNING)
    same_scope = F.col("s_scope").eqNullSafe(scope) & F.col("s_scope2").eqNullSafe(scope)
    prepared = F.coalesce((F.col("n") == 1) & running & same_scope, F.lit(False))
    rules = _violation(
        (~prepared, "not_prepared"),
        (prepared & (F.col("n_attempts") == 0), "no_attempt"),
    )
    return joined.select(*keys, F.explode(rules).alias("violation"))


def completion_markers(state: DataFrame, tasks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Markers to append for finished ``tasks``, stamped with the attempt that is running."""
    running = state.filter(F.col("status") == RUNNING).select(*by, "release_seq", "attempt_id")
    return tasks.join(running, [*by, "release_seq"]).select(*by, "release_seq", "attempt_id", "task_key")


def simple_guard_violations(state: DataFrame, candidates: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The lighter guard: no older replay, earlier releases COMPLETE, one scope throughout."""
    group = list(by) or ["_ledger"]
    if not by:
        state, candidates = (f.withColumn("_ledger", F.lit(1)) for f in (state, candidates))
    tagged = candidates.select(*group, F.col("release_seq").alias("c_seq"), F.col("min_season").alias("c_scope"))
    unfinished = (F.col("release_seq") < F.col("c_seq")) & ~F.col("status").eqNullSafe(COMPLETE)
    summary = state.join(tagged, group).groupBy(*group, "c_seq").agg(
        F.max((F.col("release_seq") > F.col("c_seq")).cast("int")).alias("newer"),
        F.max(unfinished.cast("int")).alias("unfinished"),
        F.max((~F.col("min_season").eqNullSafe(F.col("c_scope"))).cast("int")).alias("rescoped"),
    )
    rules = _violation(
        (F.col("newer") == 1, "rollback"),
        (F.col("unfinished") == 1, "unfinished_earlier"),
        (F.col("rescoped") == 1, "scope_change"),
    )
    return summary.select(*by, F.col("c_seq").alias("release_seq"), F.explode(rules).alias("violation"))
