"""Full-snapshot reconciliation: insert, update and delete-missing on a key."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.measures import count_where
from tidemark.operators.entries import NumberedLog, remove
from tidemark.operators.quality import failing, stop_on, unmet

CHANGES = ("insert", "update", "unchanged", "delete")

#: Conditions that every row must meet, by name; and a report on the rows as written.
Expectations = Mapping[str, Column | str]
Check = Callable[[DataFrame], DataFrame]


def _compared(columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in keys and c != "_release_seq"]


def classify_changes(current: DataFrame, snapshot: DataFrame, keys: Sequence[str], old: Sequence[str] = ()) -> DataFrame:
    """Every row of either side with ``_change``; a deleted row keeps its current values.

    Columns named in ``old`` come with their current values too, as ``_old_<name>``.

    One full outer join on the unique key. Values compare null-safely, so NULL to value is an update.
    """
    names = snapshot.columns
    known = [c if c in current.columns else None for c in names]
    before = current.select(
        *[(F.col(c) if c else F.lit(None).cast(snapshot.schema[n].dataType)).alias(f"_old_{n}")
          for c, n in zip(known, names)],
        F.lit(True).alias("_in_current"))
    new = snapshot.withColumn("_in_snapshot", F.lit(True))
    on = F.lit(True)
    for key in keys:
        on = on & (F.col(key) == F.col(f"_old_{key}"))
    same = F.lit(True)
    for name in _compared(names, keys):
        same = same & F.col(name).eqNullSafe(F.col(f"_old_{name}"))
    change = (
        F.when(F.col("_in_current").isNull(), "insert")
        .when(F.col("_in_snapshot").isNull(), "delete")
        .when(same, "unchanged")
        .otherwise("update")
    )
    values = [F.when(F.col("_in_snapshot").isNull(), F.col(f"_old_{n}")).otherwise(F.col(n)).alias(n) for n in names]
    return new.join(before, on, "full").select(*values, change.alias("_change"), *[f"_old_{n}" for n in old])


def next_state(changes: DataFrame) -> DataFrame:
    return changes.filter("_change <> 'delete'").drop("_change")


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy(F.col("_change").alias("change")).agg(F.count(F.lit(1)).alias("n"))


def overwrite_current(table: VersionedTable, snapshot: DataFrame, version: int) -> DataFrame:
    """The merge-free form: a complete snapshot replaces the current table; readers see the new state."""
    table.publish(snapshot, version)
    return table.read()


def empty_like(frame: DataFrame) -> DataFrame:
    """A table with the frame's columns and no rows. The source is not scanned, and what is joined to it is not shuffled."""
    return frame.limit(0)


class VersionedTable:
    """A table kept as one parquet folder per published version.

    A version is written once, checked as written, and then recorded as the next entry of a log, so readers see the old
    or the new state and never a mixture. Row checks are counted during the write; other checks read the written files.
    A version that fails is removed and leaves no trace in the log. Of two writers that started from one version the
    second is refused.
    """

    LOG = ("release_seq bigint, path string, row_count bigint, published_at timestamp, note string, "
           "changes map<string, bigint>")

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = NumberedLog(spark, f"{self.root}/log", self.LOG)

    def exists(self) -> bool:
        return bool(self.log.numbers())

    def create(self, schema: StructType | str) -> None:
        """Publish an empty first version with a declared schema."""
        if not self.exists():
            self.publish(self.spark.createDataFrame([], schema), release_seq=None)

    def read(self) -> DataFrame:
        latest = self.log.last()
        if latest is None:
            raise FileNotFoundError(f"nothing published under {self.root}")
        return self.spark.read.parquet(latest.path)

    def versions(self) -> DataFrame:
        return self.log.read().withColumnRenamed("number", "version")

    def publish(self, frame: DataFrame, release_seq: int | None, expectations: Expectations | None = None,
                check: Check | None = None) -> int:
        """Write ``frame`` as the next version (schema and all) and switch to it; returns its rows."""
        return self._publish(frame, release_seq, self.log.last(), expectations, check)["rows"]

    def _publish(self, frame: DataFrame, release_seq: int | None, latest: SimpleNamespace | None,
                 expectations: Expectations | None = None, check: Check | None = None, note: str | None = None,
                 seen: Observation | None = None, forbidden: Sequence[str] = ()) -> dict[str, int]:
        """``seen`` holds changes counted in the plan of ``frame``; those in ``forbidden`` must be none."""
        version = (latest.number if latest else 0) + 1
        path = f"{self.root}/data/{version:08d}-{uuid.uuid4().hex}"
        written = Observation("written")
        broken = [count_where(unmet(condition)).alias(f"!{name}") for name, condition in (expectations or {}).items()]
        try:
            frame.observe(written, F.count(F.lit(1)).alias("rows"), *broken).write.parquet(path)
            counts, changes = written.get, dict(seen.get) if seen else {}
            failed = {name: counts[f"!{name}"] for name in expectations or {}} | {c: changes.pop(c) for c in forbidden}
            if check:
                failed |= failing(check(self.spark.read.parquet(path)))
            stop_on(failed, f"{self.root} version {version}")
            self.log.add(version, {
                "release_seq": release_seq, "path": path, "row_count": counts["rows"], "note": note, "changes": changes,
                "published_at": dt.datetime.now(dt.timezone.utc).isoformat()})
        except Exception:
            remove(self.spark, path)
            raise
        return {"rows": counts["rows"], **changes}

    def _current(self, latest: SimpleNamespace | None, like: DataFrame) -> DataFrame:
        return self.spark.read.parquet(latest.path) if latest else empty_like(like)

    def merge(self, snapshot: DataFrame, keys: Sequence[str], release_seq: int, expectations: Expectations | None = None,
              check: Check | None = None) -> dict[str, int]:
        """Reconcile with a complete snapshot; counts changes during the write itself."""
        latest, seen = self.log.last(), Observation("changes")
        counted = classify_changes(self._current(latest, snapshot), snapshot, keys).observe(
            seen, *[count_where(F.col("_change") == c).alias(c) for c in CHANGES])
        told = self._publish(next_state(counted), release_seq, latest, expectations, check, seen=seen)
        return {c: told[c] for c in CHANGES}

    def _noted(self, note: str) -> bool:
        return not self.log.read().filter(F.col("note") == note).isEmpty()

    def merge_part(self, rows: DataFrame, keys: Sequence[str], release_seq: int, note: str,
                   expectations: Expectations | None = None, check: Check | None = None) -> bool:
        """Reconcile with a part of a snapshot: its keys are inserted or updated, other rows wait for ``merge_end``.

        A part is known by its ``note`` and merged once: False if it was before. A key that an earlier part of the same
        release has brought is a failure.
        """
        if self._noted(note):
            return False
        latest, seen = self.log.last(), Observation("changes")
        kind = F.col("_change")
        again = F.col("_old__release_seq").eqNullSafe(F.lit(release_seq))
        named = F.when(kind == "delete", "kept").when(again, "repeated_key").otherwise(kind)
        kinds = ("insert", "update", "unchanged", "repeated_key")
        counted = classify_changes(self._current(latest, rows), rows, keys, ["_release_seq"]).withColumn("_change", named).observe(
            seen, *[count_where(kind == c).alias(c) for c in kinds])
        self._publish(counted.drop("_change", "_old__release_seq"), release_seq, latest, expectations, check, note, seen,
                      forbidden=["repeated_key"])
        return True

    def merge_end(self, release_seq: int) -> bool:
        """After the last part of a snapshot: rows that it did not bring are deleted. Nothing is written if there are none,
        so it may be repeated."""
        latest, seen = self.log.last(), Observation("changes")
        gone = ~F.col("_release_seq").eqNullSafe(F.lit(release_seq))
        if latest is None or self.read().filter(gone).isEmpty():
            return False
        counted = self.read().withColumn("_gone", gone).observe(seen, count_where(F.col("_gone")).alias("delete"))
        self._publish(counted.filter(~F.col("_gone")).drop("_gone"), release_seq, latest, seen=seen)
        return True

    def changes_of(self, release_seq: int) -> DataFrame:
        """``(change, n)`` over all versions of a release."""
        told = self.log.read().filter(F.col("release_seq") == release_seq)
        return told.select(F.explode("changes").alias("change", "n")).groupBy("change").agg(F.sum("n").alias("n"))
