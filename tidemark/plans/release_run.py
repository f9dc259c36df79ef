"""One release from landed files to published tables, as plain calls in dependency order.

Every stage reads what the stage before has stored and computes its result once: it is written, checked as
written, and only then published. A run that fails anywhere leaves the published tables as they were and can
simply be started again.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.releases import check_scope
from tidemark.operators import history as H
from tidemark.operators import ledger as L
from tidemark.operators import quality
from tidemark.operators.history_store import HistoryStore
from tidemark.operators.snapshot import VersionedTable
from tidemark.plans import gold, silver
from tidemark.plans.schema import (
    DATASETS, GOLD_KEYS, HISTORY_KEYS, HISTORY_TRACKED, TERMINAL_TASKS,
)
from tidemark.plans.verification import open_history_matches, published_check
from tidemark.session import stored
from tidemark.sources import manifest as M
from tidemark.sources.tables import literal_rows
from tidemark.streaming.ingest import RawStore

# A dataset after those it refers to.
SILVER_ORDER = ("drivers", "constructors", "circuits", "races", "race_results", "sprint_results",
                "driver_standings", "constructor_standings")
HISTORY = "drivers_history"
HISTORY_TASK = f"silver_{HISTORY}"


class ReleaseRun:
    """The stored tables of one warehouse folder and the steps that advance them."""

    def __init__(self, spark: SparkSession, landing: str, root: str):
        self.spark = spark
        self.landing = landing
        self.root = root.rstrip("/")
        self.raw = RawStore(spark, landing, f"{self.root}/bronze")
        self.ledger = L.EventLedger(spark, f"{self.root}/ops/events")
        self.state, self.completions, self.expansions = self.ledger.state, self.ledger.completions, self.ledger.expansions
        self.manifests = self.table("ops", "manifests")
        self.history = HistoryStore(spark, f"{self.root}/silver/{HISTORY}", HISTORY_KEYS, HISTORY_TRACKED)

    def table(self, layer: str, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{layer}/{name}")

    def silver(self, name: str) -> DataFrame:
        return self.history.read() if name == HISTORY else self.table("silver", name).read()

    def gold(self, name: str) -> DataFrame:
        return self.table("gold", name).read()

    # --- ledger ---------------------------------------------------------------------------------

    def prepare(self, tag: str, min_season: int, archive_sha256: str, allow_scope_expansion: bool = False) -> str:
        """Check the order of releases, then open a new attempt; returns its id."""
        seq = check_scope(tag, min_season)
        attempt = str(uuid.uuid4())
        candidate = literal_rows(
            self.spark, [(seq, tag, archive_sha256, min_season, L.RUNNING, attempt, allow_scope_expansion)],
            "release_seq bigint, release_tag string, archive_sha256 string, min_season bigint, status string, "
            "attempt_id string, allow_scope_expansion boolean")
        # Everything below is decided on the ledger up to here; a run that writes in between makes it fail.
        after = self.ledger.last()
        state = self.state.read()
        found = L.release_order_violations(state, self.completions.read(), candidate, TERMINAL_TASKS)
        names = [row.violation for row in found.collect()]  # at most one row per rule
        if names:
            raise quality.CheckFailed(f"{tag}: {', '.join(sorted(names))}")
        widened = L.scope_expansions(state, candidate).collect()  # at most one row
        # A new attempt reopens the release: the fold takes status, scope and attempt from it.
        self.ledger.add(L.OPENED, after, release_seq=seq, release_tag=tag, archive_sha256=archive_sha256,
                        min_season=min_season, attempt_id=attempt)
        for row in widened:
            self.ledger.add(L.WIDENED, **row.asDict())
        return attempt

    def require_running(self, seq: int, min_season: int) -> None:
        run = literal_rows(self.spark, [(seq, min_season)], "release_seq bigint, min_season bigint")
        names = [row.violation for row in L.run_gate_violations(self.state.read(), run).collect()]
        if names:
            raise quality.CheckFailed(f"release {seq}: {', '.join(names)}")

    def mark(self, seq: int, min_season: int, task: str) -> None:
        self.require_running(seq, min_season)
        done = literal_rows(self.spark, [(seq, task)], "release_seq bigint, task_key string")
        for row in L.completion_markers(self.state.read(), done).collect():  # one row: the running attempt
            self.ledger.add(L.FINISHED, **row.asDict())

    # --- stages ---------------------------------------------------------------------------------

    def land_manifest(self, tag: str, seq: int) -> Mapping[str, int]:
        """Check the landed files, or check them against the manifest a former attempt stored."""
        # Written once: the files are hashed once, whatever is asked of the manifest.
        current = stored(M.build_manifest(self.spark, self.landing, {name: [tag] for name in DATASETS}), "manifest")
        known = self.manifests.read() if self.manifests.exists() else None
        kept = known.filter(F.col("release_tag") == tag) if known is not None else None
        if kept is not None and not kept.isEmpty():
            self._stop_on(M.verify_manifest(current, kept), f"{tag}: landed files changed")
            return self._row_counts(kept)
        self._stop_on(M.manifest_violations(current, DATASETS), f"{tag}: landed files")
        self.manifests.publish(current if known is None else known.unionByName(current), seq)
        return self._row_counts(current)

    @staticmethod
    def _row_counts(manifest: DataFrame) -> dict[str, int]:
        # One row per dataset.
        return {row.dataset: row.row_count for row in M.expected_rows(manifest).collect()}

    @staticmethod
    def _stop_on(violations: DataFrame, subject: str) -> None:
        # One row per rule and dataset, however many files break it.
        rows = violations.groupBy("dataset", "violation").count().collect()
        if rows:
            raise quality.CheckFailed(f"{subject}: " + ", ".join(f"{r.dataset} {r.violation}" for r in rows))

    def build_silver(self, name: str, tag: str, seq: int, min_season: int, expected: int) -> dict[str, int]:
        """Gate, clean, check and merge one dataset; returns its change counts."""
        raw = self.raw.table(name, [tag])
        quality.raise_if_failed(silver.input_checks(name, raw, tag, expected), f"raw {name}")
        cleaned = silver.clean(name, raw, tag, min_season)
        parents = {parent: self.silver(parent) for parent, _ in DATASETS[name].references}
        return self.table("silver", name).merge(
            cleaned, DATASETS[name].keys, seq, silver.expectations(name, tag),
            lambda written: silver.table_checks(name, written, tag, parents))

    def build_history(self, seq: int, min_season: int) -> None:
        drivers = self.silver("drivers")
        quality.raise_if_failed(quality.check_current(drivers, seq), "silver drivers")
        self.history.apply(drivers, seq, lambda written: H.check_history(written, list(HISTORY_KEYS), drivers))
        self.mark(seq, min_season, HISTORY_TASK)

    def build_gold(self, seq: int, min_season: int) -> None:
        tables = {name: self.silver(name) for name in DATASETS}
        for name, frame in tables.items():
            quality.raise_if_failed(quality.check_current(frame, seq), f"silver {name}")
        entries = tables["constructor_standings"].select(*GOLD_KEYS["constructor_season"]).distinct()
        driving = {
            "race_dimension": [tables["races"]],
            "session_results": [tables["race_results"], tables["sprint_results"]],
            "driver_season": [tables["driver_standings"]],
            "constructor_season": [entries],
        }

        def keep(name: str, frame: DataFrame) -> DataFrame:
            table = self.table("gold", name)
            table.publish(frame, seq, quality.required(gold.GOLD_REQUIRED[name]),
                          lambda written: gold.table_checks(name, written, *driving[name]))
            self.mark(seq, min_season, f"gold_{name}")
            return table.read()

        gold.build_gold(tables, seq, keep)

    def complete(self, seq: int) -> None:
        """The publish gate; only then is the release COMPLETE."""
        columns = [*HISTORY_KEYS, *HISTORY_TRACKED]
        report = published_check({name: self.gold(name) for name in GOLD_KEYS}, seq,
                                 self.silver("drivers_history"), self.silver("drivers"), columns)
        quality.raise_if_failed(report, f"release {seq}")
        attempt = self.state.read().filter(F.col("release_seq") == seq).first()["attempt_id"]
        self.ledger.add(L.CLOSED, release_seq=seq, attempt_id=attempt)

    def run(self, tag: str, min_season: int, archive_sha256: str,
            allow_scope_expansion: bool = False) -> dict[str, dict[str, int]]:
        """All stages of one release; returns the change counts of the current tables."""
        seq = check_scope(tag, min_season)
        self.prepare(tag, min_season, archive_sha256, allow_scope_expansion)
        expected = self.land_manifest(tag, seq)
        self.raw.ingest(DATASETS, [tag])
        changes = {name: self.build_silver(name, tag, seq, min_season, expected[name]) for name in SILVER_ORDER}
        self.build_history(seq, min_season)
        self.build_gold(seq, min_season)
        self.complete(seq)
        return changes

    def open_history_differences(self) -> DataFrame:
        return open_history_matches(self.silver("drivers_history"), self.silver("drivers"),
                                    [*HISTORY_KEYS, *HISTORY_TRACKED])
