"""Stored tables, histories and ledgers: whole versions, one computation, two writers, crashes, and writes that follow changes."""

import pytest
from bags import rows
from pyspark.sql import functions as F

from tidemark.operators import history as H
from tidemark.operators import ledger as L
from tidemark.operators import quality
from tidemark.operators.entries import ConcurrentWrite, NumberedLog
from tidemark.operators.history_store import HistoryStore
from tidemark.operators.snapshot import VersionedTable, classify_changes, empty_like
from tidemark.session import scratch
from tidemark.sources import csv_release as csv
from tidemark.sources.csv_release import names_in
from tidemark.streaming.merge import SnapshotStream
from test_release_run import R1, R2, land, release_files

SCHEMA = "k string, v string, _release_seq bigint"


def test_entries_are_whole_and_never_written_twice(spark):
    log = NumberedLog(spark, scratch(spark, "log"), "word string, parts map<string, bigint>")
    assert log.last() is None and log.read().count() == 0
    log.add(1, {"word": "a\n\"b", "parts": {"x": 1}})
    log.add(2, {"word": None, "parts": {}})
    with pytest.raises(ConcurrentWrite):
        log.add(2, {"word": "late"})
    assert log.append({"word": "c"}) == 3 and log.last().word == "c" and log.get(1).parts == {"x": 1}
    assert rows(log.read().select("number", "word")) == [(1, "a\n\"b"), (2, None), (3, "c")]
    assert all(not n.startswith("_") for n in names_in(spark, log.folder))


def test_of_two_writers_the_second_is_refused(spark):
    root = scratch(spark, "two")
    one, two = VersionedTable(spark, root), VersionedTable(spark, root)
    one.publish(spark.createDataFrame([("a", "1", 1)], SCHEMA), 1)
    second = spark.createDataFrame([("b", "2", 2)], SCHEMA)

    def meanwhile(written):
        if one.log.numbers() == [1]:
            one.publish(spark.createDataFrame([("a", "9", 2)], SCHEMA), 2)
        return quality.unique_check(written, ["k"])

    with pytest.raises(ConcurrentWrite):
        two.merge(second, ["k"], 2, check=meanwhile)
    assert rows(two.read()) == [("a", "9", 2)] and len(names_in(spark, f"{root}/data")) == 2


def test_a_version_is_computed_once_and_checked_as_written(spark):
    table = VersionedTable(spark, scratch(spark, "once"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    frame = spark.createDataFrame([("a", "1", 1), ("b", None, 1), ("b", "2", 1)], SCHEMA).repartition(2).mapInArrow(count, SCHEMA)
    with pytest.raises(quality.CheckFailed, match="null:v=1.*unique:k=1"):
        table.publish(frame, 1, quality.required(["k", "v"]), lambda written: quality.unique_check(written, ["k"]))
    assert seen.value == 3 and not table.exists() and names_in(spark, f"{table.root}/data") == []
    assert table.publish(frame, 1) == 3 and seen.value == 6


def history_bag(store):
    return rows(store.read().select("k", "v", H.START, H.END))


def test_history_writes_follow_the_changes(spark):
    store = HistoryStore(spark, scratch(spark, "history"), ["k"], ["v"], buckets=16)
    base = [(f"k{i}", str(i % 7)) for i in range(200)]
    plain = H.empty_history(spark.createDataFrame(base, "k string, v string"), ["k"], ["v"])
    later = [(k, "new" if k == "k3" else v) for k, v in base if k != "k5"] + [("extra", None)]
    for seq, data in ((1, base), (2, later), (3, later), (4, base)):
        snapshot = spark.createDataFrame(data, "k string, v string")
        before = names_in(spark, f"{store.root}/data")
        counts = store.apply(snapshot, seq, lambda whole: H.check_history(whole, ["k"], snapshot))
        plain = spark.createDataFrame(H.apply_snapshot(plain, snapshot, seq, ["k"], ["v"]).collect(), plain.schema)
        assert history_bag(store) == rows(plain.select("k", "v", H.START, H.END))
        if seq == 2:
            assert counts == {"closed": 2, "opened": 2, "buckets": counts["buckets"]} and counts["buckets"] <= 3
        if seq == 3:
            assert counts == {"closed": 0, "opened": 0, "buckets": 0} and names_in(spark, f"{store.root}/data") == before
    assert store.apply(spark.createDataFrame(base, "k string, v string"), 4)["buckets"] == 0
    with pytest.raises(quality.CheckFailed, match="no_older_snapshot"):
        store.apply(spark.createDataFrame(base, "k string, v string"), 2)
    assert rows(store.writes().select("release_seq", "rows_closed", "rows_opened")) == [(1, 0, 200), (2, 2, 2), (4, 2, 2)]


def test_history_survives_a_crash_before_the_switch(spark):
    store = HistoryStore(spark, scratch(spark, "crash"), ["k"], ["v"], buckets=4)
    first, second = (spark.createDataFrame(d, "k string, v string") for d in ([("a", "1"), ("b", "1")], [("a", "2")]))
    store.apply(first, 1)

    def crash(whole):
        assert whole.count() == 3
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        store.apply(second, 2, crash)
    assert history_bag(store) == [("a", "1", 1, None), ("b", "1", 1, None)]
    store.apply(second, 2)
    assert history_bag(store) == [("a", "1", 1, 2), ("a", "2", 2, None), ("b", "1", 1, 2)]
    store.apply(second.filter("false"), 3)
    assert store.read().filter(F.col(H.END).isNull()).count() == 0


def test_ledger_is_a_fold_of_events(spark):
    ledger = L.EventLedger(spark, scratch(spark, "events"))
    assert ledger.state.read().count() == ledger.completions.read().count() == 0
    ledger.add(L.OPENED, 0, release_seq=1, release_tag="v1", archive_sha256="h", min_season=2000, attempt_id="a")
    ledger.add(L.FINISHED, release_seq=1, attempt_id="a", task_key="t")
    with pytest.raises(ConcurrentWrite):  # decided on a state that is no longer the last
        ledger.add(L.OPENED, 1, release_seq=2, attempt_id="x")
    state = ["release_seq", "release_tag", "archive_sha256", "min_season", "status", "attempt_id"]
    ledger.add(L.CLOSED, release_seq=1, attempt_id="a")
    assert rows(ledger.state.read().select(*state)) == [(1, "v1", "h", 2000, "COMPLETE", "a")]
    assert ledger.state.read().filter("published_at IS NOT NULL").count() == 1
    ledger.add(L.OPENED, release_seq=1, release_tag="other", archive_sha256="other", min_season=1990, attempt_id="b")
    ledger.add(L.WIDENED, release_seq=1, previous_min_season=2000, min_season=1990, previous_attempt_id="a", attempt_id="b")
    assert rows(ledger.state.read().select(*state)) == [(1, "v1", "h", 1990, "RUNNING", "b")]
    assert ledger.state.read().filter("published_at IS NOT NULL").count() == 0
    assert rows(ledger.completions.read()) == [(1, "a", "t")] and ledger.expansions.read().count() == 1
    assert ledger.last() == 5 and len(names_in(spark, ledger.events.folder)) >= 5


def test_a_replayed_batch_is_merged_once(spark):
    landing = scratch(spark, "batches")
    land(landing, R1, release_files())
    land(landing, R2, release_files(second=True))
    stream = SnapshotStream(spark, landing, scratch(spark, "streamed"), "drivers", 2000)
    assert dict(rows(stream.run(R1))) == {"insert": 3, "update": 0, "unchanged": 0}
    again = spark.read.options(header=True, multiLine=True, escape='"').csv(f"{landing}/drivers/release_tag={R1}").withColumn("release_tag", F.lit(R1))
    versions = stream.table.log.numbers()
    assert stream.merge_batch(R1, again, 0) is False and stream.table.log.numbers() == versions
    with pytest.raises(quality.CheckFailed, match="repeated_key=3"):  # the same rows as another batch
        stream.merge_batch(R1, again, 1)
    assert dict(rows(stream.run(R2))) == {"insert": 1, "update": 1, "unchanged": 2}
    assert dict(rows(stream.run(R2))) == {"insert": 1, "update": 1, "unchanged": 2}


def test_the_end_of_a_release_deletes_what_it_lacks(spark):
    table = VersionedTable(spark, scratch(spark, "end"))
    old = spark.createDataFrame([("a", "1", 1), ("b", "1", 1), ("c", "1", 1)], SCHEMA)
    assert table.merge_part(old, ["k"], 1, "r1#0") and not table.merge_end(1)
    assert table.merge_part(spark.createDataFrame([("a", "1", 2)], SCHEMA), ["k"], 2, "r2#0")
    assert table.merge_part(spark.createDataFrame([("b", "2", 2), ("d", None, 2)], SCHEMA), ["k"], 2, "r2#1")
    assert table.read().count() == 4 and table.merge_end(2) and not table.merge_end(2)
    assert rows(table.read()) == [("a", "1", 2), ("b", "2", 2), ("d", None, 2)]
    assert dict(rows(table.changes_of(2))) == {"insert": 1, "update": 1, "unchanged": 1, "delete": 1}


def test_a_first_release_is_merged_without_a_shuffle(spark):
    new = spark.range(1_000).select("id", F.lit("x").alias("v"))
    changes = classify_changes(empty_like(new), new, ["id"])
    assert {r["_change"]: r["n"] for r in changes.groupBy("_change").agg(F.count("*").alias("n")).collect()} == {"insert": 1_000}
    plan = changes._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan, plan


def test_releases_land_in_one_pass_and_none_is_missing(spark):
    landing = scratch(spark, "landing")
    both = spark.createDataFrame([("1", "a", "v2010.1.0"), ("2", 'b "c", d', "v2010.1.0")], "id string, name string, release_tag string")
    csv.write_releases(both, landing, "things", ["v2010.1.0", "v2010.2.0"])
    assert csv.landed_releases(spark, landing, "things") == ["v2010.1.0", "v2010.2.0"]
    first, second = (csv.read_snapshot(spark, landing, "things", tag) for tag in ("v2010.1.0", "v2010.2.0"))
    assert rows(first.select("id", "name")) == rows(both.select("id", "name"))
    assert second.columns == first.columns and second.isEmpty()
