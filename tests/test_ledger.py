"""The truth table of the release guards."""

from bags import rows
from tidemark.operators import ledger as L
from tidemark.plans.schema import TERMINAL_TASKS

CANDIDATE = "release_seq bigint, min_season bigint, archive_sha256 string, allow_scope_expansion boolean"
STATE = "release_seq bigint, attempt_id string, status string, min_season bigint, archive_sha256 string"


def release(seq=1, attempt="a", status="RUNNING", scope=2010, digest="hash"):
    return (seq, attempt, status, scope, digest)


def markers(seq=1, attempt="a", tasks=TERMINAL_TASKS):
    return [(seq, attempt, task) for task in tasks]


def violations(spark, previous, done, seq, scope, digest, allow=False):
    found = L.release_order_violations(
        spark.createDataFrame(previous, STATE), spark.createDataFrame(done, L.COMPLETIONS),
        spark.createDataFrame([(seq, scope, digest, allow)], CANDIDATE), TERMINAL_TASKS)
    return sorted(r.violation for r in found.collect())


LEGACY = release(attempt=None, status="PUBLISHED")
OLD_AND_WIDE = [LEGACY, release(seq=2, scope=1950)]

CASES = [
    ("first run", [], [], 1, 2010, "hash", False, []),
    ("same release again", [release()], [], 1, 2010, "hash", False, []),
    ("legacy release again", [LEGACY], [], 1, 2010, "hash", False, []),
    ("next after all markers", [release()], markers(), 2, 2010, "next", False, []),
    ("stale attempt", [release(attempt="b")], markers(), 2, 2010, "hash", False, ["unfinished_earlier"]),
    ("one marker five times", [release()], markers(tasks=TERMINAL_TASKS[:1] * 5), 2, 2010, "h", False,
     ["unfinished_earlier"]),
    ("legacy counts as done", [LEGACY], [], 2, 2010, "hash", False, []),
    ("no attempt and running", [release(attempt=None)], [], 2, 2010, "hash", False, ["unfinished_earlier"]),
    ("rollback", [release(seq=2)], [], 1, 2010, "hash", False, ["rollback"]),
    ("scope change", [release()], [], 1, 2015, "hash", False, ["scope_change"]),
    ("hash change", [release()], [], 1, 2010, "changed", False, ["identity_changed"]),
    ("widening", [release()], markers(), 1, 1950, "hash", True, []),
    ("widening not allowed", [release()], markers(), 1, 1950, "hash", False, ["scope_change"]),
    ("widening unfinished", [release()], [], 1, 1950, "hash", True, ["unfinished_latest"]),
    ("widening with a new release", [release()], markers(), 2, 1950, "next", True, ["scope_change"]),
    ("narrowing", [release()], markers(), 1, 2020, "hash", True, ["scope_change"]),
    ("widening a changed archive", [release()], markers(), 1, 1950, "changed", True, ["identity_changed"]),
    ("old scope before an expansion", OLD_AND_WIDE, [], 2, 1950, "hash", False, []),
    ("next after an expansion", OLD_AND_WIDE, markers(seq=2), 3, 1950, "next", False, []),
    ("narrowing after an expansion", OLD_AND_WIDE, markers(seq=2), 2, 2010, "hash", True, ["scope_change"]),
]


CASES += [(f"missing {task}", [release()], markers(tasks=[t for t in TERMINAL_TASKS if t != task]), 2, 2010, "h", False,
           ["unfinished_earlier"]) for task in TERMINAL_TASKS]


def test_release_order_of_many_ledgers_at_once(spark):
    """Every case is a ledger of its own in the same tables, so one query decides them all."""
    def tagged(pick):
        return [(case[0], *row) for case in CASES for row in pick(case)]

    found = L.release_order_violations(
        spark.createDataFrame(tagged(lambda c: c[1]), f"ledger string, {STATE}"),
        spark.createDataFrame(tagged(lambda c: c[2]), f"ledger string, {L.COMPLETIONS}"),
        spark.createDataFrame(tagged(lambda c: [c[3:7]]), f"ledger string, {CANDIDATE}"),
        TERMINAL_TASKS, ["ledger"])
    by_case = {case[0]: [] for case in CASES}
    for row in found.collect():
        by_case[row.ledger].append(row.violation)
    assert {k: sorted(v) for k, v in by_case.items()} == {case[0]: case[7] for case in CASES}


def test_release_order_of_a_single_ledger(spark):
    assert violations(spark, [release()], markers(), 2, 2010, "next") == []
    assert violations(spark, [release(seq=2)], [], 1, 2015, "hash") == ["rollback", "scope_change"]


def test_run_gate(spark):
    state = spark.createDataFrame(
        [release(1), release(2, attempt=None), release(3, status="COMPLETE"), release(4), release(4)], STATE)
    runs = spark.createDataFrame([(i, 2010) for i in range(1, 6)] + [(1, 1990)], "release_seq bigint, min_season bigint")
    found = L.run_gate_violations(state, runs)
    assert rows(found, "release_seq") == [
        (1, "not_prepared"), (2, "no_attempt"), (3, "not_prepared"), (4, "not_prepared"), (5, "not_prepared")]


def test_simple_guard(spark):
    state = spark.createDataFrame([release(1, status="COMPLETE"), release(2, status="PREPARED")], STATE)
    def check(seq, scope):
        one = spark.createDataFrame([(seq, scope)], "release_seq bigint, min_season bigint")
        return sorted(r.violation for r in L.simple_guard_violations(state, one).collect())
    assert check(2, 2010) == []
    assert check(3, 2010) == ["unfinished_earlier"]
    assert check(1, 2010) == ["rollback"]
    assert check(2, 1950) == ["scope_change"]


def test_upsert_update_and_added_column(spark):
    table = spark.createDataFrame([(1, "DONE", 5), (2, "DONE", 6)], "k int, status string, scope int")
    new = spark.createDataFrame([(2, "RUNNING", 9), (3, "RUNNING", 7)], "k int, status string, scope int")
    assert rows(L.upsert(table, new, ["k"], ["status"]), "k") == [
        (1, "DONE", 5), (2, "RUNNING", 6), (3, "RUNNING", 7)]
    from pyspark.sql import functions as F
    done = L.update_where(table, F.col("k") == 2, {"status": F.lit("COMPLETE")})
    assert rows(done, "k") == [(1, "DONE", 5), (2, "COMPLETE", 6)]
    assert L.add_columns(table, {"attempt_id": "string", "k": "int"}).columns == ["k", "status", "scope", "attempt_id"]


def test_markers_carry_the_running_attempt_and_audit_keeps_the_old_scope(spark):
    state = spark.createDataFrame([release(1, attempt="x", status="COMPLETE"), release(2, attempt="y")], STATE)
    tasks = spark.createDataFrame([(1, "t"), (2, "t")], "release_seq bigint, task_key string")
    assert rows(L.completion_markers(state, tasks)) == [(2, "y", "t")]
    candidate = spark.createDataFrame([(2, 1950, "z")], "release_seq bigint, min_season bigint, attempt_id string")
    assert rows(L.scope_expansions(state, candidate)) == [(2, 2010, 1950, "y", "z")]
