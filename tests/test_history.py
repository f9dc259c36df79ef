"""Type-2 history: null changes, removal, return, retries, a crash, and the batch rebuild."""

import random

import pytest

from bags import rows
from tidemark.operators import history as H
from tidemark.operators.parity import bag_diff
from tidemark.operators.quality import CheckFailed, raise_if_failed

SCHEMA = "driver_id string, driver_name string, full_name string, nationality_country_id string, date_of_birth string"
KEYS, TRACKED = ["driver_id"], ["driver_name", "full_name", "nationality_country_id", "date_of_birth"]
BEFORE = ("a", "A", "Alpha", None, "2000-01-01")
AFTER = ("a", "A", "Alpha", "xx", "2000-01-01")


def snap(spark, *people):
    return spark.createDataFrame(list(people), SCHEMA)


def step(history, snapshot, seq):
    """One stored step, as in a release run: plans do not pile up."""
    advanced = H.apply_snapshot(history, snapshot, seq, KEYS, TRACKED)
    return advanced.sparkSession.createDataFrame(advanced.collect(), advanced.schema)


def intervals(history):
    return rows(history.select("driver_id", H.START, H.END), "driver_id", H.START)


def test_null_change_removal_return_and_retries(spark):
    history = H.empty_history(snap(spark, BEFORE), KEYS, TRACKED)
    history = step(step(history, snap(spark, BEFORE), 1), snap(spark, BEFORE), 1)
    assert intervals(history) == [("a", 1, None)]
    half = H.close_versions(history, snap(spark, AFTER), 2, KEYS, TRACKED)
    assert intervals(half) == [("a", 1, 2)]
    history = step(step(half, snap(spark, AFTER), 2), snap(spark, AFTER), 2)
    assert intervals(history) == [("a", 1, 2), ("a", 2, None)]
    history = step(history, snap(spark), 3)
    assert intervals(history) == [("a", 1, 2), ("a", 2, 3)]
    history = step(step(history, snap(spark, BEFORE), 4), snap(spark, BEFORE), 4)
    assert intervals(history) == [("a", 1, 2), ("a", 2, 3), ("a", 4, None)]
    raise_if_failed(H.check_history(history, KEYS, snap(spark, BEFORE)), "history")


def test_two_halves_equal_one_step(spark):
    history = step(H.empty_history(snap(spark, BEFORE), KEYS, TRACKED), snap(spark, BEFORE, ("b", "B", None, None, None)), 1)
    new = snap(spark, AFTER, ("c", "C", None, None, None))
    halves = H.open_versions(H.close_versions(history, new, 2, KEYS, TRACKED), new, 2, KEYS, TRACKED)
    assert bag_diff(step(history, new, 2), halves).isEmpty()


def test_change_within_one_release_and_older_release_are_refused(spark):
    history = step(H.empty_history(snap(spark, BEFORE), KEYS, TRACKED), snap(spark, BEFORE), 2)
    with pytest.raises(CheckFailed, match="positive_interval"):
        raise_if_failed(H.check_history(step(history, snap(spark, AFTER), 2), KEYS, snap(spark, AFTER)), "history")
    with pytest.raises(CheckFailed, match="no_older_snapshot"):
        raise_if_failed(H.check_sequence(history, 1), "history")
    raise_if_failed(H.check_sequence(history, 2), "history")


def test_rebuild_equals_incremental_on_random_releases(spark):
    chance = random.Random(7)
    seqs = [10, 20, 30, 40, 50]
    data = [(seq, f"k{k}", chance.choice(["x", "y", None]), chance.choice([1, None]))
            for seq in seqs for k in range(60) if chance.random() < 0.7]
    frame = spark.createDataFrame(data, "seq bigint, k string, v string, w bigint").cache()
    history = H.empty_history(frame, ["k"], ["v", "w"])
    for seq in seqs:
        for _ in range(2):
            snapshot = frame.filter(frame.seq == seq)
            advanced = H.apply_snapshot(history, snapshot, seq, ["k"], ["v", "w"])
            history = spark.createDataFrame(advanced.collect(), history.schema)
    rebuilt = H.rebuild_history(frame, frame.select("seq"), ["k"], ["v", "w"])
    assert bag_diff(rebuilt, history).isEmpty()
    raise_if_failed(H.check_history(rebuilt, ["k"], frame.filter("seq = 50")), "rebuilt")
