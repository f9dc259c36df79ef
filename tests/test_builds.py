"""Fingerprints, sorted scans, schemas of files, invariants between results, and checks that must turn red."""

import random
from decimal import Decimal

import pytest
from bags import rows
from pyspark.sql import functions as F

from tidemark.catalog import checks
from tidemark.operators import fingerprint
from tidemark.operators.folds import recomputed, sorted_totals
from tidemark.operators.parity import bag_diff
from tidemark.plans import verification
from tidemark.plans.schema import DATASETS
from tidemark.session import scratch
from tidemark.sources import csv_release as csv
from tidemark.sources import schemas
from tidemark.sources.manifest import build_manifest, expected_rows, manifest_violations, table_manifest

SCHEMA = "k string, a string, b string, n decimal(18,2)"


def table(seed, n=500):
    rng = random.Random(seed)
    pick = lambda: rng.choice([None, "x", "y", ""])
    return [(f"k{rng.randrange(200)}" if i % 50 else None, pick(), pick(), Decimal(rng.randrange(5))) for i in range(n)]


@pytest.mark.parametrize("edit", ["none", "swap nulls", "copy", "drop", "order"])
def test_fingerprints_find_exactly_the_ranges_that_differ(spark, edit):
    data = table(1)
    other = {"none": data, "copy": [*data, data[7]], "drop": data[:-1], "order": data[::-1],
             "swap nulls": [("z", "x", None, Decimal(1)), *data]}[edit]
    left = spark.createDataFrame([("z", None, "x", Decimal(1)), *data] if edit == "swap nulls" else data, SCHEMA).repartition(3)
    right = spark.createDataFrame(other, SCHEMA).repartition(5).select("n", "b", "a", "k")
    sides = [fingerprint.fingerprints(f, ["k"], left.columns, 4).withColumns({"dataset": F.lit("t"), "side": F.lit(s)})
             for f, s in ((left, 1), (right, -1))]
    ranges = fingerprint.differing_ranges(sides[0].unionByName(sides[1]))
    expected = bag_diff(left, right)
    touched = expected.select(fingerprint.key_range(["k"], 4).alias("range")).distinct()
    assert rows(ranges.select("range")) == rows(touched) and (edit in ("none", "order")) == ranges.isEmpty()
    assert rows(fingerprint.differences(left, right, ["k"], left.columns, ranges.select("range"), 4)) == rows(expected)


def test_fingerprints_add_up_in_longs(spark):
    """Sums of whole hashes would not fit a long, and a decimal of 38 digits is an object a row."""
    frame = spark.createDataFrame(table(3), SCHEMA)
    sums = fingerprint.fingerprints(frame, ["k"], frame.columns, 1)
    assert {f.dataType.simpleString() for f in sums.schema if f.name != "range"} == {"bigint"}
    hashes = frame.select(F.xxhash64(F.lit(1), *[x for c in sorted(frame.columns) for x in (F.col(c).isNull(), F.col(c))]).alias("h"))
    found = sums.collect()
    assert sum((r["h1_high"] << 32) + r["h1_low"] for r in found) == sum(r["h"] for r in hashes.collect())
    assert sum(r["n"] for r in found) == hashes.count()


def test_sorted_totals_equal_an_aggregate(spark):
    rng = random.Random(2)
    data = [("hot" if i % 3 else rng.choice(["a", "b", None]), rng.randrange(4) or None, i, rng.randrange(-5, 9)) for i in range(3000)]
    frame = spark.createDataFrame(data, "k string, g int, i long, v long").repartition(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # runs go over batches
    try:
        got = sorted_totals(frame, ["k", "g"], "v", "i")
        plain = frame.groupBy("k", "g").agg(F.sum("v").alias("total"))
        assert rows(got) == rows(plain)
        assert rows(recomputed("t", plain, got, ["k", "g"])) == [("t", 11, 0, None)] or plain.count() != 11
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    wrong = frame.withColumn("v", F.when(F.col("k") == "a", F.col("v") + 1).otherwise(F.col("v")))
    report = recomputed("t", plain, sorted_totals(wrong, ["k", "g"], "v", "i"), ["k", "g"]).first()
    assert report["differing"] == plain.filter("k = 'a'").count() and report["first_differing"].startswith("a")
    assert sorted_totals(frame.filter("false"), ["k", "g"], "v", "i").count() == 0


def test_schema_differences_name_one_changed_file(spark):
    left, right = scratch(spark, "left"), scratch(spark, "right")
    base = spark.range(10).select(F.col("id").cast("string").alias("a"), F.col("id").alias("b"))
    base.repartition(3).write.parquet(left)
    base.select("b", "a").repartition(2).write.parquet(right)  # another order of columns is no difference

    def found():
        return rows(schemas.schema_differences("t", schemas.file_columns(spark, [left]), schemas.file_columns(spark, [right])))

    assert found() == []
    base.limit(4).select(F.col("a"), F.col("b").cast("int"), F.lit(1).alias("c")).coalesce(1).write.mode("append").parquet(right)
    assert found() == [("t", "b", "long", "integer", 1, 4), ("t", "c", None, "integer", 1, 4)]
    base.limit(3).select("a").coalesce(1).write.mode("append").parquet(right)
    assert ("t", "b", "long", None, 1, 3) in found() and len(found()) == 3


def test_invariants_turn_red_on_planted_faults(spark):
    pair = "race_wins_a long, race_wins_b long, comparable_finishes long, qualifying_wins_a long, qualifying_wins_b long, comparable_qualifying long"
    steps, seasons = "driver_id string, round long, calculated_points long", "driver_id string, source_points long"

    def report(pairs, points, source):
        return {r.invariant: (r.n, r.violations) for r in verification.result_invariants(
            spark.createDataFrame(pairs, pair), spark.createDataFrame(points, steps), spark.createDataFrame(source, seasons)).collect()}

    good = ([(1, 2, 3, 0, 4, 4)], [("a", 1, 5), ("a", 2, 9), ("b", 2, 0)], [("a", 9), ("b", 0)])
    assert [v for _, v in report(*good).values()] == [0, 0, 0] and report(*good)["last round and source points"] == (2, 0)
    bad = ([(1, 2, 4, 0, 4, 4), (0, 0, 0, 1, 0, 0)], [("a", 1, 9), ("a", 2, 5)], [("a", 9)])
    assert [v for _, v in report(*bad).values()] == [1, 1, 1]


def test_row_count_gates_see_a_dropped_row(spark, small, monkeypatch):
    """Nothing is lost but one row, and nothing at all: only then is the gate green."""
    def missing(query, name):
        return dict(rows(query(spark, small).select("check_name", "failures")))[name]

    one = spark.read.parquet(f"{small}/lineitem.parquet").orderBy("l_orderkey", "l_linenumber").first()
    for lost, n in ((f"l_orderkey = {one.l_orderkey} AND l_linenumber = {one.l_linenumber}", 1), ("false", 0)):
        monkeypatch.setattr(checks, "_LOST_LINES", lost)
        assert missing(checks.row_checks, "row_count") == n
    monkeypatch.setattr(checks, "_LOST_ORDERS", "false")
    assert missing(checks.input_gate, "row_count") == 0
    monkeypatch.setattr(checks, "_UNLISTED", "false")
    assert missing(checks.history_verification, "modern_session_coverage") == 0


def test_career_totals_shuffle_no_row_that_counts_nothing(spark, small, monkeypatch):
    """Before, all results were dealt out for the totals, and each of them for the races that they refer to."""
    seen = []
    for name in ("driver_totals", "constructor_totals"):
        monkeypatch.setattr(verification, name, lambda facts, plain=getattr(verification, name): seen.append(facts) or plain(facts))
    monkeypatch.setattr(verification.quality, "missing_references",
                        lambda frame, *more, plain=verification.quality.missing_references: seen.append(frame) or plain(frame, *more))
    told = dict(rows(checks.history_verification(spark, small).select("check_name", "failures")))
    assert told["race_join_coverage"] == 0 and told["driver_career_vs_source"] > 0
    scored, shared, referring = seen
    for frame in (scored, shared):
        assert frame.count() > 0 and frame.filter("NOT (is_race_win OR is_race_podium)").isEmpty()
    assert referring.count() == referring.select("race_id", "season", "round").distinct().count()


def test_table_manifest_counts_each_file(spark):
    path = scratch(spark, "counted")
    spark.range(10).repartition(3).write.parquet(path)
    manifest = table_manifest(spark, path, "t")
    assert sum(n for _, _, n in rows(manifest)) == 10 and manifest.select("file").distinct().count() == manifest.count()


def test_header_of_any_length_is_read_whole(spark):
    import os

    landing = scratch(spark, "wide")
    names = ["id", "name", "countryId", "type", *[f"column_{i:05d}_with_a_long_name" for i in range(4000)]]
    folder = csv.release_path(landing, "circuits", "v2026.1.0")
    os.makedirs(folder)
    with open(f"{folder}/a.csv", "w", encoding="utf-8-sig") as out:
        out.write(",".join(names) + "\r\n" + ",".join("1" for _ in names) + "\r\n")
    manifest = build_manifest(spark, landing, {"circuits": ["v2026.1.0"]})
    assert len(",".join(names)) > 100_000 and manifest.first()["columns"] == names
    assert manifest_violations(manifest, DATASETS).isEmpty() and rows(expected_rows(manifest))[0][2] == 1

def test_parity_counts_rows_of_every_season(spark, small):
    """Nothing is left out of the second build; a table that is empty keeps its row."""
    r = {x.dataset: x for x in checks.gold_parity(spark, small).collect()}
    retail = checks.Retail(spark, small)
    assert {n: x.row_count for n, x in r.items()} == {n: f.count() for n, f in retail.stored_gold.items()}
    assert all((x.missing, x.extra) == (0, 0) for x in r.values())
    empty = retail.races.filter("false")
    assert rows(verification.parity_report({"races": (retail.races, empty, ["race_id"])})) == [("races", retail.races.count(), 0, 0, 0)]
    assert rows(verification.parity_report({"races": (empty, empty, ["race_id"])})) == [("races", 0, 0, 0, 0)]


@pytest.mark.parametrize("seed", [1, 2])
def test_parity_by_hashes_counts_what_rows_would(spark, seed):
    left, right = spark.createDataFrame(table(seed), SCHEMA), spark.createDataFrame(table(seed + 5)[:300] + table(seed)[100:], SCHEMA)
    diff = [s for *_, s in bag_diff(left, right).collect()]
    report = verification.parity_report({"t": (left, right.select("n", "b", "a", "k"), ["k"])}).first()
    assert (report.missing, report.extra) == (sum(s for s in diff if s > 0), -sum(s for s in diff if s < 0)) and report.missing
    assert report.row_count == right.count()
    assert report.duplicate_keys == right.groupBy("k").count().filter("count > 1").count()


def test_names_joined_to_orders_are_those_joined_to_lines(spark, small):
    """Teams that come twice or have no nation multiply or drop the same rows."""
    from tidemark.plans import gold

    retail = checks.Retail(spark, small)
    customers = spark.read.parquet(f"{small}/customer.parquet")
    retail._tables["customer"] = customers.filter("c_custkey % 5 <> 0").unionByName(
        customers.filter("c_custkey % 7 = 0").withColumn("c_name", F.concat("c_name", F.lit("*"))))
    plain = gold.session_results(retail.facts, retail.drivers, retail.constructors)
    assert plain.columns == retail.session_results.columns and plain.count() < retail.facts.count()
    assert bag_diff(plain, retail.session_results).isEmpty() and bag_diff(plain, retail.session_results_from_union).isEmpty()


def test_files_are_cut_to_what_a_task_may_take(spark, small, monkeypatch):
    from tidemark import session
    from tidemark.catalog import QUERIES

    held = {key: spark.conf.get(key, None) for key in session.TABLE_TASKS}
    monkeypatch.setitem(session.TABLE_TASKS, "spark.sql.files.maxPartitionBytes", "2k")
    monkeypatch.setitem(session.TABLE_TASKS, "spark.sql.files.openCostInBytes", "1")
    try:
        assert QUERIES["silver_constructor_standings"](spark, small) is not None
        assert spark.read.parquet(f"{small}/lineitem.parquet").rdd.getNumPartitions() > 20
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        for key, value in held.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)
