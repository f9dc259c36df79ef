"""Operators against small exact cases and brute force."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from bags import rows
from tidemark.functions import releases
from tidemark.operators import groups, pairs, parity, quality, ranking
from tidemark.operators import snapshot as S
from tidemark.operators.clean import type_columns
from tidemark.session import scratch
from tidemark.streaming.cursor import snapshot_source

MERGE = "driver_id string, driver_name string, _release_seq bigint"


def test_merge_inserts_updates_and_removals(spark):
    table = S.VersionedTable(spark, scratch(spark, "merge"))
    first = spark.createDataFrame([("a", "Before", 1), ("removed", "Old", 1)], MERGE)
    second = spark.createDataFrame([("a", "After", 2), ("new", "Added", 2)], MERGE)
    assert table.merge(first, ["driver_id"], 1) == {"insert": 2, "update": 0, "unchanged": 0, "delete": 0}
    assert table.merge(second, ["driver_id"], 2) == {"insert": 1, "update": 1, "unchanged": 0, "delete": 1}
    assert table.merge(second, ["driver_id"], 2) == {"insert": 0, "update": 0, "unchanged": 2, "delete": 0}
    assert rows(table.read(), "driver_id") == [("a", "After", 2), ("new", "Added", 2)]
    assert table.versions().count() == 3


def test_merge_sees_null_changes(spark):
    def frame(value):
        return spark.createDataFrame([("a", value)], "k string, v string")
    kinds = [S.change_counts(S.classify_changes(frame(a), frame(b), ["k"])).first().change
             for a, b in [(None, None), (None, "x"), ("x", None), ("x", "x")]]
    assert kinds == ["unchanged", "update", "update", "unchanged"]


def test_failed_publish_keeps_the_old_version(spark):
    table = S.VersionedTable(spark, scratch(spark, "failed"))
    table.publish(spark.range(3), 1)
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id"))
    with pytest.raises(PySparkException):
        table.publish(broken, 2)
    assert table.read().count() == 3


def test_strict_casts(spark):
    raw = spark.createDataFrame([("1", "2000-01-02", "", "true"), ("", "", "1.5", "")], "a string, b string, c string, d string")
    typed = type_columns(raw, [("a", "n", "bigint"), ("b", "d", "date"), ("c", "p", "decimal(10,2)"),
                               ("d", "w", "boolean"), ("absent", "x", "string")], release_seq=7)
    assert dict(typed.dtypes)["_release_seq"] == "bigint"
    assert [r.n for r in typed.collect()] == [1, None]
    bad = spark.createDataFrame([("not-a-date",)], "b string")
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        type_columns(bad, [("b", "d", "date")]).collect()


@pytest.mark.parametrize("tag,seq", [
    ("v2026.8.1", 2026008001), ("v2026.12.0", 2026012000), ("v2026.08.1", None), ("latest", None),
    ("v2026.8", None), ("v2026.8.1000", None), ("../v2026.8.1", None), ("v2026.8.1\n", None)])
def test_release_tags(spark, tag, seq):
    frame = spark.createDataFrame([(tag,)], "t string").select(releases.release_seq(F.col("t")).alias("s"))
    assert frame.first().s == seq
    if seq is None:
        with pytest.raises(ValueError):
            releases.parse_tag(tag)
    else:
        assert releases.parse_tag(tag) == seq


def test_scope_must_fit_the_release():
    assert releases.check_scope("v2026.8.1", 1950) == 2026008001
    for season in (1949, 2027):
        with pytest.raises(ValueError):
            releases.check_scope("v2026.8.1", season)


def test_checks_report_counts(spark):
    frame = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "k int, v string")
    report = dict(rows(quality.check_rows(frame, ["k"], ["k", "v"], expected_count=2)))
    assert report == {"null:k": 0, "null:v": 1, "row_count": 1, "unique:k": 1}
    with pytest.raises(quality.CheckFailed, match="null:v=1"):
        quality.raise_if_failed(quality.check_rows(frame, ["k"], ["v"]), "frame")
    parent = spark.createDataFrame([(2,)], "k int")
    assert quality.check_reference(frame, parent, ["k"], "p").first().failures == 2


def test_blank_season_and_rescued_rows_block_the_input(spark):
    raw = spark.createDataFrame([("1", "2000", None), ("2", " ", None), ("3", None, "3,x")],
                                "id string, year string, _rescued_data string")
    assert dict(rows(quality.check_input(raw, 3))) == {"no_rescued_rows": 1, "no_blank_season": 2, "row_count": 0}


def test_enforced_expectation_fails_the_read(spark):
    frame = spark.createDataFrame([(1,), (None,)], "k int")
    assert quality.enforce(frame.filter("k = 1"), {"known": "k IS NOT NULL"}).count() == 1
    with pytest.raises(PySparkException, match="expectation failed: known"):
        quality.enforce(frame, {"known": "k IS NOT NULL"}).collect()


def test_bag_difference_counts_copies(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([("x", 1), (None, 2), (None, 2)], "v string, k int")
    assert rows(parity.bag_diff(a, b)) == [(1, "x", 1), (2, None, -1)]
    assert rows(parity.bag_report("t", a, b)) == [("t", 1, 1)]
    assert rows(parity.except_both_ways(a, b)) == [(1, "x", "left"), (2, None, "right")]
    assert rows(parity.schema_diff(spark, a, b.withColumn("k", F.col("k").cast("bigint")))) == [("k", "int", "bigint")]


def test_global_rank_equals_a_plain_sort(spark):
    chance = random.Random(3)
    data = [(i, chance.choice([0, 0, 0, 1, 5]), chance.choice([0, 0, 2])) for i in range(3000)]
    frame = spark.createDataFrame(data, "id int, a int, b int").repartition(7)
    ranked = ranking.global_rank(frame, "r", [F.col("a").desc(), F.col("b").desc(), F.col("id")])
    expected = [i for i, _, _ in sorted(data, key=lambda t: (-t[1], -t[2], t[0]))]
    assert [r.id for r in ranked.orderBy("r").collect()] == expected
    assert [r.r for r in ranked.select("r").orderBy("r").collect()] == list(range(1, 3001))
    assert dict(ranked.dtypes)["r"] == "bigint"


def test_pairs_equal_brute_force_also_in_chunks(spark):
    chance = random.Random(5)
    data = [(chance.choice([1, 1, 1, 2, 3]), f"m{chance.randrange(9)}", chance.choice([1, 2, None])) for _ in range(300)]
    frame = spark.createDataFrame(data, "g int, m string, v int")
    expected = Counter()
    for (g1, m1, v1), (g2, m2, v2) in itertools.product(data, data):
        if g1 == g2 and m1 < m2:
            expected[(g1, m1, m2, v1, v2)] += 1
    for chunk_rows in (5, 10_000):
        out = pairs.member_pairs(frame, ["g"], "m", ["v"], chunk_rows)
        found = {(r.g, r.member_a, r.member_b, r.v_a, r.v_b): r.weight for r in out.collect()}
        assert out.count() == len(found)
        assert found == dict(expected)


def test_group_totals_keep_null_groups(spark):
    frame = spark.createDataFrame([("x", 1), ("x", 2), (None, 3), (None, 4)], "g string, v int")
    out = groups.with_group_totals(frame, ["g"], F.sum("v").alias("s"), F.max("v").alias("m"))
    assert rows(out) == sorted([("x", 1, 3, 2), ("x", 2, 3, 2), (None, 3, 7, 4), (None, 4, 7, 4)], key=repr)


def test_dense_series_carries_totals_forward(spark):
    frame = spark.createDataFrame([("a", 1, 5), ("a", 4, 2), ("b", 3, 1)], "k string, s bigint, v bigint")
    out = groups.dense_running_total(frame, "k", "s", "v", "t", F.lit(5).cast("bigint"))
    assert rows(out.select("k", "s", "v", "t"), "k", "s") == [
        ("a", 1, 5, 5), ("a", 2, 0, 5), ("a", 3, 0, 5), ("a", 4, 2, 7), ("a", 5, 0, 7),
        ("b", 3, 1, 1), ("b", 4, 0, 1), ("b", 5, 0, 1)]


def test_dense_series_ends_at_the_last_step(spark):
    frame = spark.createDataFrame([("a", 1, 5), ("a", 3, 2), ("b", 3, 1)], "k string, s bigint, v bigint")
    out = groups.dense_running_total(frame, "k", "s", "v", "t", F.lit(2).cast("bigint"))
    assert rows(out.select("k", "s", "v", "t"), "k", "s") == [("a", 1, 5, 5), ("a", 2, 0, 5)]


@pytest.mark.parametrize("sprint_only", [2, 3])
def test_progression_ignores_rounds_that_were_not_raced(spark, sprint_only):
    """A round with a sprint alone, in the middle or at the end, opens no round and adds no points."""
    from tidemark.plans.explore import points_progression

    facts = [(1998, r, 10 * r, d, kind, p) for r in (1, 2, 3) for kind, gain in (("RACE", 10), ("SPRINT", 3))
             if not (r == sprint_only and kind == "RACE") for d, p in (("a", gain), ("b", gain - 1))]
    frame = spark.createDataFrame(facts, "season bigint, round bigint, race_id bigint, driver_id string, session_type string, points bigint")
    seasons = spark.createDataFrame([(1998, "a", "A"), (1998, "b", "B")], "season bigint, driver_id string, driver_name string")
    found = rows(points_progression(frame, seasons, 1998).select("round", "driver_id", "calculated_points", "gap_to_calculated_leader"))
    raced = [r for r in (1, 2, 3) if r != sprint_only]
    assert found == sorted([(r, d, total * (i + 1), gap * (i + 1)) for i, r in enumerate(raced)
                            for d, total, gap in (("a", 13, 0), ("b", 11, 2))], key=repr)


def test_shared_folder_is_demanded_on_a_cluster():
    from types import SimpleNamespace

    from tidemark import session

    def on(master):
        context = SimpleNamespace(master=master, getConf=lambda: {}, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        return SimpleNamespace(sparkContext=context, conf={})

    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(on(master))
    for master in ("local", "local[8]", "local[*]"):
        assert session.shared_dir(on(master))


def test_running_totals_in_chunks_equal_the_plain_window(spark):
    chance = random.Random(11)
    data = [(chance.choice("aaab"), i, chance.randrange(10)) for i in range(500)]
    frame = spark.createDataFrame(data, "k string, s bigint, v bigint")
    plain = groups.running_total(frame, ["k"], ["s"], "v", "t")
    for width in (7, 1000):
        chunked = groups.chunked_running_total(frame, ["k"], ["s"], F.floor(F.col("s") / width), "v", "t")
        assert parity.bag_diff(chunked, plain).isEmpty()


def test_snapshot_source_hands_out_only_newer_versions(spark):
    source = snapshot_source(lambda: spark.range(1), 2026008002)
    assert source(None)[1] == 2026008002
    assert source(2026008001)[1] == 2026008002
    assert source(2026008002) is None
    assert source(2026014000) is None


def test_team_seasons_fold_where_the_races_are(spark):
    from tidemark.plans import gold

    facts = spark.createDataFrame(
        [(1, "RACE", "1", 5, 1), (1, "RACE", "1", 5, 1), (1, "RACE", "2", 3, 0), (2, "SPRINT", "1", 2, 0), (None, "RACE", "1", 1, 0)],
        "race_id long, session_type string, car_number string, points long, win int").selectExpr(
        "race_id", "session_type", "car_number", "cast(points as decimal(10,2)) AS points", "win = 1 AS is_race_win",
        "win = 1 AS is_race_podium", "2000L AS season", "'t' AS constructor_id", "'e' AS engine_manufacturer_id").repartition(4, "race_id")
    standings = spark.sql("""SELECT 2000L AS season, 't' AS constructor_id, 'e' AS engine_manufacturer_id, 'RANKED' AS entry_category,
        1L AS standing, '1' AS standing_status, cast(16 AS decimal(10,2)) AS points, true AS championship_won""")
    teams = spark.sql("SELECT 't' AS constructor_id, 'T' AS constructor_name, 'x' AS country_id")
    table = gold.constructor_season(standings, teams, facts, 1)
    plan = table._jdf.queryExecution().executedPlan().toString()  # before it has run
    row = table.collect()[0]
    assert (row.calculated_points, row.race_weekends, row.race_car_entries, row.race_wins, row.race_podiums) == (16, 1, 3, 1, 1)
    assert table.schema["calculated_points"].dataType.simpleString() == "decimal(30,2)"
    # Nothing is dealt by race but the facts themselves.
    assert sum("Exchange hashpartitioning" in line and "race_id" in line for line in plan.splitlines()) <= 1, plan
