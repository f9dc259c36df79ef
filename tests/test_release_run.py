"""Whole releases from landed CSV files to published tables, and the checks that stop them."""

import os

import pytest
from pyspark.sql import functions as F

from bags import rows
from tidemark.operators.quality import CheckFailed
from tidemark.plans import dashboard, gold, silver, verification
from tidemark.plans.release_run import ReleaseRun
from tidemark.plans.schema import DATASETS
from tidemark.session import scratch
from tidemark.sources import csv_release as csv
from tidemark.sources import manifest as M
from tidemark.streaming.ingest import RawStore

R1, R2 = "v2026.8.1", "v2026.14.0"
SEQ1, SEQ2 = 2026008001, 2026014000


def result(race, year, driver, team, engine, car, place, grid, points, reason="", text=None):
    return (race, year, "1" if race != "3" else "2", driver, team, engine, car, place, text or place or "DNF",
            grid, grid, points, "50", reason)


RESULT_HEADER = [raw for raw, _, _ in DATASETS["race_results"].columns]


def release_files(second=False):
    """Header and rows of every dataset; the second release changes, removes and adds."""
    drivers = [("a", "Ann", "Ann Able", "", "1980-01-01"), ("b", 'Bo "B" Bee', "Bo, Bee", "fr", "1981-02-02"),
               ("c", "Cy", "Cy\nCole", "de", "")]
    if second:
        drivers = [("a", "Ann", "Ann Able", "it", "1980-01-01"), drivers[1], drivers[2],
                   ("d", "Di", "Di Dee", "es", "1999-09-09")]
    races = [("1", "2025", "1", "2025-03-01", "australia", "Race One", "x"),
             ("2", "2026", "1", "2026-03-01", "new-zealand", "Race Two", "y"),
             ("3", "2026", "2", "2026-04-01", "australia", "Race Three", "x")]
    race_header = [raw for raw, _, _ in DATASETS["races"].columns]
    if second:  # a later header with one more column, in another place
        race_header = ["sprintRaceLaps", *race_header]
        races = [("20" if r[0] == "3" else "", *r) for r in races]
    results = [
        result("1", "2025", "a", "t", "m", "7", "1", "2", "25"),
        result("1", "2025", "b", "t", "m", "7", "2", "1", "18"),   # shares car 7
        result("2", "2026", "a", "t", "m", "7", "2", "5", "18"),
        result("2", "2026", "b", "u", "n", "8", "1", "1", "25"),
        result("2", "2026", "c", "u", "n", "9", "", "3", "", "Engine"),
        result("3", "2026", "a", "t", "m", "7", "3", "0", "15"),
    ]
    sprints = [result("3", "2026", "a", "t", "m", "7", "1", "1", "8")]
    driver_standings = [("2025", "a", "1", "1", "25", "true"), ("2025", "b", "2", "2", "18", "false"),
                        ("2026", "a", "1", "1", "41", "true"), ("2026", "b", "", "EX", "25", "false")]
    team_standings = [("2025", "t", "m", "1", "1", "43", "true"), ("2025", "t", "m", "", "EX", "0", "false"),
                      ("2026", "u", "n", "", "EX", "0", "false"), ("2026", "t", "m", "1", "1", "41", "true")]
    return {
        "drivers": ([r for r, _, _ in DATASETS["drivers"].columns], drivers),
        "constructors": (["id", "name", "countryId"], [("t", "Team T", "it"), ("u", "Team U", "uk")]),
        "circuits": (["id", "name", "countryId", "type"], [("x", "Ex", "au", "STREET"), ("y", "Why", "nz", "ROAD")]),
        "races": (race_header, races),
        "race_results": (RESULT_HEADER, results),
        "sprint_results": (RESULT_HEADER, sprints),
        "driver_standings": ([r for r, _, _ in DATASETS["driver_standings"].columns], driver_standings),
        "constructor_standings": ([r for r, _, _ in DATASETS["constructor_standings"].columns], team_standings),
    }


def quoted(value):
    return '"' + value.replace('"', '""') + '"' if any(c in value for c in ',"\n') else value


def land(landing, tag, files):
    for name, (header, data) in files.items():
        folder = csv.release_path(landing, name, tag)
        os.makedirs(folder)
        lines = [",".join(header)] + [",".join(quoted(v) for v in row) for row in data]
        with open(f"{folder}/{name}.csv", "w", newline="") as out:
            out.write("\r\n".join(lines) + "\r\n")


@pytest.fixture(scope="module")
def finished(spark):
    landing = scratch(spark, "landing")
    land(landing, R1, release_files())
    land(landing, R2, release_files(second=True))
    run = ReleaseRun(spark, landing, scratch(spark, "warehouse"))
    first = run.run(R1, 2025, "hash-1")
    second = run.run(R2, 2025, "hash-2")
    return run, first, second


def test_change_counts_and_current_rows(finished):
    run, first, second = finished
    assert first["drivers"] == {"insert": 3, "update": 0, "unchanged": 0, "delete": 0}
    assert second["drivers"] == {"insert": 1, "update": 1, "unchanged": 2, "delete": 0}
    assert second["race_results"]["unchanged"] == 6
    for name in DATASETS:
        assert rows(run.silver(name).select("_release_seq").distinct()) == [(SEQ2,)]
    names = dict(rows(run.silver("drivers").select("driver_id", "full_name")))
    assert names["b"] == "Bo, Bee" and names["c"] == "Cy\nCole"


def test_history_and_ledger(finished):
    run, _, _ = finished
    history = rows(run.silver("drivers_history").select("driver_id", "valid_from_release", "valid_to_release"),
                   "driver_id", "valid_from_release")
    assert history == [("a", SEQ1, SEQ2), ("a", SEQ2, None), ("b", SEQ1, None), ("c", SEQ1, None), ("d", SEQ2, None)]
    assert run.open_history_differences().isEmpty()
    assert rows(run.state.read().select("release_seq", "status"), "release_seq") == [
        (SEQ1, "COMPLETE"), (SEQ2, "COMPLETE")]
    assert run.completions.read().groupBy("release_seq").count().filter("count = 5").count() == 2


def test_gold_values(finished):
    run, _, _ = finished
    season = {(r.season, r.driver_id): r for r in run.gold("driver_season").collect()}
    a = season[(2026, "a")]
    assert (a.race_points, a.sprint_points, a.calculated_points, a.points_difference) == (33, 8, 41, 0)
    assert (a.race_entries, a.race_wins, a.race_podiums) == (2, 0, 2)
    teams = {(r.season, r.constructor_id): r for r in run.gold("constructor_season").collect()}
    t = teams[(2025, "t")]
    assert len(teams) == 3 and t.entry_category == "RANKED"  # the excluded twin is dropped
    assert (t.race_car_entries, t.race_wins, t.race_podiums) == (1, 1, 1)  # one shared car
    assert teams[(2026, "u")].entry_category == "EX" and teams[(2026, "u")].race_wins == 1
    facts = {(r.race_id, r.session_type, r.driver_id): r for r in run.gold("session_results").collect()}
    out = facts[(2, "RACE", "c")]
    assert (out.points, out.has_points, out.positions_gained) == (0, False, None)
    assert facts[(3, "RACE", "a")].positions_gained is None  # grid 0
    assert facts[(2, "RACE", "a")].positions_gained == 3
    assert not facts[(3, "SPRINT", "a")].is_race_win


def test_serving_on_the_finished_release(finished):
    run, _, _ = finished
    facts, drivers = run.gold("session_results"), run.silver("drivers")
    results = dashboard.race_results_view(facts, run.gold("race_dimension"))
    labels = {r.race_id: r.grand_prix for r in results.collect()}
    assert labels == {1: "01 - AUSTRALIA", 2: "01 - NEW ZEALAND", 3: "02 - AUSTRALIA"}
    assert results.filter("finish_position IS NULL AND classification_order <> 9999").isEmpty()
    career = dashboard.with_career_ranks(
        dashboard.driver_career(facts, run.gold("driver_season"), drivers), "driver_id")
    found = {r.driver_id: (r.championships, r.race_entries, r.race_wins, r.titles_rank, r.wins_rank) for r in career.collect()}
    assert found == {"a": (2, 3, 1, 1, 1), "b": (0, 2, 1, 2, 2), "c": (0, 1, 0, 3, 3)}  # c has no standing
    gaps = verification.standings_gaps(facts, run.gold("race_dimension"), run.gold("driver_season"))
    assert rows(gaps.select("season", "driver_id")) == [(2026, "c")]
    assert rows(dashboard.constructor_wins(facts, run.silver("constructors")).select("season", "constructor_id", "race_wins")) == [
        (2025, "t", 1), (2026, "u", 1)]


def test_join_report_finds_missing_and_duplicate_races(finished):
    run, _, _ = finished
    facts, races = run.gold("session_results"), run.gold("race_dimension")

    def statuses(frame):
        return {r.check_name: r.status for r in verification.join_verification(facts, frame).collect()}

    assert set(statuses(races).values()) == {"PASS"}
    without = statuses(races.filter("race_id <> 2"))
    assert without["missing_races"] == "FAIL" and without["joined_rows"] == "PASS"
    doubled = statuses(races.unionByName(races.filter("race_id = 2")))
    assert doubled["duplicate_joined_keys"] == "FAIL" and doubled["joined_rows"] == "FAIL"


def test_raw_table_keeps_both_releases_and_their_headers(finished):
    run, _, _ = finished
    raw = run.raw.table("races")
    population = verification.source_population(raw, ["sprintRaceLaps", "id"])
    assert rows(population) == [(R2, 1, 3), (R1, 0, 3)]
    assert run.raw.ingest(DATASETS, [R1, R2]) == 0  # a replay finds nothing
    assert raw.filter(F.col("release_tag") == R1).count() == 3


def test_second_run_of_the_latest_release_changes_nothing(finished, spark):
    run, _, _ = finished
    before = rows(run.silver("drivers_history"))
    changes = run.run(R2, 2025, "hash-2")
    assert all(c["insert"] == c["update"] == c["delete"] == 0 for c in changes.values())
    assert rows(run.silver("drivers_history")) == before
    with pytest.raises(CheckFailed, match="rollback"):
        run.prepare(R1, 2025, "hash-1")
    with pytest.raises(CheckFailed, match="identity_changed"):
        run.prepare(R2, 2025, "other")


def landed(spark, tag, **changes):
    landing = scratch(spark, "bad-landing")
    land(landing, tag, {**release_files(), **changes})
    return landing


def test_manifest_rules(spark):
    people = release_files()["drivers"]
    header, data = people
    landing = landed(
        spark, R1,
        drivers=(["id", "ID", *header[2:]], data),                       # duplicate and missing column
        constructors=(["id", "name", "countryId", "_source_file"], [("t", "T", "it", "x")]),
        circuits=(["id", "name", "countryId", "type"], [("x", "Ex", "au")]),  # short row
        races=(release_files()["races"][0], []), sprint_results=(RESULT_HEADER, []))
    manifest = M.build_manifest(spark, landing, {n: [R1] for n in DATASETS})
    found = {(r.dataset, r.violation) for r in M.manifest_violations(manifest, DATASETS).collect()}
    assert found == {("drivers", "duplicate_header"), ("drivers", "missing_column"), ("constructors", "reserved_column"),
                     ("circuits", "malformed_rows"), ("races", "empty_release")}


def test_changed_file_is_noticed(spark):
    landing = landed(spark, R1)
    tables = {"circuits": [R1]}
    kept = spark.createDataFrame(M.build_manifest(spark, landing, tables).collect(),
                                 M.build_manifest(spark, landing, tables).schema)
    assert M.verify_manifest(M.build_manifest(spark, landing, tables), kept).isEmpty()
    with open(f"{csv.release_path(landing, 'circuits', R1)}/circuits.csv", "a") as out:
        out.write("z,Zed,nz,ROAD\r\n")
    now = M.verify_manifest(M.build_manifest(spark, landing, tables), kept)
    assert {r.violation for r in now.collect()} == {"sha256_changed", "row_count_changed"}


def test_bad_reference_and_future_season_stop_before_publishing(spark):
    header, data = release_files()["races"]
    landing = landed(spark, R1, races=(header, [*data, ("4", "2027", "1", "2027-01-01", "g", "n", "nowhere")]))
    run = ReleaseRun(spark, landing, scratch(spark, "bad-warehouse"))
    with pytest.raises(CheckFailed, match="no_future_season=1.*reference:circuits=1"):
        run.run(R1, 2025, "hash-1")
    assert not run.table("silver", "races").exists()
    assert rows(run.state.read().select("status")) == [("RUNNING",)]


def test_blank_season_blocks_and_scope_filters(spark):
    header, data = release_files()["race_results"]
    landing = landed(spark, R1, race_results=(header, [*data, result("1", "", "a", "t", "m", "99", "5", "5", "0")]))
    store = RawStore(spark, landing, scratch(spark, "blank-raw"))
    store.ingest(["race_results"])
    raw = store.table("race_results")
    assert dict(rows(silver.input_checks("race_results", raw, R1, 7)))["no_blank_season"] == 1
    kept = raw.filter("year IS NOT NULL")
    assert silver.clean("race_results", kept, R1, 2026).count() == 4
    assert silver.clean("race_results", kept, "v2026.9.9", 2026).count() == 0


def write_files(folder, texts):
    os.makedirs(folder)
    for i, text in enumerate(texts):
        with open(f"{folder}/{i:04d}.csv", "w") as out:
            out.write(text)


def test_ingest_counts_rows_beyond_the_kept_progress(spark):
    landing = scratch(spark, "many")
    write_files(csv.release_path(landing, "circuits", R1), [f"id,name\n{i},n{i}\n" for i in range(104)])
    store = RawStore(spark, landing, scratch(spark, "many-raw"))
    assert store.ingest(["circuits"], max_files=1) == 104
    assert store.ingest(["circuits"], max_files=1) == 0


def test_raw_table_stands_without_the_landing_area(spark):
    landing = scratch(spark, "gone")
    write_files(csv.release_path(landing, "circuits", R1), ["id,name\n1,a\n2,b\n"])
    store = RawStore(spark, landing, scratch(spark, "gone-raw"))
    with pytest.raises(FileNotFoundError):
        store.table("circuits")
    assert store.ingest(["circuits"]) == 2
    write_files(csv.release_path(landing, "circuits", R2), ["id,name,extra\n3,c,x\n"])  # landed, not ingested
    assert rows(store.table("circuits").select("release_tag", "id")) == [(R1, "1"), (R1, "2")]
    elsewhere = RawStore(spark, scratch(spark, "empty-landing"), store.root)
    assert elsewhere.table("circuits").count() == 2
    assert store.ingest(["circuits"]) == 1
    assert rows(store.table("circuits").select("id", "extra")) == [("1", None), ("2", None), ("3", "x")]


def test_a_failing_stream_stops_the_others(spark):
    landing = scratch(spark, "failing")
    write_files(csv.release_path(landing, "circuits", R1), ["id,name\n1,a\n"])
    write_files(csv.release_path(landing, "circuits", R2), ["id,name\n1,a\n", "name,id\na,1\n"])
    store = RawStore(spark, landing, scratch(spark, "failing-raw"))
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        store.ingest(["circuits"])
    assert not spark.streams.active


def test_manifest_reads_quoted_header_names(spark):
    from tidemark.sources.manifest import build_manifest

    landing = scratch(spark, "quoted")
    write_files(csv.release_path(landing, "circuits", R1), ['id,"name, full","a ""b""",last\r\n1,2,3,4\r\n'])
    found = build_manifest(spark, landing, {"circuits": [R1]}).first()
    assert found["columns"] == ["id", "name, full", 'a "b"', "last"] and found["row_count"] == 1
    assert found["columns"] == csv.header(spark, csv.release_path(landing, "circuits", R1))


def test_reordered_header_within_a_release_is_an_error(spark):
    landing = scratch(spark, "mixed")
    folder = csv.release_path(landing, "circuits", R1)
    os.makedirs(folder)
    for name, text in (("a", "id,name,countryId,type\nx,Ex,au,ROAD\n"), ("b", "name,id,countryId,type\nEx,x,au,ROAD\n")):
        with open(f"{folder}/{name}.csv", "w") as out:
            out.write(text)
    store = RawStore(spark, landing, scratch(spark, "mixed-raw"))
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        store.ingest(["circuits"])


def test_union_and_single_pass_facts_agree(spark, small):
    from tidemark.operators.parity import bag_diff
    from tidemark.plans.retail import Retail

    r = Retail(spark, small)
    assert bag_diff(r.facts, r.facts_from_union).isEmpty()
    assert gold.unreconciled(r.driver_season).count() > 0
