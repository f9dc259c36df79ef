"""Reports that compare stored tables with each other and with their source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import results as R
from tidemark.functions.measures import count_where, flag, zero_fill
from tidemark.functions.text import is_blank
from tidemark.operators import history as H
from tidemark.operators import fingerprint, parity, quality
from tidemark.operators.ledger import completion_counts
from tidemark.plans.gold import car_rows
from tidemark.plans.schema import DATASETS, GOLD_KEYS, TERMINAL_TASKS
from tidemark.session import stored

C = F.col


def _check(name: str, rows: DataFrame, actual: Column, expected: DataFrame | None = None,
           expected_value: Column | None = None) -> DataFrame:
    """One ``(check_name, actual, expected)`` row with both figures as DOUBLE."""
    left = rows.agg(actual.cast("double").alias("actual"))
    if expected is None:
        right = F.lit(0).cast("double")
    else:
        right = expected.agg(expected_value.cast("double")).scalar()
    return left.select(F.lit(name).alias("check_name"), "actual", right.alias("expected"))


def standings_gaps(session_results: DataFrame, race_dimension: DataFrame, driver_season: DataFrame) -> DataFrame:
    """Results of drivers who have no standings row in that season."""
    covered = driver_season.select("_release_seq", "season", "driver_id")
    race = race_dimension.select("_release_seq", "race_id", "race_name")
    return (
        session_results.join(covered, ["_release_seq", "season", "driver_id"], "left_anti")
        .join(race, ["_release_seq", "race_id"])
        .select("season", "race_id", "race_name", "driver_id", "driver_name", "constructor_name",
                "finish_status", "points"))


def join_verification(session_results: DataFrame, race_dimension: DataFrame) -> DataFrame:
    """Six checks that joining results to races neither loses, multiplies nor blanks a row."""
    race = race_dimension.select("_release_seq", "race_id", "race_name", "circuit_name", F.lit(True).alias("_matched"))
    joined = session_results.join(race, ["_release_seq", "race_id"], "left")
    keys = ["race_id", "session_type", "driver_id", "car_number"]
    blank = (is_blank(C("driver_name")) | is_blank(C("constructor_name"))
             | is_blank(C("race_name")) | is_blank(C("circuit_name")))
    n = F.count(F.lit(1))

    def points(session: str) -> Column:
        return zero_fill(F.sum(F.when(C("session_type") == session, C("points"))))

    # Five of the checks are one aggregate of each side; only the keys need a shuffle of their own.
    after = joined.agg(
        n.alias("joined_rows"), F.count_if(C("_matched").isNull()).alias("missing_races"),
        F.count_if(blank).alias("missing_display_names"), points(R.RACE).alias("race_points_preserved"),
        points(R.SPRINT).alias("sprint_points_preserved"))
    before = session_results.agg(
        n.alias("joined_rows"), points(R.RACE).alias("race_points_preserved"),
        points(R.SPRINT).alias("sprint_points_preserved"))

    def long(frame: DataFrame, value: str) -> DataFrame:
        items = [F.struct(F.lit(c).alias("check_name"), C(c).cast("double").alias(value)) for c in frame.columns]
        return frame.select(F.explode(F.array(*items)).alias("x")).select("x.*")

    sides = long(after, "actual").join(long(before, "expected"), "check_name", "left")
    totals = sides.select("check_name", "actual", F.coalesce("expected", F.lit(0.0)).alias("expected"))
    return quality.pass_or_fail(totals.unionByName(
        _check("duplicate_joined_keys", quality.duplicate_keys(joined, keys), n)))


def career_mismatches(declared: DataFrame, computed: DataFrame, key: str,
                      measures: Mapping[str, str]) -> DataFrame:
    """Entities whose declared totals differ from computed ones; absent computed totals are zero."""
    wrong = F.lit(False)
    for source, measure in measures.items():
        wrong = wrong | (C(source).cast("bigint") != zero_fill(C(measure)))
    return declared.join(computed, key, "left").filter(wrong)


def driver_totals(facts: DataFrame) -> DataFrame:
    """Wins and podiums as distinct races per driver."""
    per_race = facts.groupBy("driver_id", "race_id").agg(
        F.max("is_race_win").alias("won"), F.max("is_race_podium").alias("on_podium"))
    return per_race.groupBy("driver_id").agg(
        count_where(C("won")).alias("wins"), count_where(C("on_podium")).alias("podiums"))


def constructor_totals(facts: DataFrame) -> DataFrame:
    """Wins and podiums once per car."""
    raced = facts.filter(R.is_race(C("session_type")))
    return car_rows(raced, "constructor_id").groupBy("constructor_id").agg(
        F.sum("won").alias("wins"), F.sum("on_podium").alias("podiums"))


def titles(seasons: DataFrame, key: str) -> DataFrame:
    return seasons.groupBy(key).agg(F.sum(flag(C("championship_won"))).alias("titles"))


def history_verification(
    declared_drivers: DataFrame, declared_constructors: DataFrame, gold: Mapping[str, DataFrame],
    silver: Mapping[str, DataFrame], release_state: DataFrame, completions: DataFrame,
    release_seq: int, min_season: int, modern: int, expected: Mapping[str, int],
) -> DataFrame:
    """Fourteen checks after a history expansion.

    ``expected`` gives the known row counts from season ``modern`` on, per gold table.
    """
    facts = gold["session_results"]
    career = {"totalRaceWins": "wins", "totalPodiums": "podiums"}
    title = {"totalChampionshipWins": "titles"}

    # Coverage, titles and stale rows of a table come from one aggregate of it.
    def summary(name: str, frame: DataFrame) -> DataFrame:
        won = F.count_if("championship_won") if "championship_won" in frame.columns else F.lit(0)
        recent = F.count_if(C("season") >= modern)
        stale = F.count_if(~C("_release_seq").eqNullSafe(F.lit(release_seq)))
        return frame.agg(recent.alias("recent"), won.cast("bigint").alias("won"), stale.alias("stale")).withColumn("name", F.lit(name))

    titles_of = {kind: silver[f"{kind}_standings"].agg(F.count_if("championship_won").alias("won")).select(
        F.lit(0).cast("bigint").alias("recent"), "won", F.lit(0).cast("bigint").alias("stale"),
        F.lit(f"{kind}_standings").alias("name")) for kind in ("driver", "constructor")}
    summaries = quality.union_rows([summary(name, frame) for name, frame in gold.items()] + list(titles_of.values()))

    def figure(column: str, name: str) -> Column:
        return F.sum(F.when(C("name") == name, C(column)).otherwise(0))

    figures = {
        "modern_session_coverage": F.abs(figure("recent", "session_results") - expected["session_results"]),
        "modern_driver_standings_coverage": F.abs(figure("recent", "driver_season") - expected["driver_season"]),
        "modern_constructor_standings_coverage":
            F.abs(figure("recent", "constructor_season") - expected["constructor_season"]),
        "driver_champions": F.abs(figure("won", "driver_standings") - figure("won", "driver_season")),
        "constructor_champions": F.abs(figure("won", "constructor_standings") - figure("won", "constructor_season")),
        "latest_release_only": F.sum("stale"),
    }
    one_row = summaries.agg(*[value.alias(name) for name, value in figures.items()])
    summed = one_row.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("check_name"), C(name).alias("failures")) for name in figures])).alias("x")).select("x.*")
    done = (
        completion_counts(completions, TERMINAL_TASKS)
        .join(release_state.filter((C("release_seq") == release_seq) & (C("min_season") == min_season)),
              ["release_seq", "attempt_id"])
        .agg(F.abs(zero_fill(F.sum("tasks_done")) - len(TERMINAL_TASKS)).alias("failures"))
        .select(F.lit("completed_expansion").alias("check_name"), "failures"))
    # Results that neither won nor came on a podium count in no career total, and an absent total is zero.
    scored = facts.filter(C("is_race_win") | C("is_race_podium"))
    report = [
        quality.failures("driver_career_vs_source",
                         career_mismatches(declared_drivers, driver_totals(scored), "driver_id", career)),
        quality.failures("constructor_career_vs_source",
                         career_mismatches(declared_constructors, constructor_totals(scored), "constructor_id", career)),
        quality.failures("driver_titles_vs_source",
                         career_mismatches(declared_drivers, titles(gold["driver_season"], "driver_id"),
                                           "driver_id", title)),
        quality.failures("constructor_titles_vs_source",
                         career_mismatches(declared_constructors,
                                           titles(gold["constructor_season"], "constructor_id"),
                                           "constructor_id", title)),
        quality.failures("session_unique_key", quality.duplicate_keys(facts, GOLD_KEYS["session_results"])),
        quality.failures("constructor_engine_unique_key",
                         quality.duplicate_keys(gold["constructor_season"], GOLD_KEYS["constructor_season"])),
        quality.check_reference(facts, gold["race_dimension"], ["race_id", "season", "round"], "races").select(
            F.lit("race_join_coverage").alias("check_name"), "failures"),
        summed,
        done,
    ]
    typed = [r.select("check_name", C("failures").cast("bigint").alias("failures")) for r in report]
    return quality.pass_or_fail(quality.union_rows(typed))


def parity_report(pairs: Mapping[str, tuple[DataFrame, DataFrame, Sequence[str]]]) -> DataFrame:
    """``(dataset, missing, extra, row_count, duplicate_keys)``: bag equality of two builds of each table, with the size and key
    duplicates of the second. One scan of each build; rows of ranges that differ are told apart by their hashes alone."""
    sides = stored(quality.union_rows([
        fingerprint.fingerprints(frame, keys, left.columns).select(F.lit(name).alias("dataset"), F.lit(side).alias("side"), "*")
        for name, (left, right, keys) in pairs.items() for side, frame in ((1, left), (-1, right))]), "fingerprints")
    ranges = stored(fingerprint.differing_ranges(sides), "ranges")
    counts = sides.filter("side = -1").groupBy("dataset").agg(F.sum("n").alias("row_count"))
    open_ = {r["dataset"] for r in ranges.select("dataset").distinct().collect()}  # names of tables
    found = [sides.sparkSession.createDataFrame([], "dataset string, missing bigint, extra bigint")]
    repeated = []
    for name, (left, right, keys) in pairs.items():
        per_key = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        repeated.append(per_key.agg(F.count_if(C("n") > 1).alias("duplicate_keys")).select(
            F.lit(name).alias("dataset"), "duplicate_keys"))
        if name in open_:
            rows = fingerprint.surplus(left, right, keys, left.columns, ranges.filter(C("dataset") == name).select("range"))
            found.append(parity.both_ways(name, rows))
    zero = F.lit(0).cast("bigint")
    return quality.union_rows(repeated).join(counts, "dataset", "left").join(quality.union_rows(found), "dataset", "left").select(
        "dataset", F.coalesce("missing", zero).alias("missing"), F.coalesce("extra", zero).alias("extra"),
        F.coalesce("row_count", zero).alias("row_count"), "duplicate_keys")


def history_parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bag equality of two histories with version, open and bad-interval counts of the second."""
    return parity.bag_report("history", left, right).select(
        "*",
        right.agg(F.count(F.lit(1))).scalar().alias("versions"),
        right.agg(F.count_if(C(H.END).isNull())).scalar().alias("current_versions"),
        right.agg(F.count_if(C(H.END) <= C(H.START))).scalar().alias("invalid_intervals"))


def open_history_matches(history: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Open versions against the current snapshot, as a bag: any row is a violation."""
    return parity.bag_diff(history.filter(C(H.END).isNull()), current, columns)


#: Child, parent and keys of every declared reference.
REFERENCES = tuple((name, parent, keys) for name, dataset in DATASETS.items() for parent, keys in dataset.references)


def result_invariants(teammates: DataFrame, progression: DataFrame, seasons: DataFrame) -> DataFrame:
    """``(invariant, n, violations)``: what must hold between results. One pass over each of them."""
    pairs = teammates.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(C("race_wins_a") + C("race_wins_b") != C("comparable_finishes")).alias("race"),
        F.count_if(C("qualifying_wins_a") + C("qualifying_wins_b") != C("comparable_qualifying")).alias("qualifying"))
    names = {"race": "race wins of teammates", "qualifying": "qualifying wins of teammates"}
    heads = pairs.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("invariant"), "n", C(column).alias("violations")) for column, name in names.items()])).alias("x")).select("x.*")
    ends = progression.groupBy("driver_id").agg(F.max_by("calculated_points", "round").alias("total"))
    totals = ends.join(seasons.select("driver_id", "source_points"), "driver_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(C("total") != C("source_points")).alias("violations"))
    return heads.unionByName(totals.select(F.lit("last round and source points").alias("invariant"), "n", "violations"))


def reference_report(silver: Mapping[str, DataFrame]) -> DataFrame:
    return quality.union_rows([
        quality.check_reference(silver[child], silver[parent], keys, f"{child}->{parent}")
        for child, parent, keys in REFERENCES])


def published_check(gold: Mapping[str, DataFrame], release_seq: int, history: DataFrame,
                    current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The publish gate: gold tables hold rows of this release only, and history is current."""
    report = []
    for name, frame in gold.items():
        totals = frame.agg(
            (F.count(F.lit(1)) == 0).cast("bigint").alias("empty"),
            F.count_if(~C("_release_seq").eqNullSafe(F.lit(release_seq))).alias("stale"))
        report.append(totals.select(
            F.lit(f"gold:{name}").alias("check_name"), (C("empty") + C("stale")).alias("failures")))
    report.append(quality.failures("open_history", open_history_matches(history, current, columns)))
    return quality.union_rows(report)


def source_population(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many values of each (evolved) column a release carries."""
    return raw.groupBy("release_tag").agg(
        *[F.count(F.nullif(C(f"`{c}`"), F.lit(""))).alias(c) for c in columns])


def files_per_release(raw: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Rows and source files per release, next to the manifest's row count where given."""
    # Two steps instead of COUNT(DISTINCT file): one row per file, then per release.
    per_file = raw.groupBy("release_tag", "_source_file").agg(F.count(F.lit(1)).alias("n"))
    out = per_file.groupBy("release_tag").agg(
        F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("file_count"))
    return out.join(manifest, "release_tag", "left") if manifest is not None else out
