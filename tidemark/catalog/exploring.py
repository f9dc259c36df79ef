"""Exploratory views and queries over the order tables.

Season 1998 stands for the season under study, 1998 to 2000 for the recent seasons, 2000 for the
latest one, and the customers' region ASIA for the venue.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import query, rounded
from tidemark.plans import explore as X
from tidemark.plans.retail import RESULT_EXTRAS, SEQ, Retail
from tidemark.session import stored
from tidemark.sources.tables import literal_rows

SEASON, FIRST, LAST, LATEST = 1998, 1998, 2000, 2000
VENUE = "ASIA"
AS_OF = dt.date(2000, 6, 30)


class Explore(Retail):
    """The views the queries share."""

    @cached_property
    def published(self) -> DataFrame:
        return literal_rows(self.spark, [(SEQ,)], "release_seq bigint")

    def dim(self, name: str) -> DataFrame:
        return X.stamped(getattr(self, name), SEQ)

    @cached_property
    def dim_races(self) -> DataFrame:
        venue = self.circuits.select("circuit_id", "circuit_name", "country_id", "circuit_type")
        return X.stamped(self.races.join(venue, "circuit_id"), SEQ)

    @cached_property
    def performance(self) -> DataFrame:
        return X.race_performance(self.facts, self.dim_races, self.dim("drivers"), self.dim("constructors"),
                                  self.published)

    @cached_property
    def profile(self) -> DataFrame:
        performance = X.race_performance(
            self.facts_with_extras, self.dim_races, self.dim("drivers"), self.dim("constructors"), self.published,
            [*RESULT_EXTRAS, "circuit_layout_id"])
        return X.race_profile(performance)

    @cached_property
    def recent(self) -> DataFrame:
        return X.seasons_between(Explore(self.spark, self.folder, (FIRST, LAST)).profile, FIRST, LAST)

    @cached_property
    def driver_season_rows(self) -> DataFrame:
        return X.driver_season_by_rows(self.dim("driver_standings"), self.dim("drivers"), self.facts, self.published)

    @cached_property
    def constructor_season_rows(self) -> DataFrame:
        return X.constructor_season_by_rows(self.dim("constructor_standings"), self.dim("constructors"), self.facts,
                                            self.published)


_SEASON_DOUBLES = """source_points::DOUBLE AS source_points, calculated_points::DOUBLE AS calculated_points,
    points_difference::DOUBLE AS points_difference"""
_RECENT = f"(SELECT * FROM t_profile WHERE season BETWEEN {FIRST} AND {LAST})"
_SCORED = "started AND points > 0"
_COMPARABLE = "started AND finished AND grid_position > 0"


def _pct(part: str, whole: str) -> str:
    return rounded(f"100.0 * ({part})::DOUBLE / nullif({whole}, 0)", 1)


@query("X0a", f"""
    SELECT 'driver' AS kind, season, count(*) AS n, sum(points)::DOUBLE AS points, {SEQ}::BIGINT AS _release_seq
    FROM t_driver_standings GROUP BY 2
    UNION ALL
    SELECT 'constructor', season, count(*), sum(points)::DOUBLE, {SEQ} FROM t_constructor_standings GROUP BY 2
    UNION ALL
    SELECT 'fact', season, count(*), sum(points)::DOUBLE, {SEQ} FROM t_facts GROUP BY 2
    UNION ALL
    SELECT 'race', season, count(*), NULL, {SEQ} FROM t_race_dimension GROUP BY 2""")
def earlier_gold_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Release-stamped copies of standings, races and facts without names, summed per season."""
    e = Explore(spark, folder)

    def per_season(kind: str, frame: DataFrame, points) -> DataFrame:
        return frame.groupBy("season", "_release_seq").agg(
            F.count(F.lit(1)).alias("n"), F.sum(points).cast("double").alias("points")).select(
            F.lit(kind).alias("kind"), "season", "n", "points", "_release_seq")

    return (
        per_season("driver", e.dim("driver_standings"), F.col("points"))
        .unionByName(per_season("constructor", e.dim("constructor_standings"), F.col("points")))
        .unionByName(per_season("fact", e.facts_from_union, F.col("points")))
        .unionByName(per_season("race", e.dim_races, F.lit(None).cast("double"))))


@query("X0b A2 P7", f"""
    SELECT * REPLACE ({_SEASON_DOUBLES}, race_points::DOUBLE AS race_points, sprint_points::DOUBLE AS sprint_points)
    FROM t_driver_season_rows""")
def driver_season_by_rows(spark: SparkSession, folder: str) -> DataFrame:
    return Explore(spark, folder).driver_season_rows


@query("X0c A4 P7", f"SELECT * REPLACE ({_SEASON_DOUBLES}) FROM t_constructor_season_rows")
def constructor_season_by_rows(spark: SparkSession, folder: str) -> DataFrame:
    return Explore(spark, folder).constructor_season_rows


@query("X0d J11", """
    SELECT f._release_seq, f.season, f.round, f.race_id, race_name, race_date, circuit_name, r.country_id, circuit_type,
           session_type, driver_id, driver_name, constructor_id, constructor_name, car_number, grid_position,
           grid_status, finish_position, finish_status, points::DOUBLE AS points, completed_laps, retirement_reason,
           positions_gained, is_race_win, is_race_podium, has_points
    FROM t_session_results f JOIN t_race_dimension r USING (race_id)""")
def race_performance(spark: SparkSession, folder: str) -> DataFrame:
    return Explore(spark, folder).performance


@query("X0e W5", f"""
    SELECT {SEQ}::BIGINT AS _release_seq, w.season, w.round, w.race_id, race_date, w.driver_id, driver_name,
           weekend::DOUBLE AS weekend_points,
           sum(weekend) OVER (PARTITION BY w.season, w.driver_id ORDER BY w.round, w.race_id
                              ROWS UNBOUNDED PRECEDING)::DOUBLE AS cumulative_calculated_points
    FROM (SELECT season, round, race_id, driver_id, sum(points) AS weekend FROM t_facts GROUP BY ALL) w
    JOIN t_drivers USING (driver_id) JOIN t_race_dimension r USING (race_id)""")
def season_progression(spark: SparkSession, folder: str) -> DataFrame:
    e = Explore(spark, folder)
    return X.season_progression(e.facts, e.dim_races, e.dim("drivers"), e.published)


@query("X0f P10 P14 J2", """
    SELECT race_id, driver_id, car_number, season, qualifying_position, pit_stops, gap_ms, circuit_layout_id,
           finished, started FROM t_profile""")
def race_profile(spark: SparkSession, folder: str) -> DataFrame:
    return Explore(spark, folder).profile.select(
        "race_id", "driver_id", "car_number", "season", "qualifying_position", "pit_stops", "gap_ms",
        "circuit_layout_id", "finished", "started")


@query("X1 A6 P15", f"""
    SELECT season, count(*) AS race_entries, count(DISTINCT race_id) AS races, min(race_date) AS first_race,
           max(race_date) AS last_race, count(*) FILTER (race_date > DATE '{AS_OF}') AS future_dated_entries,
           count(qualifying_position) AS with_qualifying_position, count(pit_stops) AS with_pit_stop_count,
           count(gap_ms) AS with_gap_ms, count(*) FILTER (finished) AS finishers,
           count(*) FILTER (NOT started) AS non_starters
    FROM t_profile GROUP BY season""")
def explore_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return X.coverage(Explore(spark, folder).profile, AS_OF).orderBy("season")


@query("X2 A8", f"""
    SELECT finish_status, retirement_reason, finished, started, count(*) AS entries FROM {_RECENT} GROUP BY ALL""")
def explore_statuses(spark: SparkSession, folder: str) -> DataFrame:
    return X.status_breakdown(Explore(spark, folder).recent).orderBy(F.col("entries").desc())


@query("X3 A6 P12", f"""
    SELECT s.driver_name, source_position, source_points::DOUBLE AS source_points, race_points::DOUBLE AS race_points,
           sprint_points::DOUBLE AS sprint_points, race_wins, race_podiums,
           points_difference::DOUBLE AS points_difference, starts, finishes, scoring_races,
           {_pct("scoring_races", "starts")} AS scoring_pct, mean_finish_when_finished
    FROM t_driver_season_rows s
    JOIN (SELECT driver_id, count(*) FILTER (started) AS starts, count(*) FILTER (started AND finished) AS finishes,
                 count(*) FILTER ({_SCORED}) AS scoring_races,
                 {rounded("avg(finish_position) FILTER (finished AND started)", 2)} AS mean_finish_when_finished
          FROM t_profile WHERE season = {SEASON} GROUP BY 1) USING (driver_id)
    WHERE season = {SEASON}""")
def explore_driver_season(spark: SparkSession, folder: str) -> DataFrame:
    e = Explore(spark, folder)
    return X.driver_season_rates(e.driver_season_rows, e.profile, SEASON).orderBy("source_position", "driver_name")


@query("X4 W3", f"""
    SELECT season, constructor_id, constructor_name, driver_id, driver_name, earned::DOUBLE AS earned_points,
           race_entries, {rounded("100.0 * earned::DOUBLE / nullif(team, 0)::DOUBLE", 1)} AS share_of_earned_team_points
    FROM (SELECT *, sum(earned) OVER (PARTITION BY season, constructor_id) AS team
          FROM (SELECT season, constructor_id, constructor_name, driver_id, driver_name, sum(points) AS earned,
                       count(*) FILTER (session_type = 'RACE') AS race_entries
                FROM t_session_results WHERE season BETWEEN {FIRST} AND {LAST} GROUP BY ALL))""")
def explore_team_contribution(spark: SparkSession, folder: str) -> DataFrame:
    shares = X.team_contribution(Explore(spark, folder).performance, FIRST, LAST)
    return shares.orderBy(F.col("season").desc(), "constructor_name", F.col("earned_points").desc(), "driver_id")


@query("X5 A5 A6", f"""
    SELECT season, constructor_name, count(*) AS weekends, count(*) FILTER (two) AS two_start_weekends,
           count(*) FILTER (two AND fin = 2) AS both_finished, count(*) FILTER (two AND sco = 2) AS both_scored,
           {_pct("count(*) FILTER (two AND sco = 2)", "count(*) FILTER (two)")} AS double_score_pct
    FROM (SELECT season, race_id, constructor_name, count(*) = 2 AND count(*) FILTER (started) = 2 AS two,
                 count(*) FILTER (started AND finished) AS fin, count(*) FILTER ({_SCORED}) AS sco
          FROM {_RECENT} GROUP BY 1, 2, 3)
    GROUP BY 1, 2""")
def explore_team_consistency(spark: SparkSession, folder: str) -> DataFrame:
    return X.team_consistency(Explore(spark, folder).recent).orderBy(
        F.col("season").desc(), F.col("double_score_pct").desc())


TEAMMATES_SQL = f"""
    SELECT season, constructor_name, driver_a, driver_b, count(*) AS paired_entries,
           count(*) FILTER (st) AS both_started, count(*) FILTER (fi) AS comparable_finishes,
           count(*) FILTER (fi AND fa < fb) AS race_wins_a, count(*) FILTER (fi AND fa > fb) AS race_wins_b,
           count(qa + qb) AS comparable_qualifying,
           count(*) FILTER (qa < qb) AS qualifying_wins_a, count(*) FILTER (qa > qb) AS qualifying_wins_b
    FROM (SELECT x.season, x.constructor_name, x.driver_name AS driver_a, y.driver_name AS driver_b,
                 x.started AND y.started AS st, x.started AND y.started AND x.finished AND y.finished AS fi,
                 x.finish_position AS fa, y.finish_position AS fb,
                 x.qualifying_position AS qa, y.qualifying_position AS qb
          FROM {_RECENT} x, {_RECENT} y
          WHERE x.race_id = y.race_id AND x.constructor_id = y.constructor_id AND y.driver_id > x.driver_id)
    GROUP BY 1, 2, 3, 4"""


@query("X6 J7 A6", TEAMMATES_SQL)
def explore_teammates(spark: SparkSession, folder: str) -> DataFrame:
    return X.teammate_comparison(Explore(spark, folder).recent).orderBy(
        F.col("season").desc(), "constructor_name", F.col("paired_entries").desc())


@query("X7 W4 P8", f"""
    SELECT season, driver_name, period, count(*) FILTER (started) AS starts, sum(points)::DOUBLE AS race_points,
           {rounded("sum(points)::DOUBLE / nullif(count(*) FILTER (started), 0)", 2)} AS race_points_per_start,
           {_pct(f"count(*) FILTER ({_SCORED})", "count(*) FILTER (started)")} AS scoring_pct
    FROM (SELECT p.*, CASE WHEN round > last - 5 THEN 'Last 5 rounds' ELSE 'Earlier rounds' END AS period
          FROM {_RECENT} p JOIN (SELECT season, max(round) AS last FROM t_profile GROUP BY 1) USING (season))
    GROUP BY 1, 2, 3""")
def explore_recent_form(spark: SparkSession, folder: str) -> DataFrame:
    return X.recent_form(Explore(spark, folder).recent).orderBy(F.col("season").desc(), "driver_name", "period")


@query("X8 A6 A12", f"""
    SELECT circuit_name, circuit_type, count(DISTINCT race_id) AS races, count(*) FILTER (started) AS starts,
           count(*) FILTER (started AND NOT finished) AS non_finishes,
           {_pct("count(*) FILTER (started AND NOT finished)", "count(*) FILTER (started)")} AS non_finish_pct,
           count(*) FILTER (started AND grid_position = 1) AS p1_starts,
           count(*) FILTER (started AND grid_position = 1 AND finish_position = 1) AS p1_wins,
           count(*) FILTER ({_COMPARABLE}) AS valid_position_changes,
           {rounded(f"avg(grid_position - finish_position) FILTER ({_COMPARABLE})", 2)} AS mean_net_gain_finishers
    FROM {_RECENT} GROUP BY 1, 2""")
def explore_circuits(spark: SparkSession, folder: str) -> DataFrame:
    return X.circuit_profiles(Explore(spark, folder).recent).orderBy("circuit_name")


@query("X9 A14", f"""
    SELECT season, race_id, race_date, circuit_layout_id, max(driver_name) FILTER (finish_position = 1) AS winner,
           max(grid_position) FILTER (finish_position = 1) AS winner_grid, count(*) FILTER (started) AS starts,
           count(*) FILTER (started AND NOT finished) AS non_finishes,
           count(*) FILTER ({_COMPARABLE}) AS valid_position_changes,
           {rounded(f"avg(grid_position - finish_position) FILTER ({_COMPARABLE})", 2)} AS mean_net_gain_finishers
    FROM t_profile WHERE country_id = '{VENUE}' AND season <= {LAST} GROUP BY 1, 2, 3, 4""")
def explore_venue_history(spark: SparkSession, folder: str) -> DataFrame:
    return X.venue_history(Explore(spark, folder).profile, VENUE, LAST).orderBy("season", "race_id")


@query("X10 U2 Q9", """
    SELECT 'driver' AS entity_type, season, driver_id AS entity_id, source_points::DOUBLE AS source_points,
           calculated_points::DOUBLE AS calculated_points, points_difference::DOUBLE AS points_difference
    FROM t_driver_season_rows WHERE points_difference <> 0
    UNION ALL
    SELECT 'constructor', season, constructor_id, source_points::DOUBLE, calculated_points::DOUBLE,
           points_difference::DOUBLE
    FROM t_constructor_season_rows WHERE points_difference <> 0""")
def explore_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    e = Explore(spark, folder)
    return X.points_reconciliation(e.driver_season_rows, e.constructor_season_rows).orderBy(
        "season", "entity_type", "entity_id")


PROGRESSION_SQL = f"""
    WITH rounds AS (SELECT round, min(race_id) AS race_id FROM t_facts
                    WHERE season = {SEASON} AND session_type = 'RACE' GROUP BY 1),
    entrants AS (SELECT driver_id, driver_name FROM t_driver_season_rows WHERE season = {SEASON}),
    earned AS (SELECT round, driver_id, sum(points) AS p FROM t_facts WHERE season = {SEASON} GROUP BY 1, 2),
    dense AS (SELECT r.round, r.race_id, e.driver_id, e.driver_name, ifnull(p, 0) AS p,
                     sum(ifnull(p, 0)) OVER (PARTITION BY e.driver_id ORDER BY r.round) AS total
              FROM rounds r CROSS JOIN entrants e
              LEFT JOIN earned w ON w.round = r.round AND w.driver_id = e.driver_id)
    SELECT {SEASON}::BIGINT AS season, round, race_id, driver_id, driver_name, p::DOUBLE AS weekend_points,
           total::DOUBLE AS calculated_points,
           (max(total) OVER (PARTITION BY round) - total)::DOUBLE AS gap_to_calculated_leader
    FROM dense"""


@query("X11 J8 W6 W7", PROGRESSION_SQL)
def explore_progression(spark: SparkSession, folder: str) -> DataFrame:
    e = Explore(spark, folder)
    return X.points_progression(e.facts, e.driver_season_rows, SEASON).orderBy(
        "round", F.col("calculated_points").desc(), "driver_id")


@query("X12 A9 A11", """
    SELECT season, constructor_id, count(*) AS categories,
           string_agg(entry_category, ', ' ORDER BY entry_category) AS category_list
    FROM t_constructor_standings GROUP BY 1, 2 HAVING count(*) > 1""")
def explore_join_risks(spark: SparkSession, folder: str) -> DataFrame:
    return X.multi_category_entries(Explore(spark, folder).constructor_standings).orderBy("season", "constructor_id")


@query("X13 A10", f"""
    SELECT driver_name, count(*) FILTER (started) AS starts, count(*) FILTER ({_COMPARABLE}) AS comparable_finishes,
           {rounded(f"avg(grid_position - finish_position) FILTER ({_COMPARABLE})", 2)} AS mean_net_gain,
           median(grid_position - finish_position) FILTER ({_COMPARABLE}) AS median_net_gain,
           count(*) FILTER (started AND NOT finished) AS non_finishes,
           count(*) FILTER (ifnull(grid_position, 0) <= 0) AS missing_or_special_grid
    FROM t_profile WHERE season = {SEASON} GROUP BY 1""")
def explore_positions_gained(spark: SparkSession, folder: str) -> DataFrame:
    return X.positions_gained(Explore(spark, folder).recent, SEASON).orderBy(F.col("mean_net_gain").desc())


@query("X14 A1 J2", f"""
    SELECT r.season, r.driver_name, r.constructor_name, r.grid_position, r.finish_position, r.finish_status,
           r.retirement_reason, r.points::DOUBLE AS venue_points, other_races,
           {rounded("mean_other", 2)} AS mean_other_race_points,
           {rounded("r.points::DOUBLE - mean_other", 2)} AS difference_from_other_races
    FROM {_RECENT} r
    JOIN (SELECT season, driver_id, sum(points)::DOUBLE / count(*) AS mean_other, count(*) AS other_races
          FROM {_RECENT} WHERE started AND country_id <> '{VENUE}' GROUP BY 1, 2) USING (season, driver_id)
    WHERE r.country_id = '{VENUE}' AND r.started""")
def explore_venue_context(spark: SparkSession, folder: str) -> DataFrame:
    return X.venue_against_season(stored(Explore(spark, folder).recent, "recent"), VENUE).orderBy(
        F.col("season").desc(), F.col("difference_from_other_races").desc())


def _missing(child: str, parent: str, keys: str, where: str = "true") -> str:
    match = " AND ".join(f"p.{k} = c.{k}" for k in keys.split())
    return f"SELECT count(*) FROM {child} c WHERE {where} AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {match})"


_RACE, _SPRINT = "c.session_type = 'RACE'", "c.session_type = 'SPRINT'"
_QUALITY = {
    "race_profile_join_row_delta":
        "SELECT (SELECT count(*) FROM t_profile) - (SELECT count(*) FROM t_lines WHERE session_type = 'RACE')",
    "race_profile_duplicate_grain":
        "SELECT count(*) FROM (SELECT 1 FROM t_profile GROUP BY race_id, driver_id, car_number HAVING count(*) > 1)",
    "circuits_missing_for_races": _missing("t_races", "t_circuits", "circuit_id"),
    "drivers_missing_for_race_results": _missing("t_lines", "t_drivers", "driver_id", _RACE),
    "constructors_missing_for_race_results": _missing("t_lines", "t_constructors", "constructor_id", _RACE),
    "races_missing_for_race_results": _missing("t_lines", "t_races", "race_id season round", _RACE),
    "drivers_missing_for_sprint_results": _missing("t_lines", "t_drivers", "driver_id", _SPRINT),
    "constructors_missing_for_sprint_results": _missing("t_lines", "t_constructors", "constructor_id", _SPRINT),
    "races_missing_for_sprint_results": _missing("t_lines", "t_races", "race_id season round", _SPRINT),
    "drivers_missing_for_standings": _missing("t_driver_standings", "t_drivers", "driver_id"),
    "constructors_missing_for_standings": _missing("t_constructor_standings", "t_constructors", "constructor_id"),
    "more_than_two_recent_team_entries":
        f"SELECT count(*) FROM (SELECT 1 FROM {_RECENT} GROUP BY race_id, constructor_id HAVING count(*) > 2)",
    "future_dated_results": f"SELECT count(*) FROM t_profile WHERE race_date > DATE '{AS_OF}'",
    "non_finishers_with_points_recent": f"SELECT count(*) FROM {_RECENT} WHERE NOT finished AND points > 0",
    f"driver_points_mismatches_{FIRST}_{LAST}":
        f"SELECT count(*) FROM t_driver_season_rows WHERE season BETWEEN {FIRST} AND {LAST} AND points_difference <> 0",
    f"constructor_points_mismatches_{FIRST}_{LAST}":
        "SELECT count(*) FROM t_constructor_season_rows "
        f"WHERE season BETWEEN {FIRST} AND {LAST} AND points_difference <> 0",
    "missing_recent_race_results": _missing(
        "t_races", "(SELECT race_id FROM t_lines WHERE session_type = 'RACE')", "race_id",
        f"c.season BETWEEN {FIRST} AND {LAST}"),
}


@query("X15 J4 U2 J9", " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, ({sql})::BIGINT AS failures" for name, sql in _QUALITY.items()))
def explore_quality(spark: SparkSession, folder: str) -> DataFrame:
    e = Explore(spark, folder)
    # Several checks read these; only the columns they need are stored.
    profile = stored(e.profile.select("race_id", "driver_id", "constructor_id", "car_number", "season", "race_date",
                                      "finished", "points"), "profile")
    references = ["race_id", "season", "round", "driver_id", "constructor_id"]
    tables = {**e.silver, "race_results": stored(e.race_results.select(*references), "race_results"),
              "sprint_results": stored(e.sprint_results.select(*references), "sprint_results")}
    return X.quality_report(tables, profile, X.seasons_between(profile, FIRST, LAST), e.driver_season_rows,
                            e.constructor_season_rows, AS_OF, FIRST, LAST)


@query("X16 J9 P17", f"""
    WITH newest AS (SELECT max(round) AS last_round FROM t_facts WHERE season = {LATEST}),
    last AS (SELECT constructor_id, last_round, sum(points) AS p FROM t_facts, newest
             WHERE season = {LATEST} AND round = last_round GROUP BY 1, 2)
    SELECT constructor_name, source_points::DOUBLE AS source_points, calculated_points::DOUBLE AS calculated_points,
           points_difference::DOUBLE AS points_difference, last_round, p::DOUBLE AS last_weekend_points,
           (calculated_points - p)::DOUBLE AS points_before_last_weekend,
           points_difference = p AS difference_matches_last_weekend
    FROM t_constructor_season_rows JOIN last USING (constructor_id) WHERE season = {LATEST}""")
def explore_latest_points(spark: SparkSession, folder: str) -> DataFrame:
    e = Explore(spark, folder)
    return X.latest_points_diagnostic(e.facts, e.constructor_season_rows, LATEST)


@query("X17 P8", f"""
    SELECT season, CASE WHEN NOT started THEN 'Non-start (source-derived)' WHEN finish_status = 'DSQ' THEN 'Disqualified'
                        WHEN finished THEN 'Finished without retirement'
                        WHEN retirement_reason = 'Collision' THEN 'Incident-related retirement'
                        WHEN retirement_reason IN ('Engine', 'Gearbox') THEN 'Mechanical-labelled retirement'
                        ELSE 'Other / unclassified retirement' END AS outcome_group, count(*) AS entries
    FROM {_RECENT} GROUP BY 1, 2""")
def explore_retirements(spark: SparkSession, folder: str) -> DataFrame:
    return X.retirement_breakdown(Explore(spark, folder).recent).orderBy("season", "outcome_group")


@query("X18 O3", f"""
    SELECT season, round, race_name, driver_name, constructor_name, grid_position, finish_position, finish_status,
           retirement_reason, points::DOUBLE AS points
    FROM t_profile WHERE season = {SEASON} ORDER BY round, driver_id, race_id, car_number, t_profile.points LIMIT 5""")
def explore_preview(spark: SparkSession, folder: str) -> DataFrame:
    return X.source_preview(Explore(spark, folder).profile, SEASON)
