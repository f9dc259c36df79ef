"""The four analytical tables.

Each function takes frames and returns a frame; writing and checking are the caller's. Facts are
pre-aggregated on their own keys before any join, so a hot driver, race or team leaves the map side
as partial sums.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import results as R
from tidemark.functions.measures import count_where, flag, known, zero_fill
from tidemark.operators import quality
from tidemark.plans.schema import GOLD_KEYS

FACT_COLUMNS = [
    "race_id", "season", "round", "driver_id", "constructor_id", "engine_manufacturer_id", "car_number",
    "grid_position", "grid_status", "finish_position", "finish_status", "points", "completed_laps",
    "retirement_reason",
]


def race_dimension(races: DataFrame, circuits: DataFrame, release_seq: int) -> DataFrame:
    venue = circuits.select("circuit_id", "circuit_name", "country_id", "circuit_type")
    return races.join(venue, "circuit_id").select(
        "race_id", "season", "round", "race_date", "race_name", "grand_prix_id", "circuit_id",
        "circuit_name", "country_id", "circuit_type",
        F.lit(release_seq).cast("bigint").alias("_release_seq"))


def tag_sessions(race_results: DataFrame, sprint_results: DataFrame, extras: Sequence[str] = ()) -> DataFrame:
    """Both result tables as one, told apart by ``session_type``."""
    def one(frame: DataFrame, session: str) -> DataFrame:
        return frame.select(*FACT_COLUMNS, F.lit(session).alias("session_type"), *extras)

    return one(race_results, R.RACE).unionByName(one(sprint_results, R.SPRINT))


def session_facts(sessions: DataFrame, release_seq: int, extras: Sequence[str] = ()) -> DataFrame:
    """Result flags at the grain of one classified row, before any name is joined.

    ``extras`` carries further columns of the result row along.
    """
    session, finish = F.col("session_type"), F.col("finish_position")
    return sessions.select(
        "race_id", "season", "round", "session_type", "driver_id", "constructor_id",
        "engine_manufacturer_id", "car_number", "grid_position", "grid_status", "finish_position",
        "finish_status",
        zero_fill(F.col("points")).cast(sessions.schema["points"].dataType).alias("points"),
        "completed_laps", "retirement_reason",
        R.race_win(session, finish).alias("is_race_win"),
        R.race_podium(session, finish).alias("is_race_podium"),
        known(F.col("points") > 0).alias("has_points"),  # the raw points, before the zero fill
        R.positions_gained(F.col("grid_position"), finish, F.col("retirement_reason")).alias("positions_gained"),
        F.lit(release_seq).cast("bigint").alias("_release_seq"),
        *extras,
    )


def session_results(facts: DataFrame, drivers: DataFrame, constructors: DataFrame | None = None) -> DataFrame:
    """Facts with the current driver and team names; without ``constructors``, the facts have the team's already."""
    named = facts.join(drivers.select("driver_id", "driver_name"), "driver_id")
    if constructors is not None:
        named = named.join(constructors.select("constructor_id", "constructor_name"), "constructor_id")
    return named.select(*[c for c in facts.columns if c != "constructor_name"], "driver_name", "constructor_name")


def driver_race_rows(facts: DataFrame, *keys: str) -> DataFrame:
    """Facts folded to one row per (keys, race, session): what distinct-race counts need.

    Wins and podiums only occur in race sessions, so adding these flags up counts each race once
    however many cars a driver used. Nothing is expanded, as several COUNT(DISTINCT CASE ...) would.
    """
    return facts.groupBy(*keys, "race_id", "session_type").agg(
        F.sum("points").alias("points"),
        F.max("is_race_win").alias("won"),
        F.max("is_race_podium").alias("on_podium"),
    )


def _of_session(session: str) -> Column:
    return F.sum(F.when(F.col("session_type") == session, F.col("points")).otherwise(F.lit(0)))


def driver_season(driver_standings: DataFrame, drivers: DataFrame, facts: DataFrame, release_seq: int) -> DataFrame:
    """Source standings next to totals computed from results, with their difference."""
    computed = driver_race_rows(facts, "season", "driver_id").groupBy("season", "driver_id").agg(
        F.sum("points").alias("calculated_points"),
        _of_session(R.RACE).alias("race_points"),
        _of_session(R.SPRINT).alias("sprint_points"),
        count_where(R.is_race(F.col("session_type"))).alias("race_entries"),
        count_where(F.col("won")).alias("race_wins"),
        count_where(F.col("on_podium")).alias("race_podiums"),
    )
    # Totals first: both sides of that join are partitioned by its key already.
    named = driver_standings.join(computed, ["season", "driver_id"], "left").join(
        drivers.select("driver_id", "driver_name", "nationality_country_id"), "driver_id")
    calculated = zero_fill(F.col("calculated_points"))
    return named.select(
        F.lit(release_seq).cast("bigint").alias("_release_seq"),
        "season", "driver_id", "driver_name", "nationality_country_id",
        F.col("standing").alias("source_position"), "standing_status",
        F.col("points").alias("source_points"), "championship_won",
        calculated.alias("calculated_points"),
        (calculated - F.col("points")).alias("points_difference"),
        *[zero_fill(F.col(c)).alias(c) for c in
          ("race_points", "sprint_points", "race_entries", "race_wins", "race_podiums")],
    )


def car_rows(facts: DataFrame, *keys: str) -> DataFrame:
    """Facts folded to one row per car of a race: a shared car counts once for its team."""
    return facts.groupBy(*keys, "race_id", "session_type", "car_number").agg(
        F.sum("points").alias("points"),
        F.max(flag(F.col("is_race_win"))).alias("won"),
        F.max(flag(F.col("is_race_podium"))).alias("on_podium"),
    )


def preferred_standings(constructor_standings: DataFrame) -> DataFrame:
    """RANKED entries, and another entry only where its key has no RANKED one.

    The table's key bounds a window partition to one row per entry category, and the partitioning
    is the one the join with the computed totals needs.
    """
    same_entry = Window.partitionBy("season", "constructor_id", "engine_manufacturer_id")
    is_ranked = known(F.col("entry_category") == "RANKED")
    return (
        constructor_standings.withColumn("_any_ranked", F.max(is_ranked).over(same_entry))
        .filter(is_ranked | ~F.col("_any_ranked"))
        .drop("_any_ranked")
    )


def constructor_season(constructor_standings: DataFrame, constructors: DataFrame, facts: DataFrame,
                       release_seq: int) -> DataFrame:
    """One row per team, engine and season; wins and podiums counted once per car."""
    grain = ["season", "constructor_id", "engine_manufacturer_id"]
    raced = R.is_race(F.col("session_type"))
    cars = car_rows(facts, *grain)
    total = cars.agg(F.sum("points")).schema[0].dataType
    # Cars, then races, then seasons: facts that are dealt by race stay where they are until the last step.
    races = cars.groupBy(*grain, "race_id").agg(
        F.sum("points").alias("points"), F.sum(flag(raced)).alias("cars"),
        F.sum("won").alias("won"), F.sum("on_podium").alias("on_podium"))
    computed = races.groupBy(*grain).agg(
        F.sum("points").cast(total).alias("calculated_points"),
        count_where(F.col("race_id").isNotNull() & (F.col("cars") > 0)).alias("race_weekends"),
        F.sum("cars").alias("race_car_entries"),
        F.sum("won").alias("race_wins"),
        F.sum("on_podium").alias("race_podiums"),
    )
    named = preferred_standings(constructor_standings).join(computed, grain, "left").join(
        constructors.select("constructor_id", "constructor_name", "country_id"), "constructor_id")
    calculated = zero_fill(F.col("calculated_points"))
    return named.select(
        F.lit(release_seq).cast("bigint").alias("_release_seq"),
        "season", "constructor_id", "constructor_name", "country_id", "engine_manufacturer_id",
        "entry_category", F.col("standing").alias("source_position"), "standing_status",
        F.col("points").alias("source_points"), "championship_won",
        calculated.alias("calculated_points"),
        (calculated - F.col("points")).alias("points_difference"),
        *[zero_fill(F.col(c)).alias(c) for c in
          ("race_weekends", "race_car_entries", "race_wins", "race_podiums")],
    )


def build_gold(silver: Mapping[str, DataFrame], release_seq: int,
               keep: Callable[[str, DataFrame], DataFrame] = lambda _name, frame: frame) -> dict[str, DataFrame]:
    """All four tables. ``keep`` may store each one; the season tables then read stored results."""
    facts = session_facts(tag_sessions(silver["race_results"], silver["sprint_results"]), release_seq)
    return gold_of(silver, session_results(facts, silver["drivers"], silver["constructors"]), release_seq, keep)


def gold_of(silver: Mapping[str, DataFrame], named: DataFrame, release_seq: int,
            keep: Callable[[str, DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """All four tables, from session results with their names."""
    results = keep("session_results", named)
    # Dealt once by a team's race, which is as many rows as its cars, and folded there by car and by race.
    by_race = results.repartition("season", "constructor_id", "engine_manufacturer_id", "race_id")
    return {
        "race_dimension": keep("race_dimension", race_dimension(silver["races"], silver["circuits"], release_seq)),
        "session_results": results,
        "driver_season": keep("driver_season", driver_season(
            silver["driver_standings"], silver["drivers"], results, release_seq)),
        "constructor_season": keep("constructor_season", constructor_season(
            silver["constructor_standings"], silver["constructors"], by_race, release_seq)),
    }


# Checks of each table against the rows that drive it.
GOLD_REQUIRED = {
    "race_dimension": ("race_id", "season", "round"),
    "session_results": ("race_id", "session_type", "driver_id", "constructor_id",
                        "engine_manufacturer_id", "car_number", "driver_name", "constructor_name"),
    "driver_season": ("season", "driver_id", "source_points"),
    "constructor_season": ("season", "constructor_id", "engine_manufacturer_id", "source_points"),
}


def table_checks(name: str, output: DataFrame, *driving: DataFrame) -> DataFrame:
    """What a table must meet as a whole, besides its required columns."""
    report = [quality.unique_check(output, GOLD_KEYS[name]), quality.check_join_preserved(output, *driving)]
    if name == "session_results":
        report.append(quality.check_measure(output, "points"))
    return quality.union_rows(report)


def unreconciled(season_table: DataFrame) -> DataFrame:
    """Rows whose computed total differs from the source total."""
    return season_table.filter(F.col("points_difference") != 0)
