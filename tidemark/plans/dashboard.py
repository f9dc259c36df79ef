"""Serving datasets on the analytical tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import results as R
from tidemark.functions import text as T
from tidemark.functions.measures import count_where, flag, known, zero_fill
from tidemark.operators.ranking import global_rank, top_k


def driver_standings_view(driver_season: DataFrame) -> DataFrame:
    position = F.col("source_position")
    return driver_season.select(
        "season", "driver_id", "driver_name", "nationality_country_id",
        T.position_label(position, F.col("standing_status")).alias("position_label"),
        "source_position", T.order_key(position).alias("standing_order"), "standing_status",
        "source_points", "calculated_points", "points_difference", "race_points", "sprint_points",
        "race_entries", "race_wins", "race_podiums",
    )


def constructor_standings_view(constructor_season: DataFrame) -> DataFrame:
    """Annual team standings; a team with several engines in a season is labelled with each.

    The table's key leaves a team of a season one row per engine, which bounds the window.
    """
    position = F.col("source_position")
    team = Window.partitionBy("season", "constructor_id")
    counted = constructor_season.withColumn("_entries", F.count(F.lit(1)).over(team))
    return counted.select(
        "season", "constructor_id", "constructor_name", "country_id", "engine_manufacturer_id",
        T.position_label(position, F.col("standing_status")).alias("position_label"),
        T.shared_label(F.col("constructor_name"), F.col("engine_manufacturer_id"),
                       F.col("_entries") > 1).alias("team_entry"),
        "source_position", T.order_key(position).alias("standing_order"), "standing_status",
        "source_points", "calculated_points", "points_difference", "race_weekends",
        "race_car_entries", "race_wins", "race_podiums",
    )


def standings_order(name: str) -> list[Column]:
    """Display order of both standings views: latest season first, unplaced entries last."""
    return [F.col("season").desc(), F.col("source_position").asc_nulls_last(), F.col(name)]


def _titles(seasons: DataFrame, key: str) -> DataFrame:
    return seasons.groupBy(key).agg(F.sum(flag(F.col("championship_won"))).alias("championships"))


def driver_career(facts: DataFrame, seasons: DataFrame, drivers: DataFrame) -> DataFrame:
    """Career totals from race facts, since annual standings leave out some participants.

    Names join after the aggregation, one row per driver.
    """
    raced = facts.filter(R.is_race(F.col("session_type")))
    per_race = raced.groupBy("driver_id", "race_id").agg(
        F.min("season").alias("season"), F.max("is_race_win").alias("won"), F.max("is_race_podium").alias("on_podium"))
    totals = per_race.groupBy("driver_id").agg(
        F.min("season").alias("first_season"), F.max("season").alias("last_season"),
        F.count(F.lit(1)).alias("race_entries"), count_where(F.col("won")).alias("race_wins"),
        count_where(F.col("on_podium")).alias("race_podiums"))
    return (
        totals.join(drivers.select("driver_id", "driver_name"), "driver_id")
        .join(_titles(seasons, "driver_id"), "driver_id", "left")
        .select("driver_id", "driver_name", "first_season", "last_season", "race_entries",
                "race_wins", "race_podiums", zero_fill(F.col("championships")).alias("championships"))
    )


def constructor_career(facts: DataFrame, seasons: DataFrame, constructors: DataFrame) -> DataFrame:
    """Career totals of teams: cars first, then races, then the team."""
    raced = facts.filter(R.is_race(F.col("session_type")))
    cars = raced.groupBy("constructor_id", "race_id", "car_number").agg(
        F.min("season").alias("season"),
        F.max("is_race_win").alias("won"), F.max("is_race_podium").alias("on_podium"))
    per_race = cars.groupBy("constructor_id", "race_id").agg(
        F.min("season").alias("s0"), F.max("season").alias("s1"),
        count_where(F.col("won")).alias("won"), count_where(F.col("on_podium")).alias("on_podium"))
    totals = per_race.groupBy("constructor_id").agg(
        F.min("s0").alias("first_season"), F.max("s1").alias("last_season"),
        F.count(F.lit(1)).alias("race_weekends"),
        F.sum("won").alias("race_wins"), F.sum("on_podium").alias("race_podiums"))
    return (
        totals.join(constructors.select("constructor_id", "constructor_name"), "constructor_id")
        .join(_titles(seasons, "constructor_id"), "constructor_id", "left")
        .select("constructor_id", "constructor_name", "first_season", "last_season", "race_weekends",
                "race_wins", "race_podiums", zero_fill(F.col("championships")).alias("championships"))
    )


def rank_orders(key: str) -> dict[str, list[Column]]:
    def by(first: str, second: str) -> list[Column]:
        return [F.col(first).desc(), F.col(second).desc(), F.col(key)]

    return {
        "titles_rank": by("championships", "race_wins"),
        "wins_rank": by("race_wins", "race_podiums"),
        "podiums_rank": by("race_podiums", "race_wins"),
    }


def with_career_ranks(career: DataFrame, key: str) -> DataFrame:
    """The three independent ranks over all rows. Only the key and the order columns are sorted and checkpointed."""
    for name, order in rank_orders(key).items():
        narrow = career.select(key, "championships", "race_wins", "race_podiums")
        career = career.join(global_rank(narrow, name, order).select(key, name), key)
    return career


def race_results_view(session_results: DataFrame, race_dimension: DataFrame) -> DataFrame:
    """Every classified row with its race; a row without a race stays, with nulls."""
    race = race_dimension.select(
        F.col("_release_seq").alias("_race_release"), F.col("race_id").alias("_race"), "grand_prix_id",
        "race_name", "race_date", "circuit_id", "circuit_name", "country_id")
    joined = session_results.join(
        race, (F.col("race_id") == F.col("_race")) & (F.col("_release_seq") == F.col("_race_release")), "left")
    finish = F.col("finish_position")
    return joined.select(
        "_release_seq", "season", "round", "race_id",
        T.round_label(F.col("round"), F.col("grand_prix_id")).alias("grand_prix"),
        "race_name", "race_date", "circuit_id", "circuit_name", "country_id", "session_type",
        "driver_id", "driver_name", "constructor_id", "constructor_name", "car_number",
        "grid_position", "grid_status", "finish_position", "finish_status",
        T.order_key(finish).alias("classification_order"),
        T.result_status(finish, F.col("finish_status")).alias("result_status"),
        "points", "completed_laps", "retirement_reason", "positions_gained",
        "is_race_win", "is_race_podium", "has_points",
    )


def driver_wins(facts: DataFrame, drivers: DataFrame) -> DataFrame:
    """Race winners of each season with the number of races they won."""
    won = facts.filter("is_race_win").groupBy("season", "driver_id", "race_id").agg(F.lit(1).alias("won"))
    totals = won.groupBy("season", "driver_id").agg(F.count(F.lit(1)).alias("race_wins"))
    return totals.join(drivers.select("driver_id", "driver_name"), "driver_id").select(
        "season", "driver_id", "driver_name", "race_wins")


def constructor_wins(facts: DataFrame, constructors: DataFrame) -> DataFrame:
    """Winning teams of each season; a winning car shared by two drivers is one win."""
    won = facts.filter("is_race_win").groupBy("season", "constructor_id", "race_id", "car_number").agg(
        F.lit(1).alias("won"))
    totals = won.groupBy("season", "constructor_id").agg(F.count(F.lit(1)).alias("race_wins"))
    return totals.join(constructors.select("constructor_id", "constructor_name"), "constructor_id").select(
        "season", "constructor_id", "constructor_name", "race_wins")


def widget(dataset: DataFrame, fields: Sequence[str], sums: Sequence[str] = (),
           filters: Sequence[str] = (), disaggregated: bool = False) -> DataFrame:
    """A chart query: optional filters, then fields as they are or summed by the other fields."""
    for condition in filters:
        dataset = dataset.filter(condition)
    if disaggregated:
        return dataset.select(*fields, *sums)
    return dataset.groupBy(*fields).agg(*[F.sum(c).alias(f"sum_{c}") for c in sums])


def career_order(key: str) -> list[Column]:
    """The order in which careers are listed: most titles first, then wins, podiums, and the key."""
    return [F.col("championships").desc(), F.col("race_wins").desc(), F.col("race_podiums").desc(), F.col(key)]


def career_summary(career: DataFrame, entity: str) -> DataFrame:
    """Totals of all careers, and how many of the ten best by each measure have any of it.

    Each top ten is a top-k of its own: no rank of all rows is needed for it. ``career`` is read four times.
    """
    key = f"{entity}_id"
    totals = career.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("identities"),
        count_where(F.col(f"{entity}_name").isNull()).alias("missing_names"),
        F.sum("championships").alias("titles"), F.sum("race_wins").alias("wins"))
    tops = {"titles_rank": ("championships", "top_titles"), "wins_rank": ("race_wins", "top_wins"),
            "podiums_rank": ("race_podiums", "top_podiums")}
    orders = rank_orders(key)
    return totals.select("*", *[
        top_k(career, 10, orders[rank]).agg(count_where(F.col(measure) > 0)).scalar().alias(name)
        for rank, (measure, name) in tops.items()])


def wins_summary(wins: DataFrame) -> DataFrame:
    return wins.groupBy("season").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("race_wins").alias("race_wins"),
        count_where(F.col("race_wins") <= 0).alias("invalid_winners"))


def results_summary(results: DataFrame) -> DataFrame:
    nameless = F.col("driver_name").isNull() | F.col("constructor_name").isNull() | F.col("race_name").isNull()
    return results.groupBy("season", "session_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("points").alias("points"),
        count_where(nameless).alias("missing_names"))


def annual_summary(view: DataFrame, entity: str) -> DataFrame:
    leads = known(F.col("source_position") == 1)
    return view.groupBy("season").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("source_points").alias("source_points"),
        F.sum("calculated_points").alias("calculated_points"),
        F.sum("points_difference").alias("difference"),
        count_where(F.col(f"{entity}_name").isNull()).alias("missing_names"),
        F.max(F.when(leads, F.col(f"{entity}_name"))).alias("leader"),
        F.max(F.when(leads, F.col("source_points"))).alias("leader_points"))
