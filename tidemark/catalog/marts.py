"""Cleaned tables and the four analytical tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.catalog.oracle_tables import SEQ
from tidemark.catalog.registry import query
from tidemark.plans import gold, silver
from tidemark.plans.retail import MONEY, TAG, Retail
from tidemark.plans.schema import DATASETS

# Scoped to seasons from 1996 on where the dataset has seasons, as a release run would be.
MIN_SEASON = 1996


def _cleaned(spark: SparkSession, folder: str, name: str) -> DataFrame:
    raw = Retail(spark, folder).raw(name, extras=False)
    return silver.clean(name, raw, TAG, MIN_SEASON, points=MONEY)


def _silver_sql(name: str) -> str:
    casts = {"points": "points::DOUBLE AS points"}
    columns = ", ".join(casts.get(c, c) for c in DATASETS[name].clean_names)
    source = "t_lines" if name.endswith("_results") else f"t_{name}"
    where = []
    if name.endswith("_results"):
        where.append(f"session_type = '{'RACE' if name == 'race_results' else 'SPRINT'}'")
    if DATASETS[name].season_column:
        where.append(f"season >= {MIN_SEASON}")
    condition = f" WHERE {' AND '.join(where)}" if where else ""
    return f"SELECT {columns}, {SEQ}::BIGINT AS _release_seq FROM {source}{condition}"


@query("D1 P2 P3 P5", _silver_sql("drivers"))
def silver_drivers(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(spark, folder, "drivers")


@query("D2", _silver_sql("constructors"))
def silver_constructors(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(spark, folder, "constructors")


@query("D3", _silver_sql("circuits"))
def silver_circuits(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(spark, folder, "circuits")


@query("D4 P6", _silver_sql("races"))
def silver_races(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(spark, folder, "races")


@query("D5", _silver_sql("race_results"))
def silver_race_results(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(spark, folder, "race_results")


@query("D6", _silver_sql("sprint_results"))
def silver_sprint_results(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(spark, folder, "sprint_results")


@query("D7", _silver_sql("driver_standings"))
def silver_driver_standings(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(spark, folder, "driver_standings")


@query("D8 P8", _silver_sql("constructor_standings"))
def silver_constructor_standings(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(spark, folder, "constructor_standings")


@query("D10 J1", "SELECT * EXCLUDE (circuit_layout_id) FROM t_race_dimension")
def race_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return Retail(spark, folder).race_dimension


@query("D11 U1 P9 P18", """
    SELECT * EXCLUDE (qualifying_position, pit_stops, gap_ms) REPLACE (points::DOUBLE AS points)
    FROM t_session_results""")
def session_results(spark: SparkSession, folder: str) -> DataFrame:
    return Retail(spark, folder).session_results_from_union


_SEASON_DOUBLES = """source_points::DOUBLE AS source_points, calculated_points::DOUBLE AS calculated_points,
    points_difference::DOUBLE AS points_difference"""


@query("D12 A2 A4 J3", f"""
    SELECT * REPLACE ({_SEASON_DOUBLES}, race_points::DOUBLE AS race_points, sprint_points::DOUBLE AS sprint_points)
    FROM t_driver_season""")
def driver_season(spark: SparkSession, folder: str) -> DataFrame:
    return Retail(spark, folder).driver_season


@query("D13 A3 A5 J6", f"SELECT * REPLACE ({_SEASON_DOUBLES}) FROM t_constructor_season")
def constructor_season(spark: SparkSession, folder: str) -> DataFrame:
    return Retail(spark, folder).constructor_season


@query("Q9", """
    SELECT season, driver_id, points_difference::DOUBLE AS points_difference FROM t_driver_season
    WHERE points_difference <> 0""")
def unreconciled_driver_seasons(spark: SparkSession, folder: str) -> DataFrame:
    return gold.unreconciled(Retail(spark, folder).driver_season).select("season", "driver_id", "points_difference")


