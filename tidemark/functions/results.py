"""What a result row means: win, podium, started, finished, outcome."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.measures import known

# Status codes and retirement reasons of the source data.
NOT_STARTED = ["DNS", "DNQ", "DNPQ", "WD"]
NOT_FINISHED = ["DNS", "DNQ", "DSQ", "EX", "DQ", "DNPQ"]
INCIDENTS = ["Collision", "Collision damage", "Accident", "Accident damage", "Spun off"]
MECHANICAL = [
    "Engine", "Undertray", "Brakes", "Hydraulics", "Overheating", "Gearbox", "Oil leak",
    "Suspension", "Rear wing", "Turbo", "Clutch", "Electrical", "Chassis", "Oil pressure",
    "Fuel system", "Throttle", "Power unit", "Steering", "Water leak", "Fuel pump",
    "Transmission",
]

RACE = "RACE"
SPRINT = "SPRINT"


def is_race(session: Column) -> Column:
    return session == RACE


def race_win(session: Column, position: Column) -> Column:
    return known(is_race(session) & (position == 1))


def race_podium(session: Column, position: Column) -> Column:
    return known(is_race(session) & position.between(1, 3))


def positions_gained(grid: Column, finish: Column, reason: Column) -> Column:
    comparable = (grid > 0) & (finish > 0) & reason.isNull()
    return F.when(comparable, grid - finish)


def finished(position: Column, status: Column, reason: Column) -> Column:
    return reason.isNull() & position.isNotNull() & ~status.isin(NOT_FINISHED)


def started(status: Column, reason: Column) -> Column:
    withdrew_early = F.coalesce(reason, F.lit("")).ilike("%formation lap%")
    return ~status.isin(NOT_STARTED) & ~withdrew_early


def outcome_group(has_started: Column, has_finished: Column, status: Column, reason: Column) -> Column:
    return (
        F.when(~has_started, "Non-start (source-derived)")
        .when(status == "DSQ", "Disqualified")
        .when(has_finished, "Finished without retirement")
        .when(reason.isin(INCIDENTS), "Incident-related retirement")
        .when(reason.isin(MECHANICAL), "Mechanical-labelled retirement")
        .otherwise("Other / unclassified retirement")
    )
