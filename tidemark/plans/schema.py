"""The eight source datasets: raw columns, typed columns, keys and references.

Names and types here are fixed values: they are the interface of the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

POINTS = "decimal(10,2)"


@dataclass(frozen=True)
class Dataset:
    """How one raw dataset becomes one cleaned table."""

    name: str
    columns: tuple[tuple[str, str, str], ...]  # raw name, clean name, type
    keys: tuple[str, ...]
    required: tuple[str, ...]
    references: tuple[tuple[str, tuple[str, ...]], ...] = ()
    season_column: str | None = None
    extras: tuple[tuple[str, str, str], ...] = ()  # exploratory columns outside the contract
    may_be_empty: bool = False
    optional_raw: tuple[str, ...] = ()  # read when present, not demanded of a file
    derived: dict[str, str] = field(default_factory=dict)

    @property
    def required_raw(self) -> list[str]:
        return [raw for raw, _, _ in self.columns if raw not in self.optional_raw]

    @property
    def clean_names(self) -> list[str]:
        return [clean for _, clean, _ in self.columns] + list(self.derived)


_RESULT_COLUMNS = (
    ("raceId", "race_id", "bigint"),
    ("year", "season", "bigint"),
    ("round", "round", "bigint"),
    ("driverId", "driver_id", "string"),
    ("constructorId", "constructor_id", "string"),
    ("engineManufacturerId", "engine_manufacturer_id", "string"),
    ("driverNumber", "car_number", "string"),
    ("positionNumber", "finish_position", "bigint"),
    ("positionText", "finish_status", "string"),
    ("gridPositionNumber", "grid_position", "bigint"),
    ("gridPositionText", "grid_status", "string"),
    ("points", "points", POINTS),
    ("laps", "completed_laps", "bigint"),
    ("reasonRetired", "retirement_reason", "string"),
)
_RESULT_EXTRAS = (
    ("qualificationPositionNumber", "qualifying_position", "bigint"),
    ("pitStops", "pit_stops", "bigint"),
    ("gapMillis", "gap_ms", "bigint"),
)


def _results(name: str, may_be_empty: bool) -> Dataset:
    return Dataset(
        name=name,
        columns=_RESULT_COLUMNS,
        keys=("race_id", "driver_id", "car_number"),
        required=("race_id", "season", "round", "driver_id", "constructor_id",
                  "engine_manufacturer_id", "car_number", "finish_status"),
        references=(("races", ("race_id", "season", "round")),
                    ("drivers", ("driver_id",)),
                    ("constructors", ("constructor_id",))),
        season_column="year",
        extras=_RESULT_EXTRAS,
        may_be_empty=may_be_empty,
        optional_raw=("engineManufacturerId",),
    )


DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in (
        Dataset(
            name="drivers",
            columns=(("id", "driver_id", "string"),
                     ("name", "driver_name", "string"),
                     ("fullName", "full_name", "string"),
                     ("nationalityCountryId", "nationality_country_id", "string"),
                     ("dateOfBirth", "date_of_birth", "date")),
            keys=("driver_id",),
            required=("driver_id", "driver_name"),
        ),
        Dataset(
            name="constructors",
            columns=(("id", "constructor_id", "string"),
                     ("name", "constructor_name", "string"),
                     ("countryId", "country_id", "string")),
            keys=("constructor_id",),
            required=("constructor_id", "constructor_name"),
        ),
        Dataset(
            name="circuits",
            columns=(("id", "circuit_id", "string"),
                     ("name", "circuit_name", "string"),
                     ("countryId", "country_id", "string"),
                     ("type", "circuit_type", "string")),
            keys=("circuit_id",),
            required=("circuit_id", "circuit_name"),
        ),
        Dataset(
            name="races",
            columns=(("id", "race_id", "bigint"),
                     ("year", "season", "bigint"),
                     ("round", "round", "bigint"),
                     ("date", "race_date", "date"),
                     ("grandPrixId", "grand_prix_id", "string"),
                     ("officialName", "race_name", "string"),
                     ("circuitId", "circuit_id", "string")),
            keys=("race_id",),
            required=("race_id", "season", "round", "race_date", "circuit_id"),
            references=(("circuits", ("circuit_id",)),),
            season_column="year",
            extras=(("circuitLayoutId", "circuit_layout_id", "string"),),
        ),
        _results("race_results", may_be_empty=False),
        _results("sprint_results", may_be_empty=True),
        Dataset(
            name="driver_standings",
            columns=(("year", "season", "bigint"),
                     ("driverId", "driver_id", "string"),
                     ("positionNumber", "standing", "bigint"),
                     ("positionText", "standing_status", "string"),
                     ("points", "points", POINTS),
                     ("championshipWon", "championship_won", "boolean")),
            keys=("season", "driver_id"),
            required=("season", "driver_id", "standing_status", "championship_won"),
            references=(("drivers", ("driver_id",)),),
            season_column="year",
        ),
        Dataset(
            name="constructor_standings",
            columns=(("year", "season", "bigint"),
                     ("constructorId", "constructor_id", "string"),
                     ("engineManufacturerId", "engine_manufacturer_id", "string"),
                     ("positionNumber", "standing", "bigint"),
                     ("positionText", "standing_status", "string"),
                     ("points", "points", POINTS),
                     ("championshipWon", "championship_won", "boolean")),
            keys=("season", "constructor_id", "engine_manufacturer_id", "entry_category"),
            required=("season", "constructor_id", "engine_manufacturer_id",
                      "standing_status", "championship_won"),
            references=(("constructors", ("constructor_id",)),),
            season_column="year",
            optional_raw=("engineManufacturerId",),
            # A placed entry is RANKED; any other carries its status text.
            derived={"entry_category":
                     "CASE WHEN nullif(positionNumber, '') IS NULL THEN positionText ELSE 'RANKED' END"},
        ),
    )
}

GOLD_KEYS = {
    "race_dimension": ("race_id",),
    "session_results": ("race_id", "session_type", "driver_id", "car_number"),
    "driver_season": ("season", "driver_id"),
    "constructor_season": ("season", "constructor_id", "engine_manufacturer_id"),
}

HISTORY_KEYS = ("driver_id",)
HISTORY_TRACKED = ("driver_name", "full_name", "nationality_country_id", "date_of_birth")

# A release is complete when each of these tables has recorded its marker.
TERMINAL_TASKS = (
    "silver_drivers_history",
    "gold_race_dimension",
    "gold_session_results",
    "gold_driver_season",
    "gold_constructor_season",
)
