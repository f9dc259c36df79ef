"""Cleaned current tables: one release of each raw dataset, typed, checked and scoped."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.releases import YEAR_STEP, parse_tag
from tidemark.operators import quality
from tidemark.operators.clean import in_scope, select_release, type_columns
from tidemark.plans.schema import DATASETS, POINTS, Dataset


def _typed(dataset: Dataset, points: str, extras: bool) -> list[tuple[str, str, str]]:
    columns = list(dataset.columns) + (list(dataset.extras) if extras else [])
    return [(raw, name, points if dtype == POINTS else dtype) for raw, name, dtype in columns]


def clean(name: str, raw: DataFrame, tag: str, min_season: int,
          extras: bool = False, points: str = POINTS) -> DataFrame:
    """One cleaned dataset. Release and season filters come first, then a single typed projection.

    ``extras`` adds exploratory columns in that same pass, which spares the exploratory queries a
    join of the cleaned rows back to the raw ones.
    """
    dataset = DATASETS[name]
    rows = select_release(raw, tag)
    if dataset.season_column:
        rows = in_scope(rows, dataset.season_column, min_season)
    return type_columns(rows, _typed(dataset, points, extras), dataset.derived, parse_tag(tag))


def input_checks(name: str, raw: DataFrame, tag: str, expected_count: int | None = None) -> DataFrame:
    """The gate before cleaning; a blank season must stop the run, not drop out of the scope filter."""
    return quality.check_input(select_release(raw, tag), expected_count)


def expectations(name: str, tag: str) -> dict[str, Column]:
    """What each row of a cleaned dataset must meet: counted while it is written."""
    dataset = DATASETS[name]
    future = quality.no_future(parse_tag(tag) // YEAR_STEP) if dataset.season_column else {}
    return quality.required(dataset.required) | future


def table_checks(name: str, frame: DataFrame, tag: str, parents: Mapping[str, DataFrame]) -> DataFrame:
    """What a cleaned dataset must meet as a whole: unique keys, and references to current parents."""
    return quality.union_rows([quality.unique_check(frame, DATASETS[name].keys), *reference_checks(name, frame, tag, parents)])


def reference_checks(name: str, frame: DataFrame, tag: str, parents: Mapping[str, DataFrame]) -> list[DataFrame]:
    """References to current parents, for tables whose keys have been checked as they were written."""
    report = []
    for parent, keys in DATASETS[name].references:
        current = quality.check_current(parents[parent], parse_tag(tag))
        report.append(current.withColumn("check_name", F.lit(f"current:{parent}")))
        report.append(quality.check_reference(frame, parents[parent], keys, parent))
    return report


def checks(name: str, frame: DataFrame, tag: str, parents: Mapping[str, DataFrame]) -> DataFrame:
    """All blocking checks of a cleaned dataset as one report."""
    return quality.predicate_checks(frame, expectations(name, tag)).unionByName(table_checks(name, frame, tag, parents))
