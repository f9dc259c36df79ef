"""Every registered query against its comparison SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402

import __spark_entry__ as entrypoint  # noqa: E402
from tidemark.catalog import ORACLE, QUERIES, SURVEY_IDS  # noqa: E402


@pytest.fixture(scope="module")
def db(small):
    return compare.connect(small)


def test_every_query_has_a_comparison():
    assert set(ORACLE) == set(QUERIES) == set(SURVEY_IDS)
    assert set(QUERIES) <= set(entrypoint.queries()) and set(ORACLE) <= set(entrypoint.oracle_sql())


def test_entry(spark):
    frame = entrypoint.entry(spark)
    assert "calculated_points" in frame.columns and frame.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches(spark, db, small, name):
    verdict, _, _ = compare.compare(spark, db, name, small)
    assert verdict.startswith("ok"), verdict
