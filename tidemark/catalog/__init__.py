"""Every query the package registers, with an equivalent ANSI statement where one exists."""

from __future__ import annotations

from tidemark.catalog import (  # noqa: F401  (importing a module registers its queries)
    aggregates,
    builds,
    checks,
    exploring,
    files,
    joins,
    marts,
    scalars,
    serving,
    state,
)
from tidemark.catalog.registry import ORACLE, QUERIES, SURVEY_IDS  # noqa: F401
