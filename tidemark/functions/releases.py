"""Release tags such as ``v2026.8.1`` and their ordered numeric form."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# No leading zeros, one to three digits after the year.
CANONICAL_TAG = r"v[0-9]{4}\.(0|[1-9][0-9]{0,2})\.(0|[1-9][0-9]{0,2})"

YEAR_STEP = 1_000_000
RELEASE_STEP = 1_000


def is_canonical(tag: Column) -> Column:
    # \\z, as $ would let a trailing line break pass.
    return F.coalesce(tag.rlike(rf"^{CANONICAL_TAG}\z"), F.lit(False))


def release_seq(tag: Column) -> Column:
    """BIGINT order of a canonical tag, NULL for anything else."""
    parts = F.split(F.substring(tag, 2, 12), r"\.")

    def number(i: int) -> Column:
        return F.element_at(parts, i).cast("bigint")

    encoded = number(1) * YEAR_STEP + number(2) * RELEASE_STEP + number(3)
    return F.when(is_canonical(tag), encoded)


def parse_tag(tag: str) -> int:
    """The same encoding for a run parameter; raises on anything but a canonical tag."""
    if not re.fullmatch(CANONICAL_TAG, tag):
        raise ValueError(f"not a canonical release tag: {tag!r}")
    year, release, patch = (int(part) for part in tag[1:].split("."))
    return year * YEAR_STEP + release * RELEASE_STEP + patch


def check_scope(tag: str, min_season: int, first_season: int = 1950) -> int:
    """Sequence of ``tag`` after checking that the season scope fits it."""
    seq = parse_tag(tag)
    if not first_season <= min_season <= seq // YEAR_STEP:
        raise ValueError(f"season scope {min_season} does not fit release {tag}")
    return seq
