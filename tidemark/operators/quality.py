"""Data checks as queries. Each returns rows ``(check_name, failures)``.

Null, count and predicate checks of a frame share one aggregate pass; unique keys cost one
shuffle with map-side counts; each reference costs one anti join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.measures import count_where
from tidemark.functions.text import is_blank


class CheckFailed(ValueError):
    """A blocking check found failures."""


def union_rows(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _as_rows(totals: DataFrame, names: Sequence[str]) -> DataFrame:
    """One wide row of totals to one row per check."""
    pairs = [
        F.struct(F.lit(name).alias("check_name"), F.col(f"`{name}`").cast("bigint").alias("failures"))
        for name in names
    ]
    return totals.select(F.explode(F.array(*pairs)).alias("c")).select("c.check_name", "c.failures")


def unmet(condition: Column | str) -> Column:
    """Whether a row's condition is false or unknown."""
    return ~F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))


def predicate_checks(frame: DataFrame, expectations: Mapping[str, Column | str],
                     expected_count: int | None = None) -> DataFrame:
    """Rows for which each expectation is false or unknown, all in one pass."""
    aggregates = []
    for name, condition in expectations.items():
        aggregates.append(count_where(unmet(condition)).alias(name))
    if expected_count is not None:
        aggregates.append(F.abs(F.count(F.lit(1)) - F.lit(expected_count)).alias("row_count"))
    names = list(expectations) + (["row_count"] if expected_count is not None else [])
    if not names:
        return frame.sparkSession.createDataFrame([], "check_name string, failures bigint")
    return _as_rows(frame.agg(*aggregates), names)


def enforce(frame: DataFrame, expectations: Mapping[str, Column | str]) -> DataFrame:
    """The frame itself, failing at the first row that breaks an expectation; streams too."""
    for name, condition in expectations.items():
        met = F.assert_true(~unmet(condition), F.lit(f"expectation failed: {name}"))
        frame = frame.filter(met.isNull())
    return frame


def required(names: Iterable[str]) -> dict[str, Column]:
    return {f"null:{name}": F.col(name).isNotNull() for name in names}


def required_checks(frame: DataFrame, names: Iterable[str], expected_count: int | None = None) -> DataFrame:
    return predicate_checks(frame, required(names), expected_count)


def unique_check(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    return failures("unique:" + ",".join(keys), duplicate_keys(frame, keys))


def duplicate_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def failures(name: str, rows: DataFrame) -> DataFrame:
    """The number of offending rows as one check row."""
    return rows.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")


def check_rows(frame: DataFrame, keys: Sequence[str], names: Sequence[str],
               expected_count: int | None = None) -> DataFrame:
    return union_rows([required_checks(frame, names, expected_count), unique_check(frame, keys)])


def missing_references(frame: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``frame`` whose keys no parent row holds."""
    return frame.join(parent.select(*keys), list(keys), "left_anti")


def check_reference(frame: DataFrame, parent: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    # Count rows per key before the join, so a hot key crosses the shuffle as a few rows.
    per_key = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    orphans = missing_references(per_key, parent, keys)
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("failures")).select(
        F.lit(f"reference:{name}").alias("check_name"), "failures")


def check_current(frame: DataFrame, release_seq: int) -> DataFrame:
    """Rows of another release, or of none."""
    return predicate_checks(frame, {"single_release": F.col("_release_seq") == release_seq})


def no_future(last_season: int) -> dict[str, Column]:
    """Rows dated after the season of the release; a NULL season is another check's concern."""
    return {"no_future_season": F.coalesce(F.col("season") <= last_season, F.lit(True))}


def check_future(frame: DataFrame, last_season: int) -> DataFrame:
    return predicate_checks(frame, no_future(last_season))


def check_input(raw: DataFrame, expected_count: int | None) -> DataFrame:
    """Completeness gate of one raw release: row count, no rescued rows, no blank season."""
    expectations: dict[str, Column] = {}
    if "_rescued_data" in raw.columns:
        expectations["no_rescued_rows"] = F.col("_rescued_data").isNull()
    if "year" in raw.columns:
        expectations["no_blank_season"] = ~is_blank(F.col("year"))
    return predicate_checks(raw, expectations, expected_count)


def check_join_preserved(output: DataFrame, *driving: DataFrame) -> DataFrame:
    """A join that should keep its driving rows did so: counts agree."""
    def total(frame: DataFrame) -> DataFrame:
        return frame.agg(F.count(F.lit(1)).alias("n"))

    expected = union_rows([total(frame) for frame in driving]).agg(F.sum("n").alias("n"))
    sides = total(output).withColumn("sign", F.lit(1)).unionByName(expected.withColumn("sign", F.lit(-1)))
    return sides.agg(F.abs(F.sum(F.col("n") * F.col("sign"))).cast("bigint").alias("failures")).select(
        F.lit("join_row_count").alias("check_name"), "failures")


def check_measure(frame: DataFrame, measure: str) -> DataFrame:
    """The frame has rows and the measure is never negative."""
    totals = frame.agg(
        (F.count(F.lit(1)) == 0).cast("bigint").alias("nonempty"),
        count_where(F.col(measure) < 0).alias(f"nonnegative:{measure}"),
    )
    return _as_rows(totals, ["nonempty", f"nonnegative:{measure}"])


def pass_or_fail(report: DataFrame) -> DataFrame:
    """Add PASS or FAIL: by ``actual`` against ``expected`` where given, else by ``failures``."""
    if "actual" in report.columns:
        ok = F.col("actual") == F.col("expected")
    else:
        ok = F.col("failures") == 0
    return report.withColumn("status", F.when(ok, "PASS").otherwise("FAIL"))


def failing(report: DataFrame) -> dict[str, int]:
    """The checks that fail. A report holds one row per check, so collecting it is safe."""
    return {row.check_name: row.failures for row in report.filter(F.col("failures") > 0).collect()}


def stop_on(failed: Mapping[str, int], subject: str) -> None:
    bad = {name: n for name, n in failed.items() if n}
    if bad:
        raise CheckFailed(f"{subject}: " + ", ".join(f"{name}={n}" for name, n in bad.items()))


def raise_if_failed(report: DataFrame, subject: str) -> None:
    stop_on(failing(report), subject)
