"""Two builds of every table compared, results computed twice, and releases streamed into current tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.catalog.exploring import FIRST, LAST, PROGRESSION_SQL, SEASON, TEAMMATES_SQL, Explore
from tidemark.catalog.oracle_tables import SEQ
from tidemark.catalog.registry import query
from tidemark.catalog.state import KEYS, TAGS, TRACKED, all_snapshots, release_ledger, snapshot
from tidemark.operators import history as H
from tidemark.operators import ledger as L
from tidemark.operators.folds import recomputed, sorted_totals
from tidemark.operators.history_store import HistoryStore
from tidemark.operators.quality import union_rows
from tidemark.plans import explore as X
from tidemark.plans import gold, silver, verification
from tidemark.plans.retail import MONEY, TAG, Retail
from tidemark.plans.schema import DATASETS, GOLD_KEYS
from tidemark.session import HASHED_JOINS, scratch, stored, tune
from tidemark.sources import csv_release as csv
from tidemark.sources import schemas
from tidemark.sources.tables import read_table
from tidemark.streaming.merge import SnapshotStream

C = F.col

# --- two builds -----------------------------------------------------------------------------------
# What the second build has otherwise: rows whose key ends in 7 are lost, and of those ending in 3 a column is changed.
# Table: its SQL, the column of the key, the changed column.
_RACE, _SPRINT = "(SELECT * FROM t_lines WHERE session_type = 'RACE')", "(SELECT * FROM t_lines WHERE session_type = 'SPRINT')"
PLANTED = {
    "drivers": ("t_drivers", "driver_id", "driver_name"),
    "constructors": ("t_constructors", "constructor_id", "constructor_name"),
    "circuits": ("t_circuits", "circuit_id", "circuit_name"),
    "races": ("t_races", "race_id", "race_name"),
    "race_results": (_RACE, "race_id", "completed_laps"),
    "sprint_results": (_SPRINT, "race_id", "completed_laps"),
    "driver_standings": ("t_driver_standings", "driver_id", "points"),
    "constructor_standings": ("t_constructor_standings", "constructor_id", "points"),
    "race_dimension": ("t_race_dimension", "race_id", "race_name"),
    "session_results": ("t_session_results", "race_id", "completed_laps"),
    "driver_season": ("t_driver_season", "driver_id", "race_entries"),
    "constructor_season": ("t_constructor_season", "constructor_id", "race_weekends"),
    "history": ("t_history", "c_custkey", "c_name"),
}
_TABLE_KEYS = {**{n: d.keys for n, d in DATASETS.items()}, **GOLD_KEYS, "history": (*KEYS, H.START)}


def _changed(column: Column, kind: str) -> Column:
    return F.concat(column, F.lit("*")) if kind == "string" else (column + 1).cast(kind)


def _planted(name: str, frame: DataFrame) -> DataFrame:
    _, key, column = PLANTED[name]
    text = C(key).cast("string")
    kind = frame.schema[column].dataType.simpleString()
    return frame.filter(~text.like("%7")).withColumn(column, F.when(text.like("%3"), _changed(C(column), kind)).otherwise(C(column)))


def two_builds(spark: SparkSession, folder: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Eight current and four analytical tables and a history, each stored twice: from typed columns, and from raw text."""
    r = Retail(tune(spark, HASHED_JOINS), folder)
    typed = {name: stored(frame.select(*DATASETS[name].clean_names), f"typed-{name}") for name, frame in r.silver.items()}
    cleaned = {name: stored(silver.clean(name, r.raw(name, extras=False, frame=typed[name]), TAG, 1995, points=MONEY)
                            .select(*DATASETS[name].clean_names), f"cleaned-{name}") for name in DATASETS}
    marts = [gold.build_gold(tables, SEQ, lambda name, frame, kind=kind: stored(frame, f"{kind}-{name}"))
             for kind, tables in (("typed", typed), ("cleaned", cleaned))]
    store = HistoryStore(spark, scratch(spark, "history-build"), KEYS, TRACKED)
    for tag, seq in TAGS.items():
        store.apply(snapshot(spark, folder, tag), seq)
    history = H.rebuild_history(all_snapshots(spark, folder), release_ledger(spark), KEYS, TRACKED)
    first = {**typed, **marts[0], "history": stored(history, "history")}
    second = {**cleaned, **marts[1], "history": store.read()}
    return {name: (first[name], second[name]) for name in PLANTED}


def _parity_sql() -> str:
    parts = []
    for name, (table, key, _) in PLANTED.items():
        left = f"{key}::VARCHAR NOT LIKE '%7'"
        keys = ", ".join(_TABLE_KEYS[name])
        parts.append(f"""
            SELECT '{name}' AS dataset, count(*) FILTER ({key}::VARCHAR LIKE '%7' OR {key}::VARCHAR LIKE '%3') AS missing,
                   count(*) FILTER ({key}::VARCHAR LIKE '%3') AS extra, count(*) FILTER ({left}) AS row_count,
                   (SELECT count(*) FROM (SELECT 1 FROM {table} x WHERE {left} GROUP BY {keys} HAVING count(*) > 1)) AS duplicate_keys
            FROM {table} t""")
    return " UNION ALL ".join(parts)


@query("D26 U3 H6", _parity_sql())
def build_parity(spark: SparkSession, folder: str) -> DataFrame:
    """Thirteen tables built twice; the second build has lost rows and changed others, which happens as it is read."""
    pairs = two_builds(spark, folder)
    return verification.parity_report({
        name: (left, _planted(name, right), _TABLE_KEYS[name]) for name, (left, right) in pairs.items()})


@query("Q13 D26", """
    SELECT 'races' AS dataset, 'race_name' AS column_name, 'string' AS left_type, NULL AS right_type, 1::BIGINT AS files,
           (SELECT count(*) FROM t_races WHERE season = 1998) AS row_count
    UNION ALL SELECT 'races', 'label', NULL, 'string', 1, (SELECT count(*) FROM t_races WHERE season = 1998)
    UNION ALL SELECT 'driver_season', 'race_entries', 'long', 'decimal(12,0)', 1,
                     (SELECT count(*) FROM t_driver_season WHERE season = 1998)""")
def stored_schema_parity(spark: SparkSession, folder: str) -> DataFrame:
    """The files of both builds of all tables; in two tables one file more has come with other columns."""
    pairs = two_builds(spark, folder)

    def folders(frame: DataFrame) -> list[str]:
        """A history lies in several; every file of a build is listed once."""
        return sorted({f.rsplit("/", 1)[0] for f in frame.inputFiles()})

    late = {
        "races": lambda f: f.withColumnRenamed("race_name", "label"),
        "driver_season": lambda f: f.withColumn("race_entries", C("race_entries").cast("decimal(12,0)"))}
    found = []
    for name, (left, right) in pairs.items():
        files = folders(right)
        if name in late:
            files.append(scratch(spark, f"late-{name}"))
            late[name](right.filter("season = 1998")).coalesce(1).write.parquet(files[-1])
        found.append(schemas.schema_differences(
            name, schemas.file_columns(spark, folders(left)), stored(schemas.file_columns(spark, files), f"columns-{name}")))
    return union_rows(found)


# --- results computed twice -------------------------------------------------------------------------
_ODD = "driver_id LIKE '%7' AND season = 1998"
_CENTS = "(points * 100)::BIGINT"
_RECOUNTED = {
    "driver_totals": (["season", "driver_id"], _CENTS, "TRUE"),
    "team_contribution": (["season", "constructor_id", "driver_id"], _CENTS, f"season BETWEEN {FIRST} AND {LAST}"),
    "last_round_points": (["season", "constructor_id"], _CENTS, "round = last_round"),
    "venue_winners": (["country_id", "driver_id"], "is_race_win::BIGINT", "is_race_win"),
}


def _recount_sql() -> str:
    parts = []
    for name, (keys, _, where) in _RECOUNTED.items():
        listed = ", ".join(keys)
        written = " || '/' || ".join(f"{k}::VARCHAR" for k in keys)
        parts.append(f"""
            SELECT '{name}' AS result, count(*) AS n_keys, count(*) FILTER (odd) AS differing, min(k) FILTER (odd) AS first_differing
            FROM (SELECT {written} AS k, bool_or({_ODD}) AS odd FROM f WHERE {where} GROUP BY {listed})""")
    return """WITH f AS (
        SELECT *, max(round) OVER (PARTITION BY season) AS last_round FROM t_facts JOIN (
          SELECT race_id, country_id FROM t_race_dimension) USING (race_id)
        ) SELECT * FROM (""" + " UNION ALL ".join(parts) + ")"


@query("Q14 U3", _recount_sql())
def independent_recounts(spark: SparkSession, folder: str) -> DataFrame:
    """Four results by aggregates, and again by sorted scans over rows of which some have been changed."""
    e = Explore(spark, folder)
    venue = e.race_dimension.select("race_id", "country_id")
    facts = stored(e.facts.join(venue, "race_id").select(
        "season", "round", "race_id", "driver_id", "constructor_id", "country_id", "is_race_win",
        (C("points") * 100).cast("bigint").alias("cents")), "recount-facts")
    last = facts.groupBy("season").agg(F.max("round").alias("last_round"))
    dated = facts.join(last, "season")
    odd = F.expr(_ODD)
    rows = {
        "driver_totals": dated, "team_contribution": X.seasons_between(dated, FIRST, LAST),
        "last_round_points": dated.filter("round = last_round"), "venue_winners": dated.filter("is_race_win")}
    found = []
    for name, (keys, _, _) in _RECOUNTED.items():
        value = C("is_race_win").cast("bigint") if name == "venue_winners" else C("cents")
        frame = rows[name].withColumn("value", value)
        again = frame.withColumn("value", C("value") + F.when(odd, 1).otherwise(0))
        found.append(recomputed(name, frame.groupBy(*keys).agg(F.sum("value").alias("total")),
                                sorted_totals(again, keys, "value", "race_id"), keys))
    return union_rows(found)


@query("Q10 X3 X6 X11", f"""
    WITH pairs AS ({TEAMMATES_SQL}), steps AS ({PROGRESSION_SQL}),
    ends AS (SELECT driver_id, max_by(calculated_points, round) AS total FROM steps GROUP BY 1)
    SELECT 'race wins of teammates' AS invariant, count(*) AS n,
           count(*) FILTER (race_wins_a + race_wins_b <> comparable_finishes) AS violations FROM pairs
    UNION ALL
    SELECT 'qualifying wins of teammates', count(*),
           count(*) FILTER (qualifying_wins_a + qualifying_wins_b <> comparable_qualifying) FROM pairs
    UNION ALL
    SELECT 'last round and source points', count(*), count(*) FILTER (total <> source_points::DOUBLE)
    FROM ends JOIN t_driver_season_rows s USING (driver_id) WHERE s.season = {SEASON}""")
def result_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold between results. Ties in qualifying and declared points break two of the rules in the given tables."""
    e = Explore(spark, folder)
    return verification.result_invariants(
        X.teammate_comparison(e.recent), X.points_progression(e.facts, e.driver_season_rows, SEASON),
        e.driver_season_rows.filter(C("season") == SEASON))


# --- stored history and ledger ----------------------------------------------------------------------
def _history_store(spark: SparkSession, folder: str) -> HistoryStore:
    store = HistoryStore(spark, scratch(spark, "stored-history"), KEYS, TRACKED)
    for tag, seq in TAGS.items():
        for _ in range(2):  # the second time nothing is left to write
            store.apply(snapshot(spark, folder, tag), seq)
    return store


@query("D9 H1 H2 H4", "SELECT * FROM t_history")
def history_stored_by_changes(spark: SparkSession, folder: str) -> DataFrame:
    return _history_store(spark, folder).read()


@query("H1 H2", """
    SELECT seq AS release_seq, sum(closed)::BIGINT AS rows_closed, sum(opened)::BIGINT AS rows_opened FROM (
      SELECT valid_from_release AS seq, 0 AS closed, 1 AS opened FROM t_history
      UNION ALL SELECT valid_to_release, 1, 0 FROM t_history WHERE valid_to_release IS NOT NULL) GROUP BY 1""")
def history_written_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Each release writes the versions it ends and begins; retries write none."""
    return _history_store(spark, folder).writes().select("release_seq", "rows_closed", "rows_opened")


@query("L2 M2 M3 S9", """
    SELECT o_custkey AS ledger, o_orderkey AS release_seq, o_orderpriority AS archive_sha256,
           year(o_orderdate)::BIGINT - (o_orderpriority = '1-URGENT')::BIGINT AS min_season,
           CASE WHEN o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT') THEN 'COMPLETE' ELSE 'RUNNING' END AS status,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'second' ELSE 'first' END AS attempt_id,
           CASE o_orderpriority WHEN '1-URGENT' THEN 0 ELSE (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) END AS tasks
    FROM orders""")
def ledger_from_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every order opens an attempt, its lines finish tasks, and most are closed; urgent ones are opened again, some after that."""
    orders = read_table(spark, folder, "orders")
    by, base = ["ledger"], C("o_orderkey") * 100

    def event(rows: DataFrame, kind: str, step: Column | int, **values: Column) -> DataFrame:
        fields = {"release_tag": F.lit("tag"), "archive_sha256": C("o_orderpriority"), "attempt_id": F.lit("first"),
                  "min_season": F.year("o_orderdate").cast("bigint"), "at": F.current_timestamp(),
                  "task_key": F.lit(None).cast("string"), **values}
        return rows.select(C("o_custkey").alias("ledger"), C("o_orderkey").alias("release_seq"),
                           (base + step).alias("number"), F.lit(kind).alias("kind"), *[v.alias(k) for k, v in fields.items()])

    urgent, status = C("o_orderpriority") == "1-URGENT", C("o_orderstatus")
    lines = read_table(spark, folder, "lineitem").select(C("l_orderkey").alias("o_orderkey"), "l_linenumber")
    events = union_rows([
        event(orders, L.OPENED, 1),
        event(orders.join(lines, "o_orderkey"), L.FINISHED, C("l_linenumber") + 10, task_key=C("l_linenumber").cast("string")),
        event(orders.filter(status == "F"), L.CLOSED, 40),
        event(orders.filter(urgent), L.OPENED, 50, attempt_id=F.lit("second"), archive_sha256=F.lit("later"),
              min_season=(F.year("o_orderdate") - 1).cast("bigint")),
        event(orders.filter(status == "P"), L.CLOSED, 60)])
    path = scratch(spark, "ledger-events")
    events.write.partitionBy("kind").parquet(path)
    log = spark.read.parquet(path)
    done = L.completions_of(log, by).groupBy(*by, "release_seq", "attempt_id").agg(F.count(F.lit(1)).alias("tasks"))
    state = L.state_of(log, by).select(*by, "release_seq", "archive_sha256", "min_season", "status", "attempt_id")
    return state.join(done, [*by, "release_seq", "attempt_id"], "left").withColumn("tasks", F.coalesce("tasks", F.lit(0)))


# --- releases streamed into current tables -----------------------------------------------------------
STREAM_TAGS = ("v2010.1.0", "v2010.2.0")
# Dataset: SQL of its rows, the key whose last digit decides, the changed raw column, whether rows come and go.
_ONE_ROW_A_KEY = "(SELECT * FROM t_lines WHERE session_type = '{}' QUALIFY count(*) OVER (PARTITION BY race_id, driver_id, car_number) = 1)"
STREAMED = {
    "drivers": ("t_drivers", "driver_id", "fullName", False),
    "constructors": ("t_constructors", "constructor_id", "name", False),
    "circuits": ("t_circuits", "circuit_id", "name", False),
    "races": ("t_races", "race_id", "officialName", False),
    "race_results": (_ONE_ROW_A_KEY.format("RACE"), "race_id", "laps", True),
    "sprint_results": (_ONE_ROW_A_KEY.format("SPRINT"), "race_id", "laps", True),
    "driver_standings": ("t_driver_standings", "driver_id", "points", True),
    "constructor_standings": ("t_constructor_standings", "constructor_id", "points", True),
}
_WAVES = (("drivers", "constructors", "circuits"), ("races",),
          ("race_results", "sprint_results", "driver_standings", "constructor_standings"))


def _streamed_sql() -> str:
    parts = []
    for name, (table, key, _, moving) in STREAMED.items():
        k = f"{key}::VARCHAR"
        first = f"CASE WHEN {k} LIKE '%5' THEN NULL ELSE 'insert' END" if moving else "'insert'"
        moved = f"WHEN {k} LIKE '%5' THEN 'insert' WHEN {k} LIKE '%7' THEN 'delete'" if moving else ""
        second = f"CASE {moved} WHEN {k} LIKE '%3' THEN 'update' ELSE 'unchanged' END"
        for tag, change in zip(STREAM_TAGS, (first, second), strict=True):
            parts.append(f"SELECT '{name}' AS dataset, '{tag}' AS release_tag, {change} AS change FROM {table}")
    return f"SELECT dataset, release_tag, change, count(*) AS n FROM ({' UNION ALL '.join(parts)}) WHERE change IS NOT NULL GROUP BY ALL"


def land_streamed(spark: SparkSession, folder: str) -> str:
    """Two releases of all datasets as CSV files."""
    r, landing = Retail(spark, folder), scratch(spark, "chain-landing")
    for name, (_, key, changed, moving) in STREAMED.items():
        raw_key = next(raw for raw, clean, _ in DATASETS[name].columns if clean == key)
        text = C(raw_key)
        cleaned = getattr(r, name)
        if name.endswith("_results"):
            # A row a key, but for repeats; on the columns that the rows have just been joined by, so they stay where they are.
            alone = Window.partitionBy(*DATASETS[name].keys)
            cleaned = cleaned.withColumn("_n", F.count(F.lit(1)).over(alone)).filter("_n = 1").drop("_n")
        rows = r.raw(name, extras=False, frame=cleaned).drop("release_tag")
        kind = next(t for raw, _, t in DATASETS[name].columns if raw == changed)
        number = "decimal(18,2)" if kind.startswith("decimal") else "bigint"
        value = F.concat(C(changed), F.lit("*")) if kind == "string" else (C(changed).cast(number) + 1).cast("string")
        # Both releases from one pass: each row goes to those that hold it.
        versions = ((~text.like("%5"), C(changed)), (~text.like("%7"), F.when(text.like("%3"), value).otherwise(C(changed))))
        held = F.filter(F.array(*[
            F.struct(F.lit(tag).alias("tag"), (there if moving else F.lit(True)).alias("there"), as_is.alias("value"))
            for tag, (there, as_is) in zip(STREAM_TAGS, versions, strict=True)]), lambda version: version["there"])
        both = rows.withColumn("_v", F.explode(held)).withColumns({changed: C("_v.value"), "release_tag": C("_v.tag")}).drop("_v")
        csv.write_releases(both, landing, name, STREAM_TAGS)
    return landing


@query("D1 D2 D3 D4 D5 D6 D7 D8 M1 S1 S8", _streamed_sql())
def streamed_releases(spark: SparkSession, folder: str) -> DataFrame:
    """Two releases of all eight datasets landed, streamed, gated, cleaned, checked and merged, parents before children."""
    landing, root = land_streamed(spark, folder), scratch(spark, "chain")
    streams = {name: SnapshotStream(spark, landing, root, name, 1990, points=MONEY) for name in STREAMED}

    def run(name: str, tag: str) -> DataFrame:
        parents = {p: streams[p].table.read() for p, _ in DATASETS[name].references}
        return streams[name].run(tag, parents).select(F.lit(name).alias("dataset"), F.lit(tag).alias("release_tag"), "change", "n")

    found = []
    with ThreadPoolExecutor(4) as pool:
        for tag in STREAM_TAGS:
            for wave in _WAVES:
                found += list(pool.map(lambda name, tag=tag: run(name, tag), wave))
    return union_rows(found).filter("n > 0")
