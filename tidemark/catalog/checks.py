"""Data-quality, verification and parity queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.oracle_tables import SEQ
from tidemark.catalog.registry import query
from tidemark.operators import parity, quality
from tidemark.plans import gold, silver, verification
from tidemark.plans.retail import MONEY, TAG, Retail
from tidemark.plans.schema import DATASETS, GOLD_KEYS, TERMINAL_TASKS
from tidemark.session import stored
from tidemark.sources.manifest import table_manifest
from tidemark.sources.tables import literal_rows, read_table

C = F.col


def _sum_checks(items: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS check_name, ({s})::BIGINT AS failures" for n, s in items.items())


#: Rows that the manifests of the stored tables list and that did not arrive.
_LOST_LINES = "l_linenumber = 6 AND l_quantity < 5"
_LOST_ORDERS = "o_orderpriority = '2-HIGH' AND o_orderstatus = 'P'"
_LINES = f"(SELECT * FROM lineitem WHERE NOT ({_LOST_LINES}))"
_ORDERS = f"(SELECT * FROM orders WHERE NOT ({_LOST_ORDERS}))"
_DUP_LINES = f"SELECT count(*) FROM (SELECT 1 FROM {_LINES} GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"


def _listed(spark: SparkSession, folder: str, name: str) -> int:
    """Rows of a given table by its manifest, a row a file, stored before anything is read of it."""
    manifest = stored(table_manifest(spark, f"{folder.rstrip('/')}/{name}.parquet", name), f"manifest-{name}")
    return manifest.agg(F.sum("row_count")).first()[0]


@query("Q1", _sum_checks({
    "null:l_orderkey": "SELECT 0", "null:position": f"SELECT count(*) FROM {_LINES} WHERE l_linenumber = 7",
    "row_count": f"SELECT count(*) FROM lineitem WHERE {_LOST_LINES}", "unique:l_orderkey,l_linenumber": _DUP_LINES}))
def row_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of which some were lost on the way, against the manifest of the table."""
    expected = _listed(spark, folder, "lineitem")
    lines = read_table(spark, folder, "lineitem").filter(f"NOT ({_LOST_LINES})").withColumn("position", F.nullif(C("l_linenumber"), F.lit(7)))
    return quality.check_rows(lines, ["l_orderkey", "l_linenumber"], ["l_orderkey", "position"], expected_count=expected)


@query("Q2 S7", _sum_checks({
    "no_rescued_rows": f"SELECT count(*) FROM {_ORDERS} WHERE o_totalprice > 490000",
    "no_blank_season": f"SELECT count(*) FROM {_ORDERS} WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'P'",
    "row_count": f"SELECT count(*) FROM orders WHERE {_LOST_ORDERS}"}))
def input_gate(spark: SparkSession, folder: str) -> DataFrame:
    """The gate on a raw release in which some rows were rescued, some carry a blank season, and some are missing."""
    expected = _listed(spark, folder, "orders")
    year = F.when((C("o_orderpriority") == "5-LOW") & (C("o_orderstatus") == "P"), "  ").otherwise(
        F.year("o_orderdate").cast("string"))
    raw = read_table(spark, folder, "orders").filter(f"NOT ({_LOST_ORDERS})").select(
        C("o_orderkey").cast("string").alias("id"), year.alias("year"), F.lit(TAG).alias("release_tag"),
        F.when(C("o_totalprice") > 490000, C("o_orderpriority")).alias("_rescued_data"))
    return quality.check_input(raw, expected_count=expected)


@query("Q3", _sum_checks({
    "single_release": "SELECT count(*) FROM orders WHERE year(o_orderdate) <> 1998 OR o_orderstatus = 'P'"}))
def current_release_check(spark: SparkSession, folder: str) -> DataFrame:
    seq = F.when(C("o_orderstatus") != "P", F.year("o_orderdate").cast("bigint"))
    return quality.check_current(read_table(spark, folder, "orders").select(seq.alias("_release_seq")), 1998)


@query("Q4 J4 J10", _sum_checks({
    "reference:orders->customer": "SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)",
    "reference:customer->big orders":
        "SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)"}))
def reference_checks(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select(C("o_custkey").alias("c_custkey"), "o_totalprice")
    customers = read_table(spark, folder, "customer")
    return quality.union_rows([
        quality.check_reference(orders, customers, ["c_custkey"], "orders->customer"),
        quality.check_reference(customers, orders.filter("o_totalprice > 400000"), ["c_custkey"], "customer->big orders")])


@query("Q5", _sum_checks({
    "known_position": "SELECT count(*) FROM lineitem WHERE l_linenumber = 7",
    "small_or_unreturned": "SELECT count(*) FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'",
    "positive_price": "SELECT count(*) FROM lineitem WHERE l_extendedprice <= 0"}))
def declared_expectations(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").withColumn("position", F.nullif(C("l_linenumber"), F.lit(7)))
    return quality.predicate_checks(lines, {
        "known_position": "position > 0", "small_or_unreturned": "l_quantity <= 45 OR l_returnflag <> 'R'",
        "positive_price": "l_extendedprice > 0"})


@query("Q6", _sum_checks({"no_future_season": "SELECT count(*) FROM t_races WHERE season > 2000"}))
def future_season_check(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_future(Retail(spark, folder).races, 2000)


@query("Q7", _sum_checks({"join_row_count": f"""
    SELECT abs((SELECT count(*) FROM t_session_results) - (SELECT count(*) FROM lineitem))"""}))
def join_preservation_check(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    return quality.check_join_preserved(r.session_results, r.race_results, r.sprint_results)


@query("Q8", _sum_checks({
    "nonempty": "SELECT (count(*) = 0)::BIGINT FROM customer",
    "nonnegative:c_acctbal": "SELECT count(*) FROM customer WHERE c_acctbal < 0"}))
def measure_check(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_measure(read_table(spark, folder, "customer"), "c_acctbal")


_SILVER_CHECKS = {
    **{f"null:{c}": f"SELECT count(*) FROM t_lines WHERE session_type = 'RACE' AND {c} IS NULL"
       for c in ("race_id", "season", "round", "driver_id", "constructor_id", "engine_manufacturer_id",
                 "car_number", "finish_status")},
    "unique:race_id,driver_id,car_number":
        """SELECT count(*) FROM (SELECT 1 FROM t_lines WHERE session_type = 'RACE'
                                 GROUP BY race_id, driver_id, car_number HAVING count(*) > 1)""",
    "no_future_season": "SELECT count(*) FROM t_lines WHERE session_type = 'RACE' AND season > 2001",
    "current:races": "SELECT count(*) FROM t_races WHERE season = 1996 AND race_id % 11 <> 0",
    "reference:races": "SELECT count(*) FROM t_lines WHERE session_type = 'RACE' AND race_id % 11 = 0",
    "current:drivers": "SELECT 0", "reference:drivers": "SELECT count(*) FROM t_lines WHERE session_type = 'RACE' AND driver_id LIKE '%7'",
    "current:constructors": "SELECT 0",
    "reference:constructors": "SELECT count(*) FROM t_lines WHERE session_type = 'RACE' AND constructor_id LIKE '%9'",
}


@query("Q1 Q3 Q4 Q6 D5", _sum_checks(_SILVER_CHECKS))
def silver_result_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Everything that must hold before race results may replace the current table. Some parents are missing, and
    races of one season are of an older release."""
    r = Retail(spark, folder)
    required = DATASETS["race_results"].required
    results = stored(r.race_results.select(*required), "race_results")
    old = (C("season") == 1996).cast("bigint")
    parents = {"races": r.races.filter("race_id % 11 <> 0").withColumn("_release_seq", F.lit(SEQ).cast("bigint") - old)}
    for name, key, digit in (("drivers", "driver_id", 7), ("constructors", "constructor_id", 9)):
        parents[name] = getattr(r, name).filter(~C(key).like(f"%{digit}")).withColumn("_release_seq", F.lit(SEQ).cast("bigint"))
    return silver.checks("race_results", results, TAG, parents)


@query("Q13", """
    SELECT * FROM (VALUES ('l_extendedprice', 'double', 'decimal(18,2)'), ('l_partkey', 'bigint', NULL),
                          ('l_price', NULL, 'double')) t(column_name, left_type, right_type)""")
def schema_parity(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    changed = lines.withColumn("l_price", C("l_extendedprice")).withColumn(
        "l_extendedprice", C("l_extendedprice").cast("decimal(18,2)")).drop("l_partkey")
    return parity.schema_diff(spark, lines, changed)


@query("Q14 U3", """
    SELECT 'driver_totals' AS dataset, count(*) AS missing, count(*) AS extra FROM t_driver_season
    WHERE season = 1998 AND driver_id IN (SELECT driver_id FROM t_facts WHERE season = 1998)""")
def independent_recomputation(spark: SparkSession, folder: str) -> DataFrame:
    """Season totals of drivers by a second route: distinct counts over rows instead of race flags. The rows of one season
    reach it with a point too many."""
    r = Retail(spark, folder)
    session = C("session_type")
    points = C("points") + F.when(C("season") == 1998, 1).otherwise(0)
    again = r.facts_from_union.withColumn("points", points).groupBy("season", "driver_id").agg(
        F.sum("points").cast("decimal(38,2)").alias("calculated_points"),
        F.count_distinct(F.when(session == "RACE", C("race_id"))).alias("race_entries"),
        F.count_distinct(F.when(C("is_race_win"), C("race_id"))).alias("race_wins"),
        F.count_distinct(F.when(C("is_race_podium"), C("race_id"))).alias("race_podiums"))
    columns = ["season", "driver_id", "calculated_points", "race_entries", "race_wins", "race_podiums"]
    first = r.driver_season.withColumn("calculated_points", C("calculated_points").cast("decimal(38,2)"))
    covered = again.join(r.driver_standings.select("season", "driver_id"), ["season", "driver_id"], "left_semi")
    with_results = first.join(again.select("season", "driver_id"), ["season", "driver_id"], "left_semi")
    return parity.bag_report("driver_totals", with_results, covered, columns)


@query("D23 J2 J5", """
    SELECT f.season, f.race_id, race_name, f.driver_id, driver_name, constructor_name, finish_status,
           points::DOUBLE AS points
    FROM t_session_results f JOIN t_race_dimension r USING (race_id)
    WHERE (f.season, f.driver_id) NOT IN (SELECT (season, driver_id) FROM t_driver_standings)""")
def standings_coverage_gaps(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    return verification.standings_gaps(r.session_results, r.race_dimension, r.driver_season)


_JOIN_CHECKS = {
    "joined_rows": ("SELECT count(*) FROM t_session_results", "SELECT count(*) FROM t_session_results"),
    "missing_races": ("SELECT 0", "SELECT 0"),
    "missing_display_names": ("SELECT 0", "SELECT 0"),
    "duplicate_joined_keys": ("""SELECT count(*) FROM (SELECT 1 FROM t_session_results
        GROUP BY race_id, session_type, driver_id, car_number HAVING count(*) > 1)""", "SELECT 0"),
    "race_points_preserved": ("SELECT sum(points) FROM t_facts WHERE session_type = 'RACE'",) * 2,
    "sprint_points_preserved": ("SELECT sum(points) FROM t_facts WHERE session_type = 'SPRINT'",) * 2,
}


@query("D24 J9 U2 Q10", """
    SELECT *, CASE WHEN actual = expected THEN 'PASS' ELSE 'FAIL' END AS status FROM (""" + " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, ({a})::DOUBLE AS actual, ({e})::DOUBLE AS expected"
    for n, (a, e) in _JOIN_CHECKS.items()) + ")")
def join_verification(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    # Six checks read the results; only the columns they need are stored.
    results = stored(r.session_results.select(
        "_release_seq", "race_id", "session_type", "driver_id", "car_number", "driver_name", "constructor_name",
        "points"), "session_results")
    return verification.join_verification(results, r.race_dimension)


_MODERN = 1998
# What the entities themselves declare, to be compared with computed careers.
_DECLARED_DRIVERS = """(SELECT s_suppkey::VARCHAR AS id, s_nationkey AS w, s_nationkey * 2 AS p, 1 AS t FROM supplier)"""
_DECLARED_TEAMS = """(SELECT c_custkey::VARCHAR AS id, c_nationkey // 10 AS w, c_nationkey // 5 AS p, 0 AS t FROM customer)"""


def _career_sql(declared: str, computed: str, condition: str) -> str:
    return f"SELECT count(*) FROM {declared} d LEFT JOIN ({computed}) c USING (id) WHERE {condition}"


#: Lines that the release's manifest does not list although they have arrived.
_UNLISTED = "l_linenumber = 7 AND l_returnflag = 'A'"
_WP = "w <> ifnull(wins, 0) OR p <> ifnull(podiums, 0)"
_HISTORY_CHECKS = {
    "driver_career_vs_source": _career_sql(_DECLARED_DRIVERS, """
        SELECT driver_id AS id, count(DISTINCT race_id) FILTER (is_race_win) AS wins,
               count(DISTINCT race_id) FILTER (is_race_podium) AS podiums FROM t_facts GROUP BY 1""", _WP),
    "constructor_career_vs_source": _career_sql(_DECLARED_TEAMS, """
        SELECT constructor_id AS id, count(DISTINCT (race_id, car_number)) FILTER (is_race_win) AS wins,
               count(DISTINCT (race_id, car_number)) FILTER (is_race_podium) AS podiums FROM t_facts GROUP BY 1""", _WP),
    "driver_titles_vs_source": _career_sql(_DECLARED_DRIVERS, """
        SELECT driver_id AS id, count(*) FILTER (championship_won) AS titles FROM t_driver_season GROUP BY 1""",
        "t <> ifnull(titles, 0)"),
    "constructor_titles_vs_source": _career_sql(_DECLARED_TEAMS, """
        SELECT constructor_id AS id, count(*) FILTER (championship_won) AS titles FROM t_constructor_season GROUP BY 1""",
        "t <> ifnull(titles, 0)"),
    "session_unique_key": """SELECT count(*) FROM (SELECT 1 FROM t_facts
        GROUP BY race_id, session_type, driver_id, car_number HAVING count(*) > 1)""",
    "constructor_engine_unique_key": """SELECT count(*) FROM (SELECT 1 FROM t_constructor_season
        GROUP BY season, constructor_id, engine_manufacturer_id HAVING count(*) > 1)""",
    "race_join_coverage": "SELECT 0",
    "modern_session_coverage": f"""SELECT abs((SELECT count(*) FROM t_facts WHERE season >= {_MODERN}) - (
        SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) >= {_MODERN} AND NOT ({_UNLISTED})))""",
    "modern_driver_standings_coverage": f"""SELECT abs((SELECT count(*) FROM t_driver_season WHERE season >= {_MODERN}) - (
        SELECT count(DISTINCT (year(l_shipdate), l_suppkey)) FROM lineitem WHERE l_quantity >= 49 AND year(l_shipdate) >= {_MODERN}))""",
    "modern_constructor_standings_coverage": f"""SELECT abs((SELECT count(*) FROM t_constructor_season WHERE season >= {_MODERN}) - (
        SELECT count(DISTINCT (year(o_orderdate), o_custkey, o_orderpriority)) FROM orders WHERE year(o_orderdate) >= {_MODERN}))""",
    "driver_champions": "SELECT 0",
    "constructor_champions": """SELECT abs((SELECT count(*) FROM t_constructor_standings WHERE championship_won)
        - (SELECT count(*) FROM t_constructor_season WHERE championship_won))""",
    "latest_release_only": "SELECT 0",
    "completed_expansion": "SELECT abs(least(5, (SELECT count(DISTINCT l_linenumber) FROM lineitem WHERE l_linenumber <= 4)) - 5)",
}


@query("D25 A4 A5 J4 U2 Q10", "SELECT *, CASE failures WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
       + _sum_checks(_HISTORY_CHECKS) + ")")
def history_verification(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    declared_drivers = r.table("supplier").select(
        C("s_suppkey").cast("string").alias("driver_id"), C("s_nationkey").cast("string").alias("totalRaceWins"),
        (C("s_nationkey") * 2).cast("string").alias("totalPodiums"), F.lit("1").alias("totalChampionshipWins"))
    declared_teams = r.table("customer").select(
        C("c_custkey").cast("string").alias("constructor_id"),
        F.floor(C("c_nationkey") / 10).cast("string").alias("totalRaceWins"),
        F.floor(C("c_nationkey") / 5).cast("string").alias("totalPodiums"), F.lit("0").alias("totalChampionshipWins"))
    # Markers of an unfinished expansion: the line numbers 1 to 4 stand for four of the five tasks.
    task = F.element_at(F.array(*[F.lit(t) for t in TERMINAL_TASKS]), C("l_linenumber"))
    markers = r.table("lineitem").filter(C("l_linenumber") <= 4).select(
        F.lit(SEQ).cast("bigint").alias("release_seq"), F.lit("a").alias("attempt_id"), task.alias("task_key"))
    state = literal_rows(spark, [(SEQ, "a", 1995)], "release_seq bigint, attempt_id string, min_season bigint")
    # The checks read each table several times, the results without names.
    facts = stored(r.facts.select(
        "_release_seq", "race_id", "season", "round", "session_type", "driver_id", "constructor_id",
        "engine_manufacturer_id", "car_number", "points", "is_race_win", "is_race_podium"), "facts")
    tables = {
        "race_dimension": r.race_dimension, "session_results": facts,
        "driver_season": stored(gold.driver_season(r.driver_standings, r.drivers, facts, SEQ), "drivers"),
        "constructor_season": stored(
            gold.constructor_season(r.constructor_standings, r.constructors, facts, SEQ), "constructors"),
    }
    # The manifest counts the given rows themselves, not what was made of them.
    lines, orders = r.table("lineitem"), r.table("orders")
    modern = orders.filter(F.year("o_orderdate") >= _MODERN)
    manifest = quality.union_rows([
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("dataset"), "row_count") for name, rows in {
            "session_results": lines.filter(f"NOT ({_UNLISTED})").join(modern, C("l_orderkey") == C("o_orderkey"), "left_semi"),
            "driver_season": lines.filter((C("l_quantity") >= 49) & (F.year("l_shipdate") >= _MODERN)).select(
                F.year("l_shipdate"), "l_suppkey").distinct(),
            "constructor_season": modern.select(F.year("o_orderdate"), "o_custkey", "o_orderpriority").distinct()}.items()])
    expected = {row.dataset: row.row_count for row in stored(manifest, "history-manifest").collect()}  # three rows
    return verification.history_verification(
        declared_drivers, declared_teams, tables, r.silver, state, markers, SEQ, 1995, _MODERN, expected)


_PARITY = {
    "race_dimension": ("t_race_dimension", "race_id"),
    "session_results": ("t_session_results", "race_id, session_type, driver_id, car_number"),
    "driver_season": ("t_driver_season", "season, driver_id"),
    "constructor_season": ("t_constructor_season", "season, constructor_id, engine_manufacturer_id"),
}


@query("D26 U3 Q13", " UNION ALL ".join(f"""
    SELECT '{name}' AS dataset, 0::BIGINT AS missing, 0::BIGINT AS extra, (SELECT count(*) FROM {table}) AS row_count,
           (SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {keys} HAVING count(*) > 1)) AS duplicate_keys"""
    for name, (table, keys) in _PARITY.items()))
def gold_parity(spark: SparkSession, folder: str) -> DataFrame:
    """The four gold tables built twice: from one pass over the lines, and from cleaned raw text."""
    r = Retail(spark, folder)
    cleaned = {name: silver.clean(name, r.raw(name, extras=False), TAG, 1995, points=MONEY) for name in r.silver}
    again = gold.build_gold(cleaned, SEQ, lambda name, frame: stored(frame, f"again-{name}"))
    return verification.parity_report({n: (r.stored_gold[n], again[n], GOLD_KEYS[n]) for n in GOLD_KEYS})


#: What the tables lack here, and so the rows without a parent.
_KEPT = {"circuits": "circuit_id <> '3'", "races": "race_id % 13 <> 0", "drivers": "driver_id NOT LIKE '%7'",
         "constructors": "constructor_id NOT LIKE '%9'"}
_TABLE_OF = {"race_results": "t_lines WHERE session_type = 'RACE'", "sprint_results": "t_lines WHERE session_type = 'SPRINT'",
             "races": f"t_races WHERE {_KEPT['races']}", "driver_standings": "t_driver_standings WHERE TRUE",
             "constructor_standings": "t_constructor_standings WHERE TRUE"}


@query("D26 Q4", _sum_checks({
    f"reference:{child}->{parent}": f"SELECT count(*) FROM {_TABLE_OF[child]} AND NOT ({_KEPT[parent]})"
    for child, parent, _ in verification.REFERENCES}))
def reference_report(spark: SparkSession, folder: str) -> DataFrame:
    """All declared references, with some circuits, races, drivers and teams missing."""
    # Each table is the child or the parent of several checks: its keys are written once.
    keys: dict[str, set[str]] = {}
    for child, parent, columns in verification.REFERENCES:
        keys.setdefault(child, set()).update(columns)
        keys.setdefault(parent, set()).update(columns)
    tables = {name: frame.filter(_KEPT.get(name, "TRUE")) for name, frame in Retail(spark, folder).silver.items()}
    return verification.reference_report(
        {name: stored(tables[name].select(*sorted(columns)), f"keys-{name}") for name, columns in keys.items()})


@query("L6 Q3", _sum_checks({
    **{f"gold:{n}": f"SELECT count(*) FROM {_PARITY[n][0]} WHERE season = 1997" for n in GOLD_KEYS},
    "open_history": """SELECT 2 * count(*) FROM supplier WHERE s_acctbal < 0"""}))
def publish_gate(spark: SparkSession, folder: str) -> DataFrame:
    """One season of gold is left from an older release; the open history misses a change of suppliers in the red."""
    r = Retail(spark, folder)
    in_red = r.table("supplier").filter("s_acctbal < 0").select(C("s_suppkey").cast("string").alias("driver_id"),
                                                                F.lit(True).alias("_red"))
    stale = r.drivers.join(in_red, "driver_id", "left").withColumn(
        "full_name", F.when(C("_red"), F.concat("full_name", F.lit(" (old)"))).otherwise(C("full_name"))).drop("_red")
    history = stale.withColumns({"valid_from_release": F.lit(SEQ).cast("bigint"),
                                 "valid_to_release": F.lit(None).cast("bigint")})
    old = (C("season") == 1997).cast("bigint")
    tables = {name: frame.withColumn("_release_seq", C("_release_seq") - old) for name, frame in r.stored_gold.items()}
    return verification.published_check(tables, SEQ, history, r.drivers, r.drivers.columns)
