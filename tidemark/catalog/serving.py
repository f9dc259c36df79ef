"""Dashboard datasets and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.catalog.registry import query
from tidemark.plans import dashboard
from tidemark.plans.gold import preferred_standings
from tidemark.plans.retail import Retail
from tidemark.session import stored

_STANDINGS = """source_points::DOUBLE AS source_points, calculated_points::DOUBLE AS calculated_points,
    points_difference::DOUBLE AS points_difference"""

_LABELS = """ifnull(source_position::VARCHAR, standing_status) AS position_label, source_position,
    ifnull(source_position, 9999) AS standing_order, standing_status"""


@query("D14 O2", f"""
    SELECT season, driver_id, driver_name, nationality_country_id, {_LABELS}, {_STANDINGS},
           race_points::DOUBLE AS race_points, sprint_points::DOUBLE AS sprint_points,
           race_entries, race_wins, race_podiums
    FROM t_driver_season""")
def dashboard_drivers(spark: SparkSession, folder: str) -> DataFrame:
    view = dashboard.driver_standings_view(Retail(spark, folder).driver_season)
    return view.orderBy(*dashboard.standings_order("driver_name"))


@query("D15 W2", f"""
    SELECT season, constructor_id, constructor_name, country_id, engine_manufacturer_id, {_LABELS}, {_STANDINGS},
           CASE count(*) OVER (PARTITION BY season, constructor_id) WHEN 1 THEN constructor_name
                ELSE constructor_name || ' / ' || upper(engine_manufacturer_id) END AS team_entry,
           race_weekends, race_car_entries, race_wins, race_podiums
    FROM t_constructor_season""")
def dashboard_constructors(spark: SparkSession, folder: str) -> DataFrame:
    view = dashboard.constructor_standings_view(Retail(spark, folder).constructor_season)
    return view.orderBy(*dashboard.standings_order("constructor_name"))


_DRIVER_CAREER = """
    d_career AS (
      SELECT driver_id, driver_name, min(season) AS first_season, max(season) AS last_season,
             count(DISTINCT race_id) AS race_entries, count(DISTINCT race_id) FILTER (is_race_win) AS race_wins,
             count(DISTINCT race_id) FILTER (is_race_podium) AS race_podiums,
             (SELECT count(*) FROM t_driver_standings t
              WHERE t.driver_id = f.driver_id AND championship_won) AS championships
      FROM t_facts f JOIN t_drivers USING (driver_id) WHERE session_type = 'RACE' GROUP BY f.driver_id, driver_name),
    d_ranked AS (
      SELECT *, row_number() OVER (ORDER BY championships DESC, race_wins DESC, driver_id) AS titles_rank,
             row_number() OVER (ORDER BY race_wins DESC, race_podiums DESC, driver_id) AS wins_rank,
             row_number() OVER (ORDER BY race_podiums DESC, race_wins DESC, driver_id) AS podiums_rank
      FROM d_career)"""

_CONSTRUCTOR_CAREER = """
    c_totals AS (
      SELECT constructor_id, min(season) AS first_season, max(season) AS last_season,
             count(DISTINCT race_id) AS race_weekends,
             count(DISTINCT (race_id, car_number)) FILTER (is_race_win) AS race_wins,
             count(DISTINCT (race_id, car_number)) FILTER (is_race_podium) AS race_podiums
      FROM t_facts WHERE session_type = 'RACE' GROUP BY 1),
    c_titles AS (SELECT constructor_id, count(*) AS championships FROM t_constructor_season
                 WHERE championship_won GROUP BY 1),
    c_ranked AS (
      SELECT *, row_number() OVER (ORDER BY championships DESC, race_wins DESC, constructor_id) AS titles_rank,
             row_number() OVER (ORDER BY race_wins DESC, race_podiums DESC, constructor_id) AS wins_rank,
             row_number() OVER (ORDER BY race_podiums DESC, race_wins DESC, constructor_id) AS podiums_rank
      FROM (SELECT constructor_id, constructor_name, c_totals.* EXCLUDE (constructor_id),
                   ifnull(championships, 0) AS championships
            FROM c_totals JOIN t_constructors USING (constructor_id) LEFT JOIN c_titles USING (constructor_id)))"""


def _driver_career(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    # Titles are in the standings; the season table would only add computed totals to them.
    return dashboard.driver_career(r.facts, r.driver_standings, r.drivers)


def _constructor_career(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    return dashboard.constructor_career(r.facts, preferred_standings(r.constructor_standings), r.constructors)


@query("D16 W1 A4", f"WITH {_DRIVER_CAREER} SELECT * FROM d_ranked")
def dashboard_driver_career(spark: SparkSession, folder: str) -> DataFrame:
    ranked = dashboard.with_career_ranks(stored(_driver_career(spark, folder), "careers"), "driver_id")
    return ranked.orderBy(*dashboard.career_order("driver_id"))


@query("D17 W1 A5", f"WITH {_CONSTRUCTOR_CAREER} SELECT * FROM c_ranked")
def dashboard_constructor_career(spark: SparkSession, folder: str) -> DataFrame:
    ranked = dashboard.with_career_ranks(stored(_constructor_career(spark, folder), "careers"), "constructor_id")
    return ranked.orderBy(*dashboard.career_order("constructor_id"))


_RESULTS = """
    SELECT f._release_seq, f.season, f.round, f.race_id,
           printf('%02d', f.round) || ' - ' || upper(replace(grand_prix_id, '-', ' ')) AS grand_prix,
           race_name, race_date, circuit_id, circuit_name, r.country_id, session_type, driver_id, driver_name,
           constructor_id, constructor_name, car_number, grid_position, grid_status, finish_position, finish_status,
           ifnull(finish_position, 9999) AS classification_order,
           if(finish_position IS NULL, finish_status, 'Classified') AS result_status, points::DOUBLE AS points,
           completed_laps, retirement_reason, positions_gained, is_race_win, is_race_podium, has_points
    FROM t_session_results f LEFT JOIN t_race_dimension r USING (race_id)"""


@query("D18 P13 P19 P20", _RESULTS)
def dashboard_results(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    return dashboard.race_results_view(r.session_results, r.race_dimension)


_DRIVER_WINS = """
    SELECT season, driver_id, driver_name, count(DISTINCT race_id) AS race_wins
    FROM t_session_results WHERE is_race_win GROUP BY ALL"""
_CONSTRUCTOR_WINS = """
    SELECT season, constructor_id, constructor_name, count(DISTINCT (race_id, car_number)) AS race_wins
    FROM t_session_results WHERE is_race_win GROUP BY ALL"""


@query("D19", _DRIVER_WINS)
def dashboard_drivers_wins(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    return dashboard.driver_wins(r.facts, r.drivers)


@query("D20", _CONSTRUCTOR_WINS)
def dashboard_constructors_wins(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    return dashboard.constructor_wins(r.facts, r.constructors)


@query("D21", """
    SELECT nationality_country_id, season, sum(race_wins)::BIGINT AS sum_race_wins,
           sum(calculated_points)::DOUBLE AS sum_calculated_points
    FROM t_driver_season WHERE season >= 1997 AND race_wins > 0 GROUP BY 1, 2""")
def dashboard_widget(spark: SparkSession, folder: str) -> DataFrame:
    view = dashboard.driver_standings_view(Retail(spark, folder).driver_season)
    return dashboard.widget(view, ["nationality_country_id", "season"], ["race_wins", "calculated_points"],
                            ["season >= 1997", "race_wins > 0"])


def _career_summary_sql(career: str, ranked: str, entity: str) -> str:
    return f"""
    WITH {career}
    SELECT count(*) AS row_count, count(DISTINCT {entity}_id) AS identities,
           count(*) FILTER ({entity}_name IS NULL) AS missing_names, sum(championships)::BIGINT AS titles,
           sum(race_wins)::BIGINT AS wins,
           count(*) FILTER (titles_rank <= 10 AND championships > 0) AS top_titles,
           count(*) FILTER (wins_rank <= 10 AND race_wins > 0) AS top_wins,
           count(*) FILTER (podiums_rank <= 10 AND race_podiums > 0) AS top_podiums
    FROM {ranked}"""


@query("D22 A7", _career_summary_sql(_DRIVER_CAREER, "d_ranked", "driver"))
def driver_career_summary(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.career_summary(stored(_driver_career(spark, folder), "careers"), "driver")


@query("D22", _career_summary_sql(_CONSTRUCTOR_CAREER, "c_ranked", "constructor"))
def constructor_career_summary(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.career_summary(stored(_constructor_career(spark, folder), "careers"), "constructor")


@query("D22", f"""
    SELECT season, count(*) AS row_count, sum(race_wins)::BIGINT AS race_wins,
           count(*) FILTER (race_wins <= 0) AS invalid_winners
    FROM ({_DRIVER_WINS}) GROUP BY 1""")
def drivers_wins_summary(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    return dashboard.wins_summary(dashboard.driver_wins(r.facts, r.drivers))


@query("D22", f"""
    SELECT season, session_type, count(*) AS row_count, sum(points::DECIMAL(18,2))::DOUBLE AS points,
           count(*) FILTER (driver_name IS NULL OR constructor_name IS NULL OR race_name IS NULL) AS missing_names
    FROM ({_RESULTS}) GROUP BY 1, 2""")
def results_summary(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    return dashboard.results_summary(dashboard.race_results_view(r.session_results, r.race_dimension))


def _annual_sql(entity: str) -> str:
    return f"""
    SELECT season, count(*) AS row_count, sum(source_points)::DOUBLE AS source_points,
           sum(calculated_points)::DOUBLE AS calculated_points, sum(points_difference)::DOUBLE AS difference,
           count(*) FILTER ({entity}_name IS NULL) AS missing_names,
           max({entity}_name) FILTER (source_position = 1) AS leader,
           (max(source_points) FILTER (source_position = 1))::DOUBLE AS leader_points
    FROM t_{entity}_season GROUP BY 1"""


@query("D22 A14", _annual_sql("driver"))
def drivers_annual_summary(spark: SparkSession, folder: str) -> DataFrame:
    view = dashboard.driver_standings_view(Retail(spark, folder).driver_season)
    return dashboard.annual_summary(view, "driver")


@query("D22 A14", _annual_sql("constructor"))
def constructors_annual_summary(spark: SparkSession, folder: str) -> DataFrame:
    view = dashboard.constructor_standings_view(Retail(spark, folder).constructor_season)
    return dashboard.annual_summary(view, "constructor")
