"""The derived tables of :mod:`tidemark.plans.retail` as common table expressions.

They are written on their own, in the other engine's dialect, so that a mistake in one of the two
derivations shows up as a mismatch.
"""

from __future__ import annotations

import re

SEQ = 2001008000

TABLES: dict[str, str] = {
    "t_drivers": """
        SELECT s_suppkey::VARCHAR AS driver_id, s_name AS driver_name, s_name || ' / ' || n_name AS full_name,
               n_name AS nationality_country_id,
               DATE '1960-01-01' + (s_nationkey * 100)::INTEGER AS date_of_birth
        FROM supplier, nation WHERE s_nationkey = n_nationkey""",
    "t_constructors": """
        SELECT c_custkey::VARCHAR AS constructor_id, c_name AS constructor_name, n_name AS country_id
        FROM customer, nation WHERE c_nationkey = n_nationkey""",
    "t_circuits": """
        SELECT n_nationkey::VARCHAR AS circuit_id, n_name AS circuit_name, r_name AS country_id,
               CASE n_regionkey WHEN 0 THEN 'STREET' WHEN 1 THEN 'STREET' WHEN 2 THEN 'ROAD' ELSE 'RACE' END
                 AS circuit_type
        FROM nation, region WHERE n_regionkey = r_regionkey""",
    "t_races": """
        SELECT o_orderkey AS race_id, date_part('year', o_orderdate)::BIGINT AS season,
               date_part('month', o_orderdate)::BIGINT AS round, o_orderdate::DATE AS race_date,
               lower(o_orderpriority) AS grand_prix_id, 'Order ' || o_orderkey AS race_name,
               c_nationkey::VARCHAR AS circuit_id, c_nationkey || '-' || o_orderstatus AS circuit_layout_id
        FROM orders, customer WHERE o_custkey = c_custkey""",
    "t_lines": """
        SELECT o_orderkey AS race_id, date_part('year', o_orderdate)::BIGINT AS season,
               date_part('month', o_orderdate)::BIGINT AS round, l_suppkey::VARCHAR AS driver_id,
               o_custkey::VARCHAR AS constructor_id, o_orderpriority AS engine_manufacturer_id,
               l_linenumber::VARCHAR AS car_number,
               CASE l_returnflag WHEN 'R' THEN NULL ELSE l_linenumber::BIGINT END AS finish_position,
               CASE WHEN l_returnflag <> 'R' THEN l_linenumber::VARCHAR
                    ELSE CASE l_linenumber WHEN 1 THEN 'DNS' WHEN 2 THEN 'DSQ' WHEN 3 THEN 'DNQ' ELSE 'DNF' END
               END AS finish_status,
               CASE WHEN l_quantity < 49 THEN l_quantity::BIGINT % 24 END AS grid_position,
               CASE WHEN l_quantity < 49 THEN (l_quantity::BIGINT % 24)::VARCHAR ELSE 'PL' END AS grid_status,
               CASE WHEN l_returnflag <> 'R' THEN l_extendedprice::DECIMAL(18,2)
                    WHEN l_tax = 0 THEN 0::DECIMAL(18,2) END AS points,
               l_quantity::BIGINT AS completed_laps,
               CASE WHEN l_returnflag = 'R' THEN
                      CASE l_linenumber WHEN 4 THEN 'Collision' WHEN 5 THEN 'Engine'
                                        WHEN 6 THEN 'Stalled on formation lap' WHEN 7 THEN 'Driver unwell' END
                    WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN 'Gearbox' END AS retirement_reason,
               CASE l_linestatus WHEN 'O' THEN 'RACE' ELSE 'SPRINT' END AS session_type,
               CASE WHEN l_discount > 0 THEN round(l_discount * 100)::BIGINT END AS qualifying_position,
               CASE WHEN l_tax > 0 THEN round(l_tax * 100)::BIGINT END AS pit_stops,
               CASE WHEN l_linenumber > 1 THEN floor(l_extendedprice)::BIGINT END AS gap_ms
        FROM lineitem, orders WHERE l_orderkey = o_orderkey""",
    "t_driver_standings": """
        SELECT season, driver_id, CASE WHEN best < 6 THEN best END AS standing,
               CASE WHEN best < 6 THEN best::VARCHAR ELSE 'EX' END AS standing_status, points,
               best = 1 AS championship_won
        FROM (SELECT date_part('year', l_shipdate)::BIGINT AS season, l_suppkey::VARCHAR AS driver_id,
                     min(l_linenumber)::BIGINT AS best, sum(l_extendedprice::DECIMAL(18,2)) AS points
              FROM lineitem WHERE l_quantity >= 49 GROUP BY 1, 2)""",
    "t_constructor_standings": """
        SELECT season, constructor_id, engine_manufacturer_id,
               CASE entry_category WHEN 'RANKED' THEN best END AS standing,
               CASE entry_category WHEN 'RANKED' THEN best::VARCHAR ELSE 'EX' END AS standing_status, points,
               entry_category = 'RANKED' AND best = 1 AS championship_won, entry_category
        FROM (SELECT date_part('year', o_orderdate)::BIGINT AS season, o_custkey::VARCHAR AS constructor_id,
                     o_orderpriority AS engine_manufacturer_id,
                     CASE o_orderstatus WHEN 'F' THEN 'RANKED' ELSE 'EX' END AS entry_category,
                     min(date_part('month', o_orderdate))::BIGINT AS best,
                     sum(o_totalprice::DECIMAL(18,2)) AS points
              FROM orders GROUP BY 1, 2, 3, 4)""",
    "t_facts": f"""
        SELECT {SEQ}::BIGINT AS _release_seq, race_id, season, round, session_type, driver_id, constructor_id,
               engine_manufacturer_id, car_number, grid_position, grid_status, finish_position, finish_status,
               ifnull(points, 0) AS points, completed_laps, retirement_reason,
               session_type = 'RACE' AND ifnull(finish_position, 0) = 1 AS is_race_win,
               session_type = 'RACE' AND ifnull(finish_position, 0) IN (1, 2, 3) AS is_race_podium,
               ifnull(points, 0) > 0 AS has_points,
               CASE WHEN retirement_reason IS NULL AND least(grid_position, finish_position) > 0
                     AND grid_position IS NOT NULL AND finish_position IS NOT NULL
                    THEN grid_position - finish_position END AS positions_gained,
               qualifying_position, pit_stops, gap_ms
        FROM t_lines""",
    "t_race_dimension": f"""
        SELECT race_id, season, round, race_date, race_name, grand_prix_id, circuit_id, circuit_name, country_id,
               circuit_type, circuit_layout_id, {SEQ}::BIGINT AS _release_seq
        FROM t_races NATURAL JOIN t_circuits""",
    "t_session_results": """
        SELECT t_facts.*, driver_name, constructor_name
        FROM t_facts JOIN t_drivers USING (driver_id) JOIN t_constructors USING (constructor_id)""",
    "t_driver_season": f"""
        SELECT {SEQ}::BIGINT AS _release_seq, season, driver_id, driver_name, nationality_country_id,
               standing AS source_position, standing_status, st.points AS source_points, championship_won,
               ifnull(total, 0) AS calculated_points, ifnull(total, 0) - st.points AS points_difference,
               ifnull(race_total, 0) AS race_points, ifnull(sprint_total, 0) AS sprint_points,
               ifnull(entries, 0) AS race_entries, ifnull(wins, 0) AS race_wins, ifnull(podiums, 0) AS race_podiums
        FROM t_driver_standings st NATURAL JOIN t_drivers
        LEFT JOIN (SELECT season, driver_id, sum(points) AS total,
                          sum(points) FILTER (session_type = 'RACE') AS race_total,
                          sum(points) FILTER (session_type = 'SPRINT') AS sprint_total,
                          count(DISTINCT race_id) FILTER (session_type = 'RACE') AS entries,
                          count(DISTINCT race_id) FILTER (is_race_win) AS wins,
                          count(DISTINCT race_id) FILTER (is_race_podium) AS podiums
                   FROM t_facts GROUP BY ALL) USING (season, driver_id)""",
    "t_cars": """
        SELECT season, constructor_id, engine_manufacturer_id, race_id, session_type, car_number,
               sum(points) AS points, bool_or(is_race_win) AS win, bool_or(is_race_podium) AS podium
        FROM t_facts GROUP BY ALL""",
    "t_constructor_season": f"""
        SELECT {SEQ}::BIGINT AS _release_seq, season, constructor_id, constructor_name, country_id,
               engine_manufacturer_id, entry_category, standing AS source_position, standing_status,
               st.points AS source_points, championship_won,
               ifnull(total, 0) AS calculated_points, ifnull(total, 0) - st.points AS points_difference,
               ifnull(weekends, 0) AS race_weekends, ifnull(entries, 0) AS race_car_entries,
               ifnull(wins, 0) AS race_wins, ifnull(podiums, 0) AS race_podiums
        FROM (SELECT * FROM t_constructor_standings
              QUALIFY entry_category = 'RANKED'
                   OR count(*) FILTER (entry_category = 'RANKED')
                      OVER (PARTITION BY season, constructor_id, engine_manufacturer_id) = 0) st
        NATURAL JOIN t_constructors
        LEFT JOIN (SELECT season, constructor_id, engine_manufacturer_id, sum(points) AS total,
                          count(DISTINCT race_id) FILTER (session_type = 'RACE') AS weekends,
                          count(*) FILTER (session_type = 'RACE') AS entries,
                          count(*) FILTER (win) AS wins, count(*) FILTER (podium) AS podiums
                   FROM t_cars GROUP BY ALL) USING (season, constructor_id, engine_manufacturer_id)""",
    "t_profile": """
        SELECT s.*, race_name, race_date, circuit_name, r.country_id, circuit_type, circuit_layout_id,
               retirement_reason IS NULL AND finish_position IS NOT NULL
                 AND list_position(['DNS', 'DNQ', 'DSQ', 'EX', 'DQ', 'DNPQ'], finish_status) IS NULL AS finished,
               list_position(['DNS', 'DNQ', 'DNPQ', 'WD'], finish_status) IS NULL
                 AND NOT contains(lower(ifnull(retirement_reason, '')), 'formation lap') AS started
        FROM t_session_results s JOIN t_race_dimension r USING (race_id) WHERE session_type = 'RACE'""",
    "t_row_totals": """
        SELECT season, driver_id, sum(points) AS total,
               sum(points) FILTER (session_type = 'RACE') AS race_total,
               sum(points) FILTER (session_type = 'SPRINT') AS sprint_total,
               count(*) FILTER (session_type = 'RACE') AS entries,
               count(*) FILTER (is_race_win) AS wins, count(*) FILTER (is_race_podium) AS podiums
        FROM t_facts GROUP BY ALL""",
    "t_driver_season_rows": f"""
        SELECT {SEQ}::BIGINT AS _release_seq, season, driver_id, driver_name, standing AS source_position,
               standing_status, st.points AS source_points, championship_won,
               ifnull(total, 0) AS calculated_points, ifnull(total, 0) - st.points AS points_difference,
               ifnull(race_total, 0) AS race_points, ifnull(sprint_total, 0) AS sprint_points,
               ifnull(entries, 0) AS race_entries, ifnull(wins, 0) AS race_wins, ifnull(podiums, 0) AS race_podiums
        FROM t_driver_standings st NATURAL JOIN t_drivers LEFT JOIN t_row_totals USING (season, driver_id)""",
    "t_constructor_season_rows": f"""
        SELECT {SEQ}::BIGINT AS _release_seq, season, constructor_id, constructor_name, entry_category,
               standing AS source_position, standing_status, st.points AS source_points, championship_won,
               ifnull(total, 0) AS calculated_points, ifnull(total, 0) - st.points AS points_difference,
               ifnull(weekends, 0) AS race_weekends, ifnull(entries, 0) AS race_car_entries,
               ifnull(wins, 0) AS race_wins, ifnull(podiums, 0) AS race_podiums
        FROM t_constructor_standings st NATURAL JOIN t_constructors
        LEFT JOIN (SELECT season, constructor_id, sum(points) AS total,
                          count(DISTINCT race_id) FILTER (session_type = 'RACE') AS weekends,
                          count(*) FILTER (session_type = 'RACE') AS entries,
                          count(*) FILTER (is_race_win) AS wins, count(*) FILTER (is_race_podium) AS podiums
                   FROM t_facts GROUP BY ALL) USING (season, constructor_id)
        WHERE entry_category = 'RANKED'""",
    # Three releases of the customer table; see tidemark.catalog.state.
    "t_snapshots": """
        SELECT 2024001000::BIGINT AS seq, 'v2024.1.0' AS release_tag, c_custkey, c_name,
               c_mktsegment AS segment, c_nationkey::BIGINT AS nation FROM customer
        UNION ALL
        SELECT 2024002000, 'v2024.2.0', c_custkey, c_name,
               CASE WHEN c_acctbal <= 9000 THEN c_mktsegment END,
               c_nationkey::BIGINT FROM customer WHERE c_acctbal >= 0
        UNION ALL
        SELECT 2024010000, 'v2024.10.0', c_custkey, c_name,
               CASE WHEN c_acctbal > 9500 THEN NULL ELSE c_mktsegment END,
               CASE c_mktsegment WHEN 'MACHINERY' THEN -1 ELSE c_nationkey END::BIGINT
        FROM customer WHERE c_acctbal >= -500 AND NOT (c_mktsegment = 'BUILDING' AND c_acctbal BETWEEN 1000 AND 2000)""",
    "t_versions": """
        SELECT c_custkey, c_name, segment, nation, min(seq) AS valid_from_release,
               max_by(coalesce(next_seq, 0), seq) AS last_next
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY c_custkey ORDER BY seq) AS version
              FROM (SELECT s.*, r.next_seq,
                           CASE WHEN lag(seq) OVER w IS DISTINCT FROM r.prev_seq OR lag(seq) OVER w IS NULL
                                  OR lag(c_name) OVER w IS DISTINCT FROM c_name
                                  OR lag(segment) OVER w IS DISTINCT FROM segment
                                  OR lag(nation) OVER w IS DISTINCT FROM nation THEN 1 ELSE 0 END AS fresh
                    FROM t_snapshots s
                    JOIN (SELECT seq, lag(seq) OVER (ORDER BY seq) AS prev_seq, lead(seq) OVER (ORDER BY seq) AS next_seq
                          FROM (SELECT DISTINCT seq FROM t_snapshots)) r USING (seq)
                    WINDOW w AS (PARTITION BY c_custkey ORDER BY seq)))
        GROUP BY c_custkey, c_name, segment, nation, version""",
    "t_history": """
        SELECT c_custkey, c_name, segment, nation, valid_from_release,
               nullif(last_next, 0) AS valid_to_release FROM t_versions""",
}


def _needed(sql: str, found: list[str]) -> None:
    for name in re.findall(r"\bt_[a-z_]+\b", sql):
        if name in TABLES and name not in found:
            _needed(TABLES[name], found)
            if name not in found:
                found.append(name)


def with_tables(sql: str) -> str:
    """Prefix a statement with the derived tables it mentions, in dependency order."""
    found: list[str] = []
    _needed(sql, found)
    if not found:
        return sql.strip()
    body = sql.strip()
    defined = ",\n".join(f"{name} AS ({TABLES[name]})" for name in found)
    if body[:4].upper() == "WITH":
        return f"WITH {defined},\n{body[4:].lstrip()}"
    return f"WITH {defined}\n{body}"
