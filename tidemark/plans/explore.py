"""Exploratory views and queries.

``profile`` below is the race-only view with the extra columns; seasons, venues and dates are
parameters. A window over a whole season or round becomes an aggregate joined back, so no query
sends one season to one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import results as R
from tidemark.functions.measures import count_where, flag, mean_where, percent, quotient, ratio, zero_fill
from tidemark.operators import quality
from tidemark.operators.groups import chunked_running_total, dense_running_total, with_group_totals
from tidemark.operators.pairs import member_pairs
from tidemark.operators.ranking import top_k
from tidemark.session import stored

C = F.col
RACES_PER_CHUNK = 100_000


# --- views --------------------------------------------------------------------------------------

def stamped(frame: DataFrame, release_seq: int) -> DataFrame:
    """A dimension or standings copy that carries its release."""
    return frame.drop("_release_seq").withColumn("_release_seq", F.lit(release_seq).cast("bigint"))


def latest_release(frame: DataFrame, published: DataFrame) -> DataFrame:
    """Rows of the newest published release; the maximum is one scalar."""
    newest = published.agg(F.max("release_seq")).scalar()
    return frame.filter(C("_release_seq") == newest)


def entry_totals(facts: DataFrame, *keys: str) -> DataFrame:
    """Totals that count result rows, not distinct races (the earlier definition)."""
    return facts.groupBy("_release_seq", *keys).agg(
        F.sum(F.when(R.is_race(C("session_type")), C("points")).otherwise(F.lit(0))).alias("race_points"),
        F.sum(F.when(C("session_type") == R.SPRINT, C("points")).otherwise(F.lit(0))).alias("sprint_points"),
        F.sum("points").alias("calculated_points"),
        F.sum(flag(R.is_race(C("session_type")))).alias("race_entries"),
        F.sum(flag(C("is_race_win"))).alias("race_wins"),
        F.sum(flag(C("is_race_podium"))).alias("race_podiums"),
    )


def driver_season_by_rows(standings: DataFrame, drivers: DataFrame, facts: DataFrame,
                          published: DataFrame) -> DataFrame:
    totals = entry_totals(facts, "season", "driver_id")
    joined = (
        latest_release(standings, published)
        .join(totals, ["_release_seq", "season", "driver_id"], "left")
        .join(drivers.select("_release_seq", "driver_id", "driver_name"), ["_release_seq", "driver_id"])
    )
    calculated = zero_fill(C("calculated_points"))
    return joined.select(
        "_release_seq", "season", "driver_id", "driver_name", C("standing").alias("source_position"),
        "standing_status", C("points").alias("source_points"), "championship_won",
        calculated.alias("calculated_points"), (calculated - C("points")).alias("points_difference"),
        *[zero_fill(C(c)).alias(c) for c in
          ("race_points", "sprint_points", "race_entries", "race_wins", "race_podiums")])


def constructor_season_by_rows(standings: DataFrame, constructors: DataFrame, facts: DataFrame,
                               published: DataFrame) -> DataFrame:
    """RANKED entries only, without the engine grain."""
    raced = R.is_race(C("session_type"))
    totals = facts.groupBy("_release_seq", "season", "constructor_id").agg(
        F.sum("points").alias("calculated_points"),
        F.count_distinct(F.when(raced, C("race_id"))).alias("race_weekends"),
        F.sum(flag(raced)).alias("race_car_entries"),
        F.sum(flag(C("is_race_win"))).alias("race_wins"),
        F.sum(flag(C("is_race_podium"))).alias("race_podiums"))
    joined = (
        latest_release(standings.filter(C("entry_category") == "RANKED"), published)
        .join(totals, ["_release_seq", "season", "constructor_id"], "left")
        .join(constructors.select("_release_seq", "constructor_id", "constructor_name"),
              ["_release_seq", "constructor_id"])
    )
    calculated = zero_fill(C("calculated_points"))
    return joined.select(
        "_release_seq", "season", "constructor_id", "constructor_name", "entry_category",
        C("standing").alias("source_position"), "standing_status", C("points").alias("source_points"),
        "championship_won", calculated.alias("calculated_points"),
        (calculated - C("points")).alias("points_difference"),
        *[zero_fill(C(c)).alias(c) for c in
          ("race_weekends", "race_car_entries", "race_wins", "race_podiums")])


def race_performance(facts: DataFrame, races: DataFrame, drivers: DataFrame, constructors: DataFrame,
                     published: DataFrame, extras: Sequence[str] = ()) -> DataFrame:
    """Facts with race, driver and team on release and key. Race attributes join by the large key
    first, where facts and races can share a partitioning; the two name tables follow."""
    def dim(frame: DataFrame, *columns: str) -> DataFrame:
        return frame.select("_release_seq", *columns)

    joined = (
        latest_release(facts, published)
        .join(dim(races, "race_id", "race_name", "race_date", "circuit_name", "country_id", "circuit_type",
                  *[e for e in extras if e in races.columns]), ["_release_seq", "race_id"])
        .join(dim(drivers, "driver_id", "driver_name"), ["_release_seq", "driver_id"])
        .join(dim(constructors, "constructor_id", "constructor_name"), ["_release_seq", "constructor_id"])
    )
    return joined.select(
        "_release_seq", "season", "round", "race_id", "race_name", "race_date", "circuit_name", "country_id",
        "circuit_type", "session_type", "driver_id", "driver_name", "constructor_id", "constructor_name",
        "car_number", "grid_position", "grid_status", "finish_position", "finish_status", "points",
        "completed_laps", "retirement_reason", "positions_gained", "is_race_win", "is_race_podium",
        "has_points", *extras)


def season_progression(facts: DataFrame, races: DataFrame, drivers: DataFrame, published: DataFrame) -> DataFrame:
    """Points per weekend with a running total per driver and season."""
    weekend = latest_release(facts, published).groupBy(
        "_release_seq", "season", "round", "race_id", "driver_id").agg(F.sum("points").alias("weekend_points"))
    # The race joins first, while the rows may still be partitioned by it.
    # It is stored, since the running total reads it for the chunks and for the rows.
    weekend = stored(weekend.join(races.select("_release_seq", "race_id", "race_date"), ["_release_seq", "race_id"]),
                     "weekend")
    # race_id breaks ties where a round has more than one race, and its range bounds a chunk: there
    # is one row per driver and race, so a chunk has at most RACES_PER_CHUNK rows.
    chunk = F.struct("round", F.expr(f"race_id div {RACES_PER_CHUNK}"))
    summed = chunked_running_total(weekend, ["_release_seq", "season", "driver_id"], ["round", "race_id"], chunk,
                                   "weekend_points", "cumulative_calculated_points")
    return (
        summed.join(drivers.select("_release_seq", "driver_id", "driver_name"), ["_release_seq", "driver_id"])
        .select("_release_seq", "season", "round", "race_id", "race_date", "driver_id", "driver_name",
                "weekend_points", "cumulative_calculated_points"))


def race_profile(performance: DataFrame) -> DataFrame:
    """Race rows with started and finished flags; ``performance`` carries the extra columns."""
    reason, status = C("retirement_reason"), C("finish_status")
    return performance.filter(R.is_race(C("session_type"))).withColumns({
        "finished": R.finished(C("finish_position"), status, reason),
        "started": R.started(status, reason),
    })


def seasons_between(frame: DataFrame, first: int, last: int) -> DataFrame:
    return frame.filter(C("season").between(first, last))


# --- shared conditions --------------------------------------------------------------------------

def is_started() -> Column:
    return C("started")


def is_finished() -> Column:
    return C("finished")


def has_scored() -> Column:
    return is_started() & (C("points") > 0)


def is_comparable() -> Column:
    """Both places count: started, finished, and not from the pit lane."""
    return is_started() & is_finished() & (C("grid_position") > 0)


def net_gain() -> Column:
    return C("grid_position") - C("finish_position")


def rows() -> Column:
    return F.count(F.lit(1))


# --- queries ------------------------------------------------------------------------------------

def coverage(profile: DataFrame, as_of: dt.date) -> DataFrame:
    per_race = profile.groupBy("season", "race_id").agg(
        rows().alias("n"), F.min("race_date").alias("d0"), F.max("race_date").alias("d1"),
        count_where(C("race_date") > F.lit(as_of)).alias("future"),
        F.count("qualifying_position").alias("q"), F.count("pit_stops").alias("p"), F.count("gap_ms").alias("g"),
        count_where(is_finished()).alias("fin"), count_where(~is_started()).alias("dns"))
    return per_race.groupBy("season").agg(
        F.sum("n").alias("race_entries"), rows().alias("races"),
        F.min("d0").alias("first_race"), F.max("d1").alias("last_race"),
        F.sum("future").alias("future_dated_entries"), F.sum("q").alias("with_qualifying_position"),
        F.sum("p").alias("with_pit_stop_count"), F.sum("g").alias("with_gap_ms"),
        F.sum("fin").alias("finishers"), F.sum("dns").alias("non_starters"))


def status_breakdown(profile: DataFrame) -> DataFrame:
    return profile.groupBy("finish_status", "retirement_reason", "finished", "started").agg(
        rows().alias("entries"))


def driver_season_rates(seasons: DataFrame, profile: DataFrame, season: int) -> DataFrame:
    """Source and computed season figures with start, finish and scoring rates of one season."""
    rates = profile.filter(C("season") == season).groupBy("driver_id").agg(
        count_where(is_started()).alias("starts"),
        count_where(is_started() & is_finished()).alias("finishes"),
        count_where(has_scored()).alias("scoring_races"),
        mean_where(C("finish_position"), is_finished() & is_started(), 2).alias("mean_finish_when_finished"))
    return seasons.filter(C("season") == season).join(rates, "driver_id").select(
        "driver_name", "source_position", "source_points", "race_points", "sprint_points", "race_wins",
        "race_podiums", "points_difference", "starts", "finishes", "scoring_races",
        percent(C("scoring_races"), C("starts")).alias("scoring_pct"), "mean_finish_when_finished")


def team_contribution(performance: DataFrame, first: int, last: int) -> DataFrame:
    """Each driver's share of the points a team's drivers earned in a season."""
    earned = seasons_between(performance, first, last).groupBy(
        "season", "constructor_id", "constructor_name", "driver_id", "driver_name").agg(
        F.sum("points").alias("earned_points"),
        count_where(R.is_race(C("session_type"))).alias("race_entries"))
    team = with_group_totals(earned, ["season", "constructor_id"], F.sum("earned_points").alias("_team"),
                             store="contribution")
    return team.select(
        "season", "constructor_id", "constructor_name", "driver_id", "driver_name", "earned_points",
        "race_entries", percent(C("earned_points"), C("_team")).alias("share_of_earned_team_points"))


def team_consistency(profile: DataFrame) -> DataFrame:
    """How often both cars of a two-car weekend finished and scored."""
    weekends = profile.groupBy("season", "race_id", "constructor_name").agg(
        rows().alias("entries"), count_where(is_started()).alias("starters"),
        count_where(is_started() & is_finished()).alias("finishers"), count_where(has_scored()).alias("scorers"))
    two_started = (C("entries") == 2) & (C("starters") == 2)
    totals = weekends.groupBy("season", "constructor_name").agg(
        rows().alias("weekends"), count_where(two_started).alias("two_start_weekends"),
        count_where(two_started & (C("finishers") == 2)).alias("both_finished"),
        count_where(two_started & (C("scorers") == 2)).alias("both_scored"))
    return totals.withColumn("double_score_pct", percent(C("both_scored"), C("two_start_weekends")))


def teammate_comparison(profile: DataFrame) -> DataFrame:
    """Head-to-head counts of every pair of team-mates in a season."""
    values = ["started", "finished", "finish_position", "qualifying_position"]
    entries = profile.select("season", "race_id", "constructor_id", "constructor_name", "driver_id",
                             "driver_name", *values)
    pairs = member_pairs(entries, ["season", "race_id", "constructor_id", "constructor_name"], "driver_id",
                         ["driver_name", *values])
    started = C("started_a") & C("started_b")
    finished = started & C("finished_a") & C("finished_b")
    qa, qb = C("qualifying_position_a"), C("qualifying_position_b")
    fa, fb = C("finish_position_a"), C("finish_position_b")

    def weight(condition: Column) -> Column:
        return F.sum(F.when(condition, C("weight")).otherwise(F.lit(0)))

    return pairs.groupBy("season", "constructor_name", C("driver_name_a").alias("driver_a"),
                         C("driver_name_b").alias("driver_b")).agg(
        F.sum("weight").alias("paired_entries"), weight(started).alias("both_started"),
        weight(finished).alias("comparable_finishes"),
        weight(finished & (fa < fb)).alias("race_wins_a"), weight(finished & (fb < fa)).alias("race_wins_b"),
        weight(qa.isNotNull() & qb.isNotNull()).alias("comparable_qualifying"),
        weight(qa < qb).alias("qualifying_wins_a"), weight(qb < qa).alias("qualifying_wins_b"))


def recent_form(profile: DataFrame, rounds: int = 5) -> DataFrame:
    """The last rounds of each season against the earlier ones.

    Rows are folded per round before the last round of the season is known, so it joins small data.
    """
    per_round = profile.groupBy("season", "round", "driver_name").agg(
        count_where(is_started()).alias("starts"), F.sum("points").alias("points"), count_where(has_scored()).alias("scored"))
    last = with_group_totals(per_round, ["season"], F.max("round").alias("_last"), store="rounds")
    period = F.when(C("round") > C("_last") - rounds, f"Last {rounds} rounds").otherwise("Earlier rounds")
    totals = last.groupBy("season", "driver_name", period.alias("period")).agg(
        F.sum("starts").alias("starts"), F.sum("points").alias("race_points"), F.sum("scored").alias("_scored"))
    return totals.select(
        "season", "driver_name", "period", "starts", "race_points",
        ratio(C("race_points"), C("starts"), 2).alias("race_points_per_start"),
        percent(C("_scored"), C("starts")).alias("scoring_pct"))


def circuit_profiles(profile: DataFrame) -> DataFrame:
    pole = (C("grid_position") == 1) & is_started()
    per_race = profile.groupBy("circuit_name", "circuit_type", "race_id").agg(
        count_where(is_started()).alias("starts"), count_where(is_started() & ~is_finished()).alias("out"),
        count_where(pole).alias("p1"), count_where(pole & (C("finish_position") == 1)).alias("p1_won"),
        count_where(is_comparable()).alias("n"), F.sum(F.when(is_comparable(), net_gain())).alias("gain"))
    totals = per_race.groupBy("circuit_name", "circuit_type").agg(
        rows().alias("races"), F.sum("starts").alias("starts"), F.sum("out").alias("non_finishes"),
        F.sum("p1").alias("p1_starts"), F.sum("p1_won").alias("p1_wins"),
        F.sum("n").alias("valid_position_changes"), F.sum("gain").alias("_gain"))
    return totals.select(
        "circuit_name", "circuit_type", "races", "starts", "non_finishes",
        percent(C("non_finishes"), C("starts")).alias("non_finish_pct"), "p1_starts", "p1_wins",
        "valid_position_changes", ratio(C("_gain"), C("valid_position_changes"), 2).alias("mean_net_gain_finishers"))


def venue_history(profile: DataFrame, country: str, last_season: int) -> DataFrame:
    """Winner, grid place of the winner and attrition of each race at one venue."""
    first = C("finish_position") == 1
    return profile.filter((C("country_id") == country) & (C("season") <= last_season)).groupBy(
        "season", "race_id", "race_date", "circuit_layout_id").agg(
        F.max(F.when(first, C("driver_name"))).alias("winner"),
        F.max(F.when(first, C("grid_position"))).alias("winner_grid"),
        count_where(is_started()).alias("starts"), count_where(is_started() & ~is_finished()).alias("non_finishes"),
        count_where(is_comparable()).alias("valid_position_changes"),
        mean_where(net_gain(), is_comparable(), 2).alias("mean_net_gain_finishers"))


def points_reconciliation(driver_seasons: DataFrame, constructor_seasons: DataFrame) -> DataFrame:
    """Every season total that differs from its source, drivers and teams in one list."""
    def one(frame: DataFrame, entity: str) -> DataFrame:
        return frame.filter(C("points_difference") != 0).select(
            F.lit(entity).alias("entity_type"), "season", C(f"{entity}_id").alias("entity_id"),
            "source_points", "calculated_points", "points_difference")

    return one(driver_seasons, "driver").unionByName(one(constructor_seasons, "constructor"))


def points_progression(facts: DataFrame, driver_seasons: DataFrame, season: int) -> DataFrame:
    """Running points of every classified driver in every round of a season, with the gap to the lead.

    Drivers start at the first round and are carried forward over rounds they missed; the calendar
    holds one row per round, so joining it keeps the real rounds and brings the race.
    """
    # Rounds that have been raced; a season's later rounds are not in the results yet.
    raced = facts.filter((C("season") == season) & R.is_race(C("session_type")))
    calendar = raced.groupBy("season", "round").agg(F.min("race_id").alias("race_id"))
    # Scalar subqueries: the ends of the season so far.
    first_round = raced.agg(F.min("round")).scalar()
    last_round = raced.agg(F.max("round")).scalar()
    entrants = driver_seasons.filter(C("season") == season).select("driver_id", "driver_name")
    points_type = facts.schema["points"].dataType
    # Points count once their round has been raced: a sprint alone does not open a round.
    earned = facts.filter(C("season") == season).join(calendar.select("round"), "round", "left_semi").select(
        "driver_id", "round", C("points").alias("p"))
    at_start = entrants.select("driver_id", first_round.alias("round"), F.lit(0).cast(points_type).alias("p"))
    weekend = earned.unionByName(at_start).groupBy("driver_id", "round").agg(F.sum("p").alias("weekend_points"))
    dense = dense_running_total(weekend, "driver_id", "round", "weekend_points", "calculated_points", last_round)
    # Drivers outside the standings are dropped here, as they have no row among the entrants.
    named = dense.join(entrants, "driver_id").join(calendar, "round")
    lead = with_group_totals(named, ["round"], F.max("calculated_points").alias("_lead"), store="progression")
    return lead.select("season", "round", "race_id", "driver_id", "driver_name", "weekend_points",
                       "calculated_points", (C("_lead") - C("calculated_points")).alias("gap_to_calculated_leader"))


def multi_category_entries(standings: DataFrame) -> DataFrame:
    """Teams with more than one standings entry in a season, with the ordered category list.

    Categories are counted first; only the few distinct ones are gathered per team.
    """
    counted = standings.groupBy("season", "constructor_id", "entry_category").agg(rows().alias("n"))
    gathered = counted.groupBy("season", "constructor_id").agg(
        F.sum("n").alias("categories"),
        F.array_sort(F.collect_list(F.when(C("entry_category").isNotNull(), F.struct("entry_category", "n")))).alias("l"))
    names = F.flatten(F.transform("l", lambda e: F.array_repeat(e["entry_category"], e["n"].cast("int"))))
    return gathered.filter(C("categories") > 1).select(
        "season", "constructor_id", "categories", F.array_join(names, ", ").alias("category_list"))


def positions_gained(profile: DataFrame, season: int) -> DataFrame:
    return profile.filter(C("season") == season).groupBy("driver_name").agg(
        count_where(is_started()).alias("starts"), count_where(is_comparable()).alias("comparable_finishes"),
        mean_where(net_gain(), is_comparable(), 2).alias("mean_net_gain"),
        F.median(F.when(is_comparable(), net_gain())).alias("median_net_gain"),
        count_where(~is_finished() & is_started()).alias("non_finishes"),
        count_where(C("grid_position").isNull() | (C("grid_position") <= 0)).alias("missing_or_special_grid"))


def venue_against_season(profile: DataFrame, country: str) -> DataFrame:
    """A driver's points at one venue against the mean of the other races of that season."""
    away = profile.filter(is_started() & (C("country_id") != country)).groupBy("season", "driver_id").agg(
        quotient(F.sum("points"), rows()).alias("_mean"), rows().alias("other_races"))
    here = profile.filter((C("country_id") == country) & is_started())
    return here.join(away, ["season", "driver_id"]).select(
        "season", "driver_name", "constructor_name", "grid_position", "finish_position", "finish_status",
        "retirement_reason", C("points").alias("venue_points"), "other_races",
        F.round("_mean", 2).cast("double").alias("mean_other_race_points"),
        F.round(C("points") - C("_mean"), 2).cast("double").alias("difference_from_other_races"))


def quality_report(silver: dict[str, DataFrame], profile: DataFrame, recent: DataFrame,
                   driver_seasons: DataFrame, constructor_seasons: DataFrame,
                   as_of: dt.date, first: int, last: int) -> DataFrame:
    """Seventeen checks over cleaned tables and views, one row each."""
    def reference(child: str, parent: str, keys: list[str], name: str) -> DataFrame:
        found = quality.check_reference(silver[child], silver[parent], keys, name)
        return found.withColumn("check_name", F.lit(name))

    def groups(name: str, frame: DataFrame, keys: list[str], limit: int) -> DataFrame:
        big = frame.groupBy(*keys).agg(rows().alias("n")).filter(C("n") > limit)
        return quality.failures(name, big)

    def differing(frame: DataFrame) -> DataFrame:
        return seasons_between(frame, first, last).filter(C("source_points") != C("calculated_points"))

    race_keys = ["race_id", "season", "round"]
    # What is counted over single rows of the profile is one aggregate of it.
    in_scope = C("season").between(first, last)
    counted = profile.agg(
        rows().alias("race_profile_join_row_delta"),
        count_where(C("race_date") > F.lit(as_of)).alias("future_dated_results"),
        count_where(in_scope & ~is_finished() & (C("points") > 0)).alias("non_finishers_with_points_recent"))
    results = silver["race_results"].agg((-rows()).alias("race_profile_join_row_delta"), *[
        F.lit(0).cast("bigint").alias(c) for c in counted.columns[1:]])
    both = counted.unionByName(results).agg(*[F.sum(c).alias(c) for c in counted.columns])
    single_rows = both.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("check_name"), C(c).alias("failures")) for c in counted.columns])).alias("x")).select("x.*")
    return quality.union_rows([
        single_rows,
        groups("race_profile_duplicate_grain", profile, ["race_id", "driver_id", "car_number"], 1),
        reference("races", "circuits", ["circuit_id"], "circuits_missing_for_races"),
        reference("race_results", "drivers", ["driver_id"], "drivers_missing_for_race_results"),
        reference("race_results", "constructors", ["constructor_id"], "constructors_missing_for_race_results"),
        reference("race_results", "races", race_keys, "races_missing_for_race_results"),
        reference("sprint_results", "drivers", ["driver_id"], "drivers_missing_for_sprint_results"),
        reference("sprint_results", "constructors", ["constructor_id"], "constructors_missing_for_sprint_results"),
        reference("sprint_results", "races", race_keys, "races_missing_for_sprint_results"),
        reference("driver_standings", "drivers", ["driver_id"], "drivers_missing_for_standings"),
        reference("constructor_standings", "constructors", ["constructor_id"],
                  "constructors_missing_for_standings"),
        groups("more_than_two_recent_team_entries", recent, ["race_id", "constructor_id"], 2),
        quality.failures(f"driver_points_mismatches_{first}_{last}", differing(driver_seasons)),
        quality.failures(f"constructor_points_mismatches_{first}_{last}", differing(constructor_seasons)),
        quality.failures("missing_recent_race_results", quality.missing_references(
            seasons_between(silver["races"], first, last), silver["race_results"], ["race_id"])),
    ])


def latest_points_diagnostic(facts: DataFrame, constructor_seasons: DataFrame, season: int) -> DataFrame:
    """Whether a team's difference is exactly what it earned in the latest round."""
    in_season = facts.filter(C("season") == season)
    per_round = in_season.groupBy("constructor_id", "round").agg(F.sum("points").alias("earned"))
    last_round = in_season.agg(F.max("round")).scalar()
    last = per_round.filter(C("round") == last_round).select(
        "constructor_id", C("round").alias("last_round"), C("earned").alias("last_weekend_points"))
    return constructor_seasons.filter(C("season") == season).join(last, "constructor_id").select(
        "constructor_name", "source_points", "calculated_points", "points_difference", "last_round",
        "last_weekend_points", (C("calculated_points") - C("last_weekend_points")).alias("points_before_last_weekend"),
        (C("points_difference") == C("last_weekend_points")).alias("difference_matches_last_weekend"))


def retirement_breakdown(profile: DataFrame) -> DataFrame:
    outcome = R.outcome_group(is_started(), is_finished(), C("finish_status"), C("retirement_reason"))
    return profile.groupBy("season", outcome.alias("outcome_group")).agg(rows().alias("entries"))


def source_preview(profile: DataFrame, season: int, k: int = 5) -> DataFrame:
    """The first rows of a season in display order; the key columns make the order total."""
    columns = ["season", "round", "race_name", "driver_name", "constructor_name", "grid_position",
               "finish_position", "finish_status", "retirement_reason", "points"]
    first = top_k(profile.filter(C("season") == season), k,
                  [C("round"), C("driver_id"), C("race_id"), C("car_number"), C("points")])
    return first.select(*columns)
