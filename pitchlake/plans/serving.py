"""Serving tables behind the dashboard views, for all seasons/teams/matches at once.

The reference computes each view for one selected season, team or match;
here each is one distributed plan over every season, team and match, keyed
by the selection columns so a viewer only filters.

Inputs: Gold fingerprints, Silver shots, Bronze matches/competitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.config import (METRIC_LABELS, METRICS, MOMENTUM_END_MINUTE, PITCH_LENGTH,
                              PITCH_WIDTH, RADAR_HEADROOM, STYLE_AGGRESSIVE, STYLE_HIGH_RATIO,
                              STYLE_LOW_RATIO, STYLE_PASSIVE)
from pitchlake.functions.labels import competition_label, match_label, title_label
from pitchlake.functions.parse import coerce_of
from pitchlake.operators.ranking import positions
from pitchlake.operators.running import running_total

SEASON = ("competition_id", "season_id")


# --------------------------------------------------------------------- catalogue

def competition_options(competitions: DataFrame) -> DataFrame:
    """C14: one selectable label per (competition, season), with its place in sorted order."""
    return positions(competitions.select(*SEASON, "competition_name", "season_name", competition_label().alias("label")),
                     ["competition_name", "season_name", *SEASON])


def gold_row_counts(gold: DataFrame) -> DataFrame:
    return gold.groupBy(*SEASON).agg(F.count(F.lit(1)).alias("gold_rows"))


def season_readiness(competitions: DataFrame, gold: DataFrame) -> DataFrame:
    """Is there Gold data for each catalogued season (all seasons at once)."""
    return readiness_of(competitions, gold_row_counts(gold))


def readiness_of(competitions: DataFrame, counts: DataFrame) -> DataFrame:
    """C15 from ``gold_rows`` per season, as ``plans.pipeline.stored_counts`` reads them from footers."""
    return (competitions.select(*SEASON).distinct()
            .join(counts, list(SEASON), "left")
            .select(*SEASON,
                    F.coalesce(F.col("gold_rows"), F.lit(0)).cast("bigint").alias("gold_rows"),
                    (F.coalesce(F.col("gold_rows"), F.lit(0)) > 0).alias("ready")))


# --------------------------------------------------------------------- landing page

def mean_by_team(gold: DataFrame) -> DataFrame:
    """Mean PPDA and press height per (competition, season, team)."""
    return (gold.where(F.col("team_name").isNotNull())
            .groupBy(*SEASON, "team_name")
            .agg(F.avg("ppda").alias("avg_ppda"), F.avg("press_height").alias("avg_press_height")))


def pressing_leaders(gold: DataFrame, top_n: int = 5) -> DataFrame:
    """The ``top_n`` lowest mean PPDA teams of every season.

    The top-k is a row_number over one season's team averages (teams of one
    season, already aggregated), NULL PPDA last, ties by team name.
    """
    w = Window.partitionBy(*SEASON).orderBy(F.col("avg_ppda").asc_nulls_last(),
                                            F.col("team_name"))
    return (mean_by_team(gold)
            .withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= top_n)
            .select(*SEASON, F.col("rank").cast("int").alias("rank"), "team_name",
                    F.col("avg_ppda").alias("avg_pressing_intensity_ppda"),
                    F.col("avg_press_height").alias("avg_press_height")))


def coerced_matches(matches: DataFrame) -> DataFrame:
    """Ids and scores to integers, unparsable or missing -> 0."""
    cols = []
    for c in matches.columns:
        if c in ("competition_id", "season_id", "match_id", "home_score", "away_score"):
            cols.append(coerce_of(matches, c).alias(c))
        else:
            cols.append(F.col(c))
    return matches.select(*cols)


def ready_seasons(gold: DataFrame) -> DataFrame:
    return gold.select(*SEASON).distinct()


def recent_results(matches: DataFrame, gold: DataFrame) -> DataFrame:
    """C17: results of every season that has Gold data, newest first."""
    m = coerced_matches(matches).join(ready_seasons(gold), list(SEASON), "left_semi")
    return (m.select(*SEASON, "match_id", "match_date", "home_team", "home_score",
                     "away_score", "away_team")
            .orderBy(*SEASON, F.col("match_date").desc_nulls_last(), "match_id"))


# --------------------------------------------------------------------- team page

def league_average(gold: DataFrame, by_competition: bool = False) -> DataFrame:
    """Mean of the five metrics over the team-match rows of a season."""
    keys = list(SEASON) if by_competition else ["season_id"]
    return gold.groupBy(*keys).agg(*[F.avg(m).alias(m) for m in METRICS])


def team_average(gold: DataFrame, by_competition: bool = False) -> DataFrame:
    """Mean of the five metrics per team of a season."""
    keys = list(SEASON) if by_competition else ["season_id"]
    return (gold.where(F.col("team_name").isNotNull())
            .groupBy(*keys, "team_name").agg(*[F.avg(m).alias(m) for m in METRICS]))


def team_profile(gold: DataFrame, by_competition: bool = False) -> DataFrame:
    """Team means beside the league means of the same season."""
    keys = list(SEASON) if by_competition else ["season_id"]
    league = league_average(gold, by_competition).select(
        *keys, *[F.col(m).alias(f"league_{m}") for m in METRICS])
    return team_average(gold, by_competition).join(league, keys, "inner")


def _metric_rows(profile: DataFrame, keys) -> DataFrame:
    """Unpivot the five (team, league) metric pairs to rows, in display order."""
    pairs = F.array(*[
        F.struct(F.lit(i).alias("metric_order"), F.lit(m).alias("metric"),
                 F.col(m).cast("double").alias("value"),
                 F.col(f"league_{m}").cast("double").alias("league_value"))
        for i, m in enumerate(METRICS)])
    return profile.select(*keys, "team_name", F.inline(pairs))


def team_dna(gold: DataFrame, by_competition: bool = False) -> DataFrame:
    """Per metric, value, league value, percent of average and delta."""
    keys = list(SEASON) if by_competition else ["season_id"]
    rows = _metric_rows(team_profile(gold, by_competition), keys)
    pct = F.when(F.col("league_value") == 0, F.lit(0.0)).otherwise(
        F.col("value") / F.col("league_value") * 100)
    return rows.select(*keys, "team_name", "metric", title_label("metric").alias("label"),
                       "value", "league_value", pct.alias("pct_of_avg"),
                       (pct - 100).alias("delta_pct"))


def team_style(gold: DataFrame, by_competition: bool = False) -> DataFrame:
    """Pressing style from team vs league PPDA."""
    keys = list(SEASON) if by_competition else ["season_id"]
    p = team_profile(gold, by_competition)
    team, league = F.col("ppda"), F.col("league_ppda")
    style = (F.when(team < league * STYLE_LOW_RATIO, STYLE_AGGRESSIVE)
             .when(team > league * STYLE_HIGH_RATIO, STYLE_PASSIVE))
    return p.select(*keys, "team_name", F.col("ppda").alias("team_ppda"),
                    F.col("league_ppda"), style.alias("style"))


def radar_long(gold: DataFrame, by_competition: bool = False) -> DataFrame:
    """Radar rows (label, team value, league value) + radial axis max."""
    keys = list(SEASON) if by_competition else ["season_id"]
    p = team_profile(gold, by_competition)
    axis = F.greatest(*[F.col(m).cast("double") for m in METRICS],
                      *[F.col(f"league_{m}").cast("double") for m in METRICS]) * RADAR_HEADROOM
    rows = _metric_rows(p.withColumn("axis_max", axis), keys + ["axis_max"])
    label = None
    for key, text in METRIC_LABELS:
        label = (F.when(F.col("metric") == key, text) if label is None
                 else label.when(F.col("metric") == key, text))
    return rows.select(*keys, "team_name", "metric_order", label.alias("label"),
                       F.col("value").alias("team_value"), "league_value", "axis_max")


def season_options(gold: DataFrame) -> DataFrame:
    """Distinct seasons with their place in sorted order, the latest flagged as the default."""
    latest = gold.agg(F.max("season_id")).scalar()
    return positions(gold.select("season_id").distinct(), ["season_id"]).select(
        "season_id", (F.col("season_id") == latest).alias("is_default"), "position")


def team_options(gold: DataFrame) -> DataFrame:
    """Distinct teams of every season, with their place in sorted order."""
    teams = gold.where(F.col("team_name").isNotNull()).select("season_id", "team_name").distinct()
    return positions(teams, ["team_name"], within=["season_id"])


# --------------------------------------------------------------------- match page

def analyzable_matches(matches: DataFrame, shots: DataFrame) -> DataFrame:
    """Matches that have shots, with their selection label."""
    # distinct first: partial aggregation ships one row per match and map task,
    # so the semi-join never sees a hot match's shots
    with_shots = shots.select("match_id").where(F.col("match_id").isNotNull()).distinct()
    m = coerced_matches(matches)
    return (m.join(with_shots, m["match_id"] == with_shots["match_id"], "left_semi")
            .select(*SEASON, "match_id", "match_date", "home_team", "away_team",
                    "home_score", "away_score", match_label().alias("label")))


def match_sides(matches: DataFrame) -> DataFrame:
    """(match, side, team) for the home and away team of every match."""
    m = coerced_matches(matches)
    return m.select("match_id", F.inline(F.array(
        F.struct(F.lit("home").alias("side"), F.col("home_team").alias("team_name")),
        F.struct(F.lit("away").alias("side"), F.col("away_team").alias("team_name")))))


def cumulative_xg(shots: DataFrame) -> DataFrame:
    """Running xG per (match, team) in (minute, second, feed) order.

    ``cum_xg`` is NULL on a shot whose xG is missing (the running total
    resumes after it); ``shot_seq`` is the 1-based position in that order.
    """
    s = shots.select("match_id", "team_name", "minute", "second", "event_order", "xg")
    r = running_total(s, ["match_id", "team_name"], ["minute", "second"], ["event_order"],
                      "xg", "_cum", position="shot_seq")
    return r.withColumn("cum_xg", F.when(F.col("xg").isNotNull(), F.col("_cum"))).drop("_cum")


def _anchors(sides: DataFrame, cum: DataFrame, end_minute: int) -> DataFrame:
    per_team = cum.groupBy("match_id", "team_name").agg(
        F.max("cum_xg").alias("max_cum"), F.count(F.lit(1)).alias("n_shots"))
    s = sides.join(per_team, ["match_id", "team_name"], "left")
    n = F.coalesce(F.col("n_shots"), F.lit(0))
    final = F.when(n > 0, F.col("max_cum")).otherwise(F.lit(0.0))
    return s.select("match_id", "side", "team_name", F.inline(F.array(
        F.struct(F.lit(0).cast("bigint").alias("seq"), F.lit(0).alias("minute"),
                 F.lit(0.0).alias("cum_xg")),
        F.struct((n + 1).cast("bigint").alias("seq"), F.lit(end_minute).alias("minute"),
                 final.cast("double").alias("cum_xg")))))


def momentum_anchors(matches: DataFrame, shots: DataFrame,
                     end_minute: int = MOMENTUM_END_MINUTE) -> DataFrame:
    """The (0, 0) start and (end_minute, final running xG) end points."""
    sides = match_sides(analyzable_matches(matches, shots))
    return _anchors(sides, cumulative_xg(shots), end_minute)


def match_momentum(matches: DataFrame, shots: DataFrame,
                   end_minute: int = MOMENTUM_END_MINUTE) -> DataFrame:
    """Step series of cumulative xG for both sides of every analyzable match.

    The running totals are computed once and feed both the shot points and the
    anchors (one plan, shared sub-results).
    """
    sides = match_sides(analyzable_matches(matches, shots))
    cum = cumulative_xg(shots)
    points = (cum.join(sides, ["match_id", "team_name"], "inner")
              .select("match_id", "side", "team_name", F.col("shot_seq").alias("seq"),
                      "minute", "cum_xg"))
    return points.unionByName(_anchors(sides, cum, end_minute))


def shot_map(matches: DataFrame, shots: DataFrame) -> DataFrame:
    """Shots of every analyzable match, away side mirrored (two-sided pitch)."""
    m = coerced_matches(matches).select("match_id", "away_team")
    s = shots.join(m, "match_id", "inner")
    away = F.col("team_name") == F.col("away_team")
    return s.select(
        "match_id", "team_name", "player_name", "minute", "second", "event_order", "xg",
        "outcome",
        # mirrored in FLOAT, like the FLOAT coordinates (ANSI would widen to double)
        F.when(away, F.lit(PITCH_LENGTH).cast("float") - F.col("location_x"))
         .otherwise(F.col("location_x")).alias("location_x"),
        F.when(away, F.lit(PITCH_WIDTH).cast("float") - F.col("location_y"))
         .otherwise(F.col("location_y")).alias("location_y"))


def shot_summary(matches: DataFrame, shots: DataFrame) -> DataFrame:
    """Total xG, shots and xG per shot per team of every analyzable match."""
    m = coerced_matches(matches).select("match_id")
    s = (shots.where(F.col("team_name").isNotNull())
         .join(m, shots["match_id"] == m["match_id"], "left_semi"))
    # a sum over only-missing xG is 0, not NULL
    agg = s.groupBy("match_id", "team_name").agg(
        F.coalesce(F.sum("xg"), F.lit(0.0)).alias("total_xg"),
        F.count("match_id").alias("shots"))
    return agg.select("match_id", "team_name", "total_xg", "shots",
                      F.try_divide(F.col("total_xg"), F.col("shots")).alias("xg_per_shot"))


def final_cum_xg(matches: DataFrame, shots: DataFrame) -> DataFrame:
    """Last running xG of each side (0 without shots)."""
    a = momentum_anchors(matches, shots)
    return a.where(F.col("seq") > 0).select("match_id", "side", "team_name",
                                            F.col("cum_xg").alias("final_cum_xg"))


def join_match_info(matches: DataFrame, shots: DataFrame) -> DataFrame:
    """Shots beside the home/away names of their match, with the shooter's side."""
    m = coerced_matches(matches).select("match_id", "home_team", "away_team")
    s = shots.select("match_id", "team_name", "event_order").join(m, "match_id", "inner")
    side = (F.when(F.col("team_name") == F.col("home_team"), "home")
            .when(F.col("team_name") == F.col("away_team"), "away"))
    return s.withColumn("side", side)


def union_lineups(lineups: DataFrame, matches: DataFrame) -> DataFrame:
    """The home line-ups and the away line-ups of every match, unioned by name."""
    m = coerced_matches(matches).select("match_id", "home_team", "away_team")
    home = (lineups.join(m, (lineups["match_id"] == m["match_id"])
                         & (lineups["team_name"] == m["home_team"]), "left_semi")
            .withColumn("side", F.lit("home")))
    away = (lineups.join(m, (lineups["match_id"] == m["match_id"])
                         & (lineups["team_name"] == m["away_team"]), "left_semi")
            .withColumn("side", F.lit("away")))
    # by name: the two parts may list their columns in different orders
    return home.unionByName(away.select("side", *lineups.columns))


def default_season(gold: DataFrame) -> DataFrame:
    """The latest season (the default selection)."""
    return gold.agg(F.max("season_id").alias("default_season_id"))


def row_counts(counts: dict[str, DataFrame]) -> DataFrame:
    """Rows per (table, competition, season), from ``n_rows`` per season of each table."""
    out = None
    for name, df in counts.items():
        c = df.select(F.lit(name).alias("table_name"), *SEASON, "n_rows")
        out = c if out is None else out.unionByName(c)
    return out


def default_team_rows(gold: DataFrame) -> DataFrame:
    """F11 (team page default): Gold rows of the first team, in sorted order, of the
    latest season. The selection is data-derived (scalar subqueries)."""
    latest = gold.agg(F.max("season_id")).scalar()
    season = gold.where(F.col("season_id") == latest)
    first_team = season.where(F.col("team_name").isNotNull()).agg(F.min("team_name")).scalar()
    return season.where(F.col("team_name") == first_team)


def default_match_shots(matches: DataFrame, shots: DataFrame) -> DataFrame:
    """F11 (match page default): shots of the first analyzable match in
    (date, id) order."""
    first = (analyzable_matches(matches, shots)
             .agg(F.min_by("match_id", F.struct(F.col("match_date").isNull(), "match_date", "match_id")))
             .scalar())
    return shots.where(F.col("match_id") == first)
