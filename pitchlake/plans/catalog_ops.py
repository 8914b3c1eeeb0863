"""Single-operator keys: each exercises one operator over the
whole derived tables, through the same library functions the composites use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.functions import labels as LB
from pitchlake.functions import parse as PZ
from pitchlake.operators import gold as G
from pitchlake.operators.running import running_total
from pitchlake.oracle import r6
from pitchlake.plans import pipeline as P
from pitchlake.plans import serving as V
from pitchlake.plans.catalog import GOLD_SELECT, REGISTRY, Query, register
from pitchlake.plans.context import Layers
from pitchlake.session import scratch_lake
from pitchlake.sources import bronze as B


def alias(key: str, of: str) -> None:
    """A survey key that names the same query as an existing one."""
    q = REGISTRY[of]
    REGISTRY[key] = Query(key, q.build, q.oracle)


_TM = "competition_id, season_id, match_id, team_name"
_STRIP = "replace(replace(location, '[', ''), ']', '')"

# ------------------------------------------------------------------ P: scalar expressions


@register("strip_brackets", f"SELECT event_order, {_STRIP} AS location_text FROM bronze_events")
def _strip_brackets(L: Layers) -> DataFrame:
    return L.bronze_events.select("event_order", PZ.strip_brackets("location").alias("location_text"))


@register("split_list", f"""SELECT event_order, CAST(len(split({_STRIP}, ',')) AS INTEGER) AS n_parts,
  split({_STRIP}, ',')[1] AS part_1, split({_STRIP}, ',')[2] AS part_2 FROM bronze_events""")
def _split_list(L: Layers) -> DataFrame:
    parts = PZ.split_list("location")
    return L.bronze_events.select("event_order", F.size(parts).alias("n_parts"),
                                  F.get(parts, 0).alias("part_1"), F.get(parts, 1).alias("part_2"))


@register("list_index", f"""SELECT event_order,
  CASE WHEN location = 'nan' THEN NULL ELSE split({_STRIP}, ',')[1] END AS item_1,
  CASE WHEN location = 'nan' THEN NULL ELSE split({_STRIP}, ',')[2] END AS item_2,
  CASE WHEN location = 'nan' THEN NULL ELSE split({_STRIP}, ',')[3] END AS item_3
  FROM bronze_events""")
def _list_index(L: Layers) -> DataFrame:
    return L.bronze_events.select("event_order", *[PZ.list_index("location", i).alias(f"item_{i}")
                                                   for i in (1, 2, 3)])


@register("cast_int", """SELECT event_order, CAST(player_id AS INTEGER) AS player_id,
  CAST(CAST(CAST(player_id AS VARCHAR) AS DOUBLE) AS INTEGER) AS player_id_from_text,
  CAST(minute AS INTEGER) AS minute FROM bronze_events""")
def _cast_int(L: Layers) -> DataFrame:
    ev = L.bronze_events
    return ev.select("event_order", PZ.int_of(ev, "player_id").alias("player_id"),
                     PZ.to_int(F.col("player_id").cast("string")).alias("player_id_from_text"),
                     PZ.int_of(ev, "minute").alias("minute"))


@register("cast_float", f"""SELECT event_order,
  {r6("CASE WHEN location = 'nan' THEN NULL ELSE TRY_CAST(trim(split(" + _STRIP + ", ',')[1]) AS FLOAT) END", 'x')},
  {r6("CASE WHEN location = 'nan' THEN NULL ELSE TRY_CAST(trim(split(" + _STRIP + ", ',')[2]) AS FLOAT) END", 'y')},
  {r6('shot_statsbomb_xg', 'xg')} FROM bronze_events""")
def _cast_float(L: Layers) -> DataFrame:
    ev = L.bronze_events
    return ev.select("event_order", PZ.coord("location", 1).alias("x"),
                     PZ.coord("location", 2).alias("y"),
                     PZ.float_of(ev, "shot_statsbomb_xg").alias("xg"))


@register("cast_bool_default", """SELECT event_order, under_pressure AS under_pressure_text,
  COALESCE(TRY_CAST(under_pressure AS BOOLEAN), false) AS under_pressure FROM bronze_events""")
def _cast_bool_default(L: Layers) -> DataFrame:
    return L.bronze_events.select(
        "event_order", F.col("under_pressure").alias("under_pressure_text"),
        PZ.to_bool_default_false("under_pressure").alias("under_pressure"))


@register("rename", """SELECT event_order, team AS team_name, player AS player_name,
  possession_team AS possession_team_name, shot_body_part AS body_part, shot_outcome AS outcome
  FROM bronze_events""")
def _rename(L: Layers) -> DataFrame:
    return L.bronze_events.select(
        "event_order", F.col("team").alias("team_name"), F.col("player").alias("player_name"),
        F.col("possession_team").alias("possession_team_name"),
        F.col("shot_body_part").alias("body_part"), F.col("shot_outcome").alias("outcome"))


@register("lateral_alias", f"""SELECT event_order, {r6('start_x', 'start_x')}, {r6('end_x', 'end_x')},
  {r6('end_x - start_x', 'delta_x')} FROM silver_carries""")
def _lateral_alias(L: Layers) -> DataFrame:
    # Spark SQL lateral column alias: delta_x refers to aliases of the same SELECT
    return L.spark.sql(
        "SELECT event_order,"
        " TRY_CAST(nullif(get(split(translate(location, '[]', ''), ','), 0), 'nan') AS FLOAT) AS start_x,"
        " TRY_CAST(nullif(get(split(translate(carry_end_location, '[]', ''), ','), 0), 'nan') AS FLOAT)"
        " AS end_x,"
        " end_x - start_x AS delta_x FROM {c} WHERE type = 'Carry'", c=L.bronze_events)


@register("nullif_div", f"""SELECT {_TM},
  {r6('CAST(high_pressures / nullif(pressures, 0) AS FLOAT)', 'high_turnover_rate')}
  FROM measures WHERE pressures > 0
  UNION ALL SELECT {_TM}, {r6('CAST(count(*) FILTER (location_x > 80) / count(*) AS FLOAT)', 'high_turnover_rate')}
  FROM silver_events WHERE type = 'Pressure' AND team_name IS NULL GROUP BY ALL""")
def _nullif_div(L: Layers) -> DataFrame:
    return G.press_metrics(L.events, L.t).select(*G.TEAM_MATCH, "high_turnover_rate")


@register("case_when", f"""SELECT {_TM}, COUNT(*) AS n_rows, COUNT(location_x) AS n_with_location,
  COUNT(*) FILTER (location_x > 80) AS n_final_third
  FROM silver_events WHERE type = 'Pressure' GROUP BY 1, 2, 3, 4""")
def _case_when(L: Layers) -> DataFrame:
    return G.pressure_counts(L.events, L.t)


alias("count_star", "case_when")


@register("literal_cols", f"""SELECT match_id, team_name, {r6('press_success_rate', 'press_success_rate')},
  {r6('compactness', 'compactness')}, {r6('counter_attack_speed', 'counter_attack_speed')},
  competition_id, season_id FROM gold""")
def _literal_cols(L: Layers) -> DataFrame:
    return L.gold.select("match_id", "team_name", "press_success_rate", "compactness",
                         "counter_attack_speed", "competition_id", "season_id")


@register("carry_gain", f"""SELECT event_order, {r6('end_x - start_x', 'gain')},
  (end_x - start_x) > 10 AS progressive FROM silver_carries""")
def _carry_gain(L: Layers) -> DataFrame:
    gain = F.col("end_x") - F.col("start_x")
    return L.carries.select("event_order", gain.alias("gain"),
                            (gain > L.t.progressive_gain).alias("progressive"))


@register("coerce_numeric_zero", """SELECT match_id, home_score AS home_score_text,
  COALESCE(TRY_CAST(TRY_CAST(home_score AS DOUBLE) AS BIGINT), 0) AS home_score,
  COALESCE(TRY_CAST(TRY_CAST(away_score AS DOUBLE) AS BIGINT), 0) AS away_score,
  COALESCE(TRY_CAST(TRY_CAST(match_date AS DOUBLE) AS BIGINT), 0) AS date_as_number
  FROM bronze_matches""")
def _coerce_numeric_zero(L: Layers) -> DataFrame:
    m = L.bronze_matches
    return m.select("match_id", F.col("home_score").alias("home_score_text"),
                    PZ.coerce_numeric_zero("home_score").alias("home_score"),
                    PZ.coerce_numeric_zero("away_score").alias("away_score"),
                    PZ.coerce_numeric_zero("match_date").alias("date_as_number"))


@register("competition_label", """SELECT competition_id, season_id,
  competition_name || ' (' || season_name || ')' AS label FROM bronze_competitions""")
def _competition_label(L: Layers) -> DataFrame:
    return L.bronze_competitions.select("competition_id", "season_id",
                                        LB.competition_label().alias("label"))


@register("match_label", """SELECT match_id, coalesce(match_date, 'None') || ' | ' || home_team || ' ' ||
  CAST(home_score AS VARCHAR) || '-' || CAST(away_score AS VARCHAR) || ' ' || away_team AS label
  FROM matches_c""")
def _match_label(L: Layers) -> DataFrame:
    return V.coerced_matches(L.bronze_matches).select("match_id", LB.match_label().alias("label"))


@register("flip_away_xy", f"""SELECT s.event_order,
  {r6('CASE WHEN s.team_name = m.away_team THEN 120 - s.location_x ELSE s.location_x END', 'location_x')},
  {r6('CASE WHEN s.team_name = m.away_team THEN 80 - s.location_y ELSE s.location_y END', 'location_y')}
  FROM silver_shots s JOIN matches_c m ON s.match_id = m.match_id""")
def _flip_away_xy(L: Layers) -> DataFrame:
    return V.shot_map(L.bronze_matches, L.shots).select("event_order", "location_x", "location_y")


@register("pct_of_average", f"""SELECT season_id, team_name, metric,
  {r6('CASE WHEN league_value = 0 THEN 0.0 ELSE value / league_value * 100 END', 'pct_of_avg')}
  FROM metric_rows""")
def _pct_of_average(L: Layers) -> DataFrame:
    return V.team_dna(L.gold).select("season_id", "team_name", "metric", "pct_of_avg")


@register("style_label", """SELECT season_id, team_name,
  CASE WHEN ppda < league_ppda * 0.9 THEN 'Aggressive Pressing'
       WHEN ppda > league_ppda * 1.1 THEN 'Passive Block' END AS style FROM profile""")
def _style_label(L: Layers) -> DataFrame:
    return V.team_style(L.gold).select("season_id", "team_name", "style")


@register("metric_label", """SELECT DISTINCT metric, radar_label AS label, label AS title
  FROM metric_rows""")
def _metric_label(L: Layers) -> DataFrame:
    rows = V.team_dna(L.gold).select("metric").distinct()
    return rows.select("metric", LB.metric_label("metric").alias("label"),
                       LB.title_label("metric").alias("title"))


@register("radar_axis_max", f"""SELECT season_id, team_name,
  {r6('''1.2 * greatest(ppda, press_height, high_turnover_rate, defensive_line_height,
        progressive_carry_rate, league_ppda, league_press_height, league_high_turnover_rate,
        league_defensive_line_height, league_progressive_carry_rate)''', 'axis_max')}
  FROM profile""")
def _radar_axis_max(L: Layers) -> DataFrame:
    return V.radar_long(L.gold).select("season_id", "team_name", "axis_max").distinct()


@register("xg_per_shot", f"""SELECT match_id, team_name, {r6('SUM(xg) / COUNT(match_id)', 'xg_per_shot')}
  FROM silver_shots WHERE team_name IS NOT NULL AND match_id IN (SELECT match_id FROM matches_c)
  GROUP BY 1, 2""")
def _xg_per_shot(L: Layers) -> DataFrame:
    return V.shot_summary(L.bronze_matches, L.shots).select("match_id", "team_name", "xg_per_shot")


@register("leaderboard_rename", f"""SELECT competition_id, season_id, team_name,
  {r6('AVG(ppda)', 'avg_pressing_intensity_ppda')}, {r6('AVG(press_height)', 'avg_press_height')}
  FROM gold WHERE team_name IS NOT NULL GROUP BY 1, 2, 3""")
def _leaderboard_rename(L: Layers) -> DataFrame:
    return V.mean_by_team(L.gold).select(
        "competition_id", "season_id", "team_name",
        F.col("avg_ppda").alias("avg_pressing_intensity_ppda"), "avg_press_height")


@register("column_subset", """SELECT match_date, home_team, home_score, away_score, away_team
  FROM matches_c""")
def _column_subset(L: Layers) -> DataFrame:
    return V.coerced_matches(L.bronze_matches).select(
        "match_date", "home_team", "home_score", "away_score", "away_team")


# ------------------------------------------------------------------ F: filters

@register("filter_not_null", "SELECT event_order, type FROM bronze_events WHERE type IS NOT NULL")
def _filter_not_null(L: Layers) -> DataFrame:
    return L.events.select("event_order", "type")


@register("filter_shot", "SELECT event_order, match_id FROM silver_shots")
def _filter_shot(L: Layers) -> DataFrame:
    return L.shots.select("event_order", "match_id")


@register("filter_pressure", "SELECT event_order, match_id FROM silver_pressures")
def _filter_pressure(L: Layers) -> DataFrame:
    return L.pressures.select("event_order", "match_id")


@register("filter_carry", "SELECT event_order, match_id FROM silver_carries")
def _filter_carry(L: Layers) -> DataFrame:
    return L.carries.select("event_order", "match_id")


@register("filter_in_list", """SELECT event_order, type FROM silver_events
  WHERE type IN ('Pressure', 'Interception', 'Tackle', 'Foul Committed', 'Block')""")
def _filter_in_list(L: Layers) -> DataFrame:
    return L.events.where(F.col("type").isin(*L.t.defensive_kinds)).select("event_order", "type")


@register("filter_opp_pass_zone", f"""SELECT event_order, {r6('location_x', 'location_x')}
  FROM silver_events WHERE type = 'Pass' AND location_x < 80""")
def _filter_opp_pass_zone(L: Layers) -> DataFrame:
    return (L.events.where((F.col("type") == "Pass") & (F.col("location_x") < L.t.opp_pass_max_x))
            .select("event_order", "location_x"))


@register("filter_def_zone", f"""SELECT event_order, team_name, {r6('location_x', 'location_x')}
  FROM silver_events WHERE type IN ('Pressure', 'Interception', 'Tackle', 'Foul Committed', 'Block')
  AND location_x > 40""")
def _filter_def_zone(L: Layers) -> DataFrame:
    return (L.events.where(F.col("type").isin(*L.t.defensive_kinds)
                           & (F.col("location_x") > L.t.press_zone_min_x))
            .select("event_order", "team_name", "location_x"))


@register("filter_own_half", f"""SELECT event_order, team_name, {r6('location_x', 'location_x')}
  FROM silver_events WHERE type IN ('Pressure', 'Interception', 'Tackle', 'Foul Committed', 'Block')
  AND location_x < 60""")
def _filter_own_half(L: Layers) -> DataFrame:
    return (L.events.where(F.col("type").isin(*L.t.defensive_kinds)
                           & (F.col("location_x") < L.t.own_half_max_x))
            .select("event_order", "team_name", "location_x"))


@register("marker_final_third", """SELECT event_order,
  COALESCE(location_x > 80, false) AS final_third FROM silver_pressures""")
def _marker_final_third(L: Layers) -> DataFrame:
    return L.pressures.select(
        "event_order",
        F.coalesce(F.col("location_x") > L.t.high_turnover_min_x, F.lit(False)).alias("final_third"))


@register("filter_season", GOLD_SELECT + " WHERE season_id = (SELECT MAX(season_id) FROM gold)")
def _filter_season(L: Layers) -> DataFrame:
    # the default (latest) season's Gold rows; on a stored table this is a partition filter
    latest = L.gold.agg(F.max("season_id")).scalar()
    return L.gold.where(F.col("season_id") == latest)


# ------------------------------------------------------------------ J: joins

alias("join_opponent", "gold_opponent_passes")
alias("join_metrics", "gold_fingerprints")
alias("join_league_average", "team_profile")


@register("join_left_two_key", f"SELECT {_TM}, {r6('press_height', 'press_height')} FROM measures")
def _join_left_two_key(L: Layers) -> DataFrame:
    pm = G.press_metrics(L.events, L.t).select(*G.TEAM_MATCH, "press_height")
    return G.match_teams(L.events).join(pm, list(G.TEAM_MATCH), "left")


@register("join_left_residual", f"SELECT {_TM}, def_actions FROM measures")
def _join_left_residual(L: Layers) -> DataFrame:
    return G.zone_actions_left_join(L.events, L.t)


@register("join_carry_team", f"""SELECT {_TM}, CAST(sum(c.n) AS BIGINT) AS joined_rows,
  CAST(sum(c.hits) AS BIGINT) AS progressive_rows
  FROM silver_events JOIN player_carries c USING (competition_id, season_id, match_id, player_id)
  WHERE type = 'Carry' GROUP BY ALL""")
def _join_carry_team(L: Layers) -> DataFrame:
    return G.carry_join_counts(L.events, L.carries, L.t)


@register("semi_join_matches", """SELECT match_id, competition_id, season_id FROM analyzable""")
def _semi_join_matches(L: Layers) -> DataFrame:
    return V.analyzable_matches(L.bronze_matches, L.shots).select(
        "match_id", "competition_id", "season_id")


@register("join_match_info", """SELECT s.match_id, s.team_name, s.event_order, m.home_team, m.away_team,
  CASE WHEN s.team_name = m.home_team THEN 'home' WHEN s.team_name = m.away_team THEN 'away' END AS side
  FROM silver_shots s JOIN matches_c m ON s.match_id = m.match_id""")
def _join_match_info(L: Layers) -> DataFrame:
    return V.join_match_info(L.bronze_matches, L.shots)


# ------------------------------------------------------------------ A: aggregations

alias("match_teams", "gold_match_teams")


@register("conditional_count", """SELECT match_id, player_id,
  COUNT(*) FILTER (end_x - start_x > 10) AS progressive, COUNT(*) AS carries
  FROM silver_carries WHERE player_id IS NOT NULL GROUP BY 1, 2""")
def _conditional_count(L: Layers) -> DataFrame:
    gain = F.col("end_x") - F.col("start_x")
    return (L.carries.where(F.col("player_id").isNotNull()).groupBy("match_id", "player_id")
            .agg(F.count_if(gain > L.t.progressive_gain).alias("progressive"),
                 F.count(F.lit(1)).alias("carries")))


@register("avg_by_match_team", f"""SELECT {_TM}, {r6('AVG(location_x)', 'avg_x')},
  {r6('AVG(location_y)', 'avg_y')} FROM silver_events GROUP BY 1, 2, 3, 4""")
def _avg_by_match_team(L: Layers) -> DataFrame:
    return L.events.groupBy(*G.TEAM_MATCH).agg(F.avg("location_x").alias("avg_x"),
                                               F.avg("location_y").alias("avg_y"))


@register("group_ordinal", f"SELECT {_TM}, COUNT(*) AS n_events FROM silver_events GROUP BY 1, 2, 3, 4")
def _group_ordinal(L: Layers) -> DataFrame:
    return L.spark.sql(f"SELECT {_TM}, COUNT(*) AS n_events FROM {{e}} GROUP BY 1, 2, 3, 4",
                       e=L.events)


@register("mean_by_team", f"""SELECT competition_id, season_id, team_name, {r6('AVG(ppda)', 'avg_ppda')},
  {r6('AVG(press_height)', 'avg_press_height')} FROM gold WHERE team_name IS NOT NULL
  GROUP BY 1, 2, 3""")
def _mean_by_team(L: Layers) -> DataFrame:
    return V.mean_by_team(L.gold)


@register("team_average", "SELECT season_id, team_name, " + ", ".join(
    r6(m, m) for m in ("ppda", "press_height", "high_turnover_rate", "defensive_line_height",
                       "progressive_carry_rate")) + " FROM team_avg")
def _team_average(L: Layers) -> DataFrame:
    return V.team_average(L.gold)


@register("final_cum_xg", f"""SELECT match_id, side, team_name, {r6('cum_xg', 'final_cum_xg')}
  FROM anchors WHERE seq > 0""")
def _final_cum_xg(L: Layers) -> DataFrame:
    return V.final_cum_xg(L.bronze_matches, L.shots)


@register("unique_values", "SELECT DISTINCT match_id FROM silver_shots WHERE match_id IS NOT NULL")
def _unique_values(L: Layers) -> DataFrame:
    return L.shots.select("match_id").where(F.col("match_id").isNotNull()).distinct()


@register("row_counts", """SELECT 'events' AS table_name, competition_id, season_id, COUNT(*) AS n_rows
  FROM silver_events GROUP BY 2, 3
  UNION ALL SELECT 'shots', competition_id, season_id, COUNT(*) FROM silver_shots GROUP BY 2, 3
  UNION ALL SELECT 'pressures', competition_id, season_id, COUNT(*) FROM silver_pressures GROUP BY 2, 3
  UNION ALL SELECT 'carries', competition_id, season_id, COUNT(*) FROM silver_carries GROUP BY 2, 3
  UNION ALL SELECT 'gold', competition_id, season_id, COUNT(*) FROM gold GROUP BY 2, 3""")
def _row_counts(L: Layers) -> DataFrame:
    paths = {t: P.silver_path(L.root, t) for t in ("events", "shots", "pressures", "carries")}
    paths["gold"] = B.paths(L.root)["gold"]
    return V.row_counts({t: B.stored_counts(L.spark, p) for t, p in paths.items()})


# ------------------------------------------------------------------ W, O: windows and order

@register("cumulative_xg", f"""SELECT match_id, team_name, minute, second, event_order,
  {r6('xg', 'xg')}, CAST(shot_seq AS BIGINT) AS shot_seq, {r6('cum_xg', 'cum_xg')}
  FROM (SELECT *, row_number() OVER w AS shot_seq,
               CASE WHEN xg IS NOT NULL THEN SUM(xg) OVER w END AS cum_xg
        FROM silver_shots
        WINDOW w AS (PARTITION BY match_id, team_name ORDER BY minute ASC NULLS LAST,
                     second ASC NULLS LAST, event_order ASC NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) s""")
def _cumulative_xg(L: Layers) -> DataFrame:
    return V.cumulative_xg(L.shots)


@register("shot_order", """SELECT match_id, team_name, event_order, CAST(row_number() OVER (
  PARTITION BY match_id, team_name ORDER BY minute ASC NULLS LAST, second ASC NULLS LAST,
  event_order ASC NULLS LAST) AS BIGINT) AS position FROM silver_shots""")
def _shot_order(L: Layers) -> DataFrame:
    s = L.shots.select("match_id", "team_name", "minute", "second", "event_order",
                       F.lit(1).alias("one"))
    return running_total(s, ["match_id", "team_name"], ["minute", "second"], ["event_order"],
                         "one", "_n", position="position").select(
        "match_id", "team_name", "event_order", "position")


@register("sorted_options", """SELECT season_id, team_name,
  CAST(row_number() OVER (PARTITION BY season_id ORDER BY team_name) AS INTEGER) AS position
  FROM (SELECT DISTINCT season_id, team_name FROM gold WHERE team_name IS NOT NULL) t""")
def _sorted_options(L: Layers) -> DataFrame:
    return V.team_options(L.gold)


@register("default_season", "SELECT MAX(season_id) AS default_season_id FROM gold")
def _default_season(L: Layers) -> DataFrame:
    return V.default_season(L.gold)


# ------------------------------------------------------------------ U: set operations

_LINEUP_COLS = "match_id, team_name, player_id, player_name, jersey_number, competition_id, season_id"


@register("union_lineups", f"""SELECT 'home' AS side, {_LINEUP_COLS} FROM bronze_lineups l
  WHERE EXISTS (SELECT 1 FROM matches_c m WHERE m.match_id = l.match_id AND m.home_team = l.team_name)
  UNION ALL
  SELECT 'away' AS side, {_LINEUP_COLS} FROM bronze_lineups l
  WHERE EXISTS (SELECT 1 FROM matches_c m WHERE m.match_id = l.match_id AND m.away_team = l.team_name)""")
def _union_lineups(L: Layers) -> DataFrame:
    lineups = L.bronze_lineups.select(*[c.strip() for c in _LINEUP_COLS.split(",")])
    return V.union_lineups(lineups, L.bronze_matches)


@register("union_files", """SELECT event_order, competition_id, season_id, type, minute, shot_outcome
  FROM bronze_events""")
def _union_files(L: Layers) -> DataFrame:
    # files of two kinds of landing, with other columns: shots carry an outcome, the rest has no such column
    root = scratch_lake(L.spark)
    ev = L.bronze_events.select("event_order", "competition_id", "season_id", "type", "minute", "shot_outcome")
    ev.where(F.col("shot_outcome").isNotNull()).write.parquet(f"{root}/files/shots")
    ev.where(F.col("shot_outcome").isNull()).drop("shot_outcome").write.parquet(f"{root}/files/others")
    shots, others = (L.spark.read.parquet(f"{root}/files/{n}") for n in ("shots", "others"))
    return shots.unionByName(others, allowMissingColumns=True)


@register("momentum_anchors", f"""SELECT match_id, side, team_name, seq, minute, {r6('cum_xg', 'cum_xg')}
  FROM anchors""")
def _momentum_anchors(L: Layers) -> DataFrame:
    return V.momentum_anchors(L.bronze_matches, L.shots)



# ------------------------------------------------------------------ F11, S16

alias("readiness", "season_readiness")


@register("filter_team", GOLD_SELECT.replace("FROM gold", """FROM gold
  WHERE season_id = (SELECT MAX(season_id) FROM gold)
    AND team_name = (SELECT MIN(team_name) FROM gold
                     WHERE season_id = (SELECT MAX(season_id) FROM gold))"""))
def _filter_team(L: Layers) -> DataFrame:
    return V.default_team_rows(L.gold)


@register("filter_match", f"""SELECT match_id, team_name, player_name, minute, second, {r6('xg', 'xg')},
  event_order FROM silver_shots
  WHERE match_id = (SELECT match_id FROM analyzable ORDER BY match_date NULLS LAST, match_id LIMIT 1)""")
def _filter_match(L: Layers) -> DataFrame:
    return V.default_match_shots(L.bronze_matches, L.shots).select(
        "match_id", "team_name", "player_name", "minute", "second", "xg", "event_order")
