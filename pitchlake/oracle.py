"""DuckDB oracle SQL: the *naive* form of every query, for differential tests.

The engine uses rewritten plans (single-pass Gold, aggregate-then-join carry
weighting, two-level running totals); the oracle states each metric by its
definition (one correlated count or mean per team and match, one window per
key), so agreement checks the rewrites. Every float result is compared as
DOUBLE rounded to 6 places on both sides.

All oracles start from the adapter CTEs (``pitchlake.sources.adapter``),
which read the pre-registered ``events`` view.
"""

from __future__ import annotations

from pitchlake.config import DEFENSIVE_KINDS
from pitchlake.sources.adapter import duckdb_ctes

_KINDS = ", ".join(f"'{k}'" for k in DEFENSIVE_KINDS)


def r6(expr: str, name: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {name}"


def _coord(col: str, i: int) -> str:
    return (f"CASE WHEN {col} IS NULL OR trim({col}) IN ('nan', 'NaN', 'None', '') THEN NULL "
            f"ELSE TRY_CAST(trim(split(replace(replace({col}, '[', ''), ']', ''), ',')[{i}]) AS FLOAT) END")


SILVER_CTES = f"""
 silver_events AS (
  SELECT CAST(match_id AS BIGINT) AS match_id, CAST(team_id AS INTEGER) AS team_id,
         team AS team_name, CAST(player_id AS INTEGER) AS player_id, player AS player_name,
         type, CAST(period AS INTEGER) AS period, CAST(minute AS INTEGER) AS minute,
         CAST(second AS INTEGER) AS second,
         {_coord('location', 1)} AS location_x, {_coord('location', 2)} AS location_y,
         possession_team AS possession_team_name, play_pattern,
         event_order, competition_id, season_id
  FROM bronze_events WHERE type IS NOT NULL),
 silver_shots AS (
  SELECT CAST(match_id AS BIGINT) AS match_id, team AS team_name,
         CAST(player_id AS INTEGER) AS player_id, player AS player_name,
         CAST(minute AS INTEGER) AS minute, CAST(second AS INTEGER) AS second,
         CAST(shot_statsbomb_xg AS FLOAT) AS xg,
         {_coord('location', 1)} AS location_x, {_coord('location', 2)} AS location_y,
         shot_body_part AS body_part, shot_outcome AS outcome,
         COALESCE(TRY_CAST(under_pressure AS BOOLEAN), false) AS under_pressure,
         event_order, competition_id, season_id
  FROM bronze_events WHERE type = 'Shot'),
 silver_pressures AS (
  SELECT CAST(match_id AS BIGINT) AS match_id, CAST(team_id AS INTEGER) AS team_id,
         team AS team_name, {_coord('location', 1)} AS location_x,
         {_coord('location', 2)} AS location_y,
         CAST(minute AS INTEGER) AS minute, CAST(second AS INTEGER) AS second,
         event_order, competition_id, season_id
  FROM bronze_events WHERE type = 'Pressure'),
 silver_carries AS (
  SELECT match_id, player_id, player_name, start_x, start_y, end_x, end_y,
         end_x - start_x AS delta_x, end_y - start_y AS delta_y,
         event_order, competition_id, season_id
  FROM (SELECT CAST(match_id AS BIGINT) AS match_id, CAST(player_id AS INTEGER) AS player_id,
               player AS player_name,
               {_coord('location', 1)} AS start_x, {_coord('location', 2)} AS start_y,
               {_coord('carry_end_location', 1)} AS end_x,
               {_coord('carry_end_location', 2)} AS end_y,
               event_order, competition_id, season_id
        FROM bronze_events WHERE type = 'Carry') c),
 silver_lineups AS (
  SELECT CAST(match_id AS BIGINT) AS match_id, team_name, CAST(player_id AS INTEGER) AS player_id,
         player_name, CAST(jersey_number AS INTEGER) AS jersey_number, competition_id, season_id
  FROM bronze_lineups)"""

# Gold from the metric definitions: one row per (match, team) that the events
# name, and for each metric one correlated count or mean over the events it is defined on.
_HERE = ("{e}.competition_id = k.competition_id AND {e}.season_id = k.season_id "
         "AND {e}.match_id = k.match_id")


def _over(what: str, where: str, source: str = "silver_events e") -> str:
    return f"(SELECT {what} FROM {source} WHERE {_HERE.format(e='e')} AND {where})"


_OWN = "e.team_name = k.team_name"
GOLD_CTES = f"""
 named AS (SELECT DISTINCT competition_id, season_id, match_id, team_name FROM silver_events),
 line_up AS (SELECT competition_id, season_id, match_id, list(team_name) AS teams FROM named GROUP BY ALL),
 player_carries AS (
  SELECT competition_id, season_id, match_id, player_id, count(*) AS n,
         count(*) FILTER (end_x - start_x > 10) AS hits
  FROM silver_carries WHERE player_id IS NOT NULL GROUP BY ALL),
 measures AS (
  SELECT k.*,
   {_over('count(*)', "e.team_name <> k.team_name AND e.type = 'Pass' AND e.location_x < 80")} AS opp_passes,
   {_over('count(*)', f"{_OWN} AND e.type IN ({_KINDS}) AND e.location_x > 40")} AS def_actions,
   {_over('count(*)', f"{_OWN} AND e.type = 'Pressure'")} AS pressures,
   {_over('count(*)', f"{_OWN} AND e.type = 'Pressure' AND e.location_x > 80")} AS high_pressures,
   {_over('avg(e.location_x)', f"{_OWN} AND e.type = 'Pressure'")} AS press_height,
   {_over('avg(e.location_x)', f"{_OWN} AND e.type IN ({_KINDS}) AND e.location_x < 60")} AS defensive_line_height,
   {_over('sum(c.n)', f"{_OWN} AND e.type = 'Carry'",
          "silver_events e JOIN player_carries c USING (competition_id, season_id, match_id, player_id)")} AS carry_pairs,
   {_over('sum(c.hits)', f"{_OWN} AND e.type = 'Carry'",
          "silver_events e JOIN player_carries c USING (competition_id, season_id, match_id, player_id)")} AS carry_hits
  FROM named k),
 gold AS (
  SELECT match_id, team_name, CAST(opp_passes / nullif(def_actions, 0) AS FLOAT) AS ppda, press_height,
         CAST(high_pressures / nullif(pressures, 0) AS FLOAT) AS high_turnover_rate, defensive_line_height,
         CAST(carry_hits / nullif(carry_pairs, 0) AS FLOAT) AS progressive_carry_rate,
         CAST(0.5 AS DOUBLE) AS press_success_rate, CAST(0.5 AS DOUBLE) AS compactness,
         CAST(0.5 AS DOUBLE) AS counter_attack_speed, competition_id, season_id
  FROM measures)"""

# Matches with ids and scores coerced to integers (unparsable -> 0).
SERVING_CTES = """
 matches_c AS (
  SELECT COALESCE(TRY_CAST(TRY_CAST(competition_id AS DOUBLE) AS BIGINT), 0) AS competition_id,
         COALESCE(TRY_CAST(TRY_CAST(season_id AS DOUBLE) AS BIGINT), 0) AS season_id,
         COALESCE(TRY_CAST(TRY_CAST(match_id AS DOUBLE) AS BIGINT), 0) AS match_id,
         match_date, home_team, away_team,
         COALESCE(TRY_CAST(TRY_CAST(home_score AS DOUBLE) AS BIGINT), 0) AS home_score,
         COALESCE(TRY_CAST(TRY_CAST(away_score AS DOUBLE) AS BIGINT), 0) AS away_score
  FROM bronze_matches),
 league_avg AS (
  SELECT season_id, AVG(ppda) AS league_ppda, AVG(press_height) AS league_press_height,
         AVG(high_turnover_rate) AS league_high_turnover_rate,
         AVG(defensive_line_height) AS league_defensive_line_height,
         AVG(progressive_carry_rate) AS league_progressive_carry_rate
  FROM gold GROUP BY season_id),
 team_avg AS (
  SELECT season_id, team_name, AVG(ppda) AS ppda, AVG(press_height) AS press_height,
         AVG(high_turnover_rate) AS high_turnover_rate,
         AVG(defensive_line_height) AS defensive_line_height,
         AVG(progressive_carry_rate) AS progressive_carry_rate
  FROM gold WHERE team_name IS NOT NULL GROUP BY season_id, team_name),
 profile AS (SELECT t.*, l.league_ppda, l.league_press_height, l.league_high_turnover_rate,
                    l.league_defensive_line_height, l.league_progressive_carry_rate
             FROM team_avg t JOIN league_avg l USING (season_id)),
 metric_rows AS (
  SELECT season_id, team_name, 0 AS metric_order, 'ppda' AS metric, 'Ppda' AS label,
         'Pressing Intensity (PPDA)' AS radar_label, CAST(ppda AS DOUBLE) AS value,
         CAST(league_ppda AS DOUBLE) AS league_value FROM profile
  UNION ALL SELECT season_id, team_name, 1, 'press_height', 'Press Height', 'Press Height',
         press_height, league_press_height FROM profile
  UNION ALL SELECT season_id, team_name, 2, 'high_turnover_rate', 'High Turnover Rate',
         'High Turnovers', high_turnover_rate, league_high_turnover_rate FROM profile
  UNION ALL SELECT season_id, team_name, 3, 'defensive_line_height', 'Defensive Line Height',
         'Defensive Line', defensive_line_height, league_defensive_line_height FROM profile
  UNION ALL SELECT season_id, team_name, 4, 'progressive_carry_rate', 'Progressive Carry Rate',
         'Prog. Carries', progressive_carry_rate, league_progressive_carry_rate FROM profile),
 analyzable AS (
  SELECT * FROM matches_c WHERE match_id IN (SELECT match_id FROM silver_shots WHERE match_id IS NOT NULL)),
 sides AS (
  SELECT match_id, 'home' AS side, home_team AS team_name FROM analyzable
  UNION ALL SELECT match_id, 'away', away_team FROM analyzable),
 shot_cum AS (
  SELECT match_id, team_name, minute, xg,
         row_number() OVER w AS shot_seq,
         CASE WHEN xg IS NOT NULL THEN SUM(xg) OVER w END AS cum_xg
  FROM silver_shots
  WINDOW w AS (PARTITION BY match_id, team_name ORDER BY minute ASC NULLS LAST,
               second ASC NULLS LAST, event_order ASC NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
 anchors AS (
  SELECT s.match_id, s.side, s.team_name, CAST(0 AS BIGINT) AS seq, 0 AS minute, CAST(0.0 AS DOUBLE) AS cum_xg
  FROM sides s
  UNION ALL
  SELECT s.match_id, s.side, s.team_name, CAST(COUNT(c.match_id) + 1 AS BIGINT), 95,
         CASE WHEN COUNT(c.match_id) > 0 THEN MAX(c.cum_xg) ELSE 0.0 END
  FROM sides s LEFT JOIN shot_cum c ON s.match_id = c.match_id AND s.team_name = c.team_name
  GROUP BY s.match_id, s.side, s.team_name)"""


def with_ctes(select: str) -> str:
    return f"WITH {duckdb_ctes()},\n{SILVER_CTES},\n{GOLD_CTES},\n{SERVING_CTES}\n{select}"
