"""Registry of named queries: key -> (Spark plan builder, DuckDB oracle SELECT).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole input tables; the oracle is the naive DuckDB form of the same result
(``pitchlake.oracle``), or ``None`` where no SQL form is given.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pitchlake.oracle import _KINDS, r6, with_ctes
from pitchlake.operators import gold as G
from pitchlake.plans import serving as V
from pitchlake.plans.context import Layers
from pitchlake.sources import bronze as B


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Layers], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def register(key: str, oracle: str | None):
    def deco(fn):
        REGISTRY[key] = Query(key, fn, with_ctes(oracle) if oracle else None)
        return fn
    return deco


def run(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return REGISTRY[key].build(Layers(spark, sf_dir))


# ============================================================== Silver

_EV_COLS = ("match_id, team_id, team_name, player_id, player_name, type, period, minute, second, "
            f"{r6('location_x', 'location_x')}, {r6('location_y', 'location_y')}, "
            "possession_team_name, play_pattern, event_order, competition_id, season_id")


@register("silver_events", f"SELECT {_EV_COLS} FROM silver_events")
def _silver_events(L: Layers) -> DataFrame:
    return L.silver_from_bronze("events")


@register("silver_shots", f"""SELECT match_id, team_name, player_id, player_name, minute, second,
  {r6('xg', 'xg')}, {r6('location_x', 'location_x')}, {r6('location_y', 'location_y')},
  body_part, outcome, under_pressure, event_order, competition_id, season_id FROM silver_shots""")
def _silver_shots(L: Layers) -> DataFrame:
    return L.silver_from_bronze("shots")


@register("silver_pressures", f"""SELECT match_id, team_id, team_name,
  {r6('location_x', 'location_x')}, {r6('location_y', 'location_y')}, minute, second,
  event_order, competition_id, season_id FROM silver_pressures""")
def _silver_pressures(L: Layers) -> DataFrame:
    return L.silver_from_bronze("pressures")


@register("silver_carries", f"""SELECT match_id, player_id, player_name,
  {r6('start_x', 'start_x')}, {r6('start_y', 'start_y')}, {r6('end_x', 'end_x')},
  {r6('end_y', 'end_y')}, {r6('delta_x', 'delta_x')}, {r6('delta_y', 'delta_y')},
  event_order, competition_id, season_id FROM silver_carries""")
def _silver_carries(L: Layers) -> DataFrame:
    return L.silver_from_bronze("carries")


@register("silver_lineups", "SELECT * FROM silver_lineups")
def _silver_lineups(L: Layers) -> DataFrame:
    return L.silver_from_bronze("lineups")


# ============================================================== Gold

@register("gold_match_teams", "SELECT * FROM named")
def _gold_match_teams(L: Layers) -> DataFrame:
    return G.match_teams(L.events)


@register("gold_defensive_actions", f"""SELECT competition_id, season_id, match_id, team_name,
  {r6('location_x', 'location_x')}, {r6('location_y', 'location_y')}, type, minute, second
  FROM silver_events WHERE type IN ({_KINDS})""")
def _gold_defensive_actions(L: Layers) -> DataFrame:
    return G.defensive_actions(L.events, L.t)


@register("gold_opponent_passes", f"""SELECT competition_id, season_id, match_id, team_name, pass_team,
  {r6('location_x', 'location_x')}, event_order FROM (
    SELECT competition_id, season_id, match_id, e.location_x, e.event_order, e.team_name AS pass_team,
           unnest(list_filter(l.teams, lambda other: other <> e.team_name)) AS team_name
    FROM (SELECT * FROM silver_events WHERE type = 'Pass' AND location_x < 80) e
    JOIN line_up l USING (competition_id, season_id, match_id)) x""")
def _gold_opponent_passes(L: Layers) -> DataFrame:
    return G.opponent_passes(L.events, L.t)


@register("gold_ppda", f"""SELECT competition_id, season_id, match_id, team_name,
  CAST(opp_passes AS BIGINT) AS opp_passes, CAST(def_actions AS BIGINT) AS def_actions,
  {r6('CAST(opp_passes / nullif(def_actions, 0) AS FLOAT)', 'ppda')} FROM measures""")
def _gold_ppda(L: Layers) -> DataFrame:
    return G.ppda(L.events, L.t)


@register("gold_press_metrics", f"""SELECT competition_id, season_id, match_id, team_name,
  {r6('avg(location_x)', 'press_height')},
  {r6('CAST(count(*) FILTER (location_x > 80) / count(*) AS FLOAT)', 'high_turnover_rate')}
  FROM silver_events WHERE type = 'Pressure' GROUP BY ALL""")
def _gold_press_metrics(L: Layers) -> DataFrame:
    return G.press_metrics(L.events, L.t)


@register("gold_defensive_line", f"""SELECT competition_id, season_id, match_id, team_name,
  {r6('avg(location_x)', 'defensive_line_height')}
  FROM silver_events WHERE type IN ({_KINDS}) AND location_x < 60 GROUP BY ALL""")
def _gold_defensive_line(L: Layers) -> DataFrame:
    return G.defensive_line(L.events, L.t)


@register("gold_progressive_carries", f"""SELECT competition_id, season_id, match_id, team_name,
  {r6('CAST(sum(c.hits) / sum(c.n) AS FLOAT)', 'progressive_carry_rate')}
  FROM silver_events JOIN player_carries c USING (competition_id, season_id, match_id, player_id)
  WHERE type = 'Carry' GROUP BY ALL""")
def _gold_progressive_carries(L: Layers) -> DataFrame:
    return G.progressive_carry_rate(L.events, L.carries, L.t)


GOLD_SELECT = f"""SELECT match_id, team_name, {r6('ppda', 'ppda')}, {r6('press_height', 'press_height')},
  {r6('high_turnover_rate', 'high_turnover_rate')},
  {r6('defensive_line_height', 'defensive_line_height')},
  {r6('progressive_carry_rate', 'progressive_carry_rate')},
  {r6('press_success_rate', 'press_success_rate')}, {r6('compactness', 'compactness')},
  {r6('counter_attack_speed', 'counter_attack_speed')}, competition_id, season_id FROM gold"""


@register("gold_fingerprints", GOLD_SELECT)
def _gold_fingerprints(L: Layers) -> DataFrame:
    return L.gold_from_silver()


# ============================================================== Serving

@register("competition_options", """SELECT competition_id, season_id, competition_name, season_name,
  competition_name || ' (' || season_name || ')' AS label,
  CAST(row_number() OVER (ORDER BY competition_name, season_name, competition_id, season_id) AS INTEGER) AS position
  FROM bronze_competitions""")
def _competition_options(L: Layers) -> DataFrame:
    return V.competition_options(L.bronze_competitions)


@register("season_readiness", """SELECT c.competition_id, c.season_id,
  CAST(COALESCE(g.n, 0) AS BIGINT) AS gold_rows, COALESCE(g.n, 0) > 0 AS ready
  FROM (SELECT DISTINCT competition_id, season_id FROM bronze_competitions) c
  LEFT JOIN (SELECT competition_id, season_id, COUNT(*) AS n FROM gold GROUP BY 1, 2) g
  ON c.competition_id = g.competition_id AND c.season_id = g.season_id""")
def _season_readiness(L: Layers) -> DataFrame:
    counts = B.stored_counts(L.spark, B.paths(L.root)["gold"], name="gold_rows")
    return V.readiness_of(L.bronze_competitions, counts)


@register("pressing_leaders", f"""SELECT competition_id, season_id, CAST(rk AS INTEGER) AS rank, team_name,
  {r6('avg_ppda', 'avg_pressing_intensity_ppda')}, {r6('avg_ph', 'avg_press_height')}
  FROM (SELECT *, row_number() OVER (PARTITION BY competition_id, season_id
                                     ORDER BY avg_ppda ASC NULLS LAST, team_name) AS rk
        FROM (SELECT competition_id, season_id, team_name, AVG(ppda) AS avg_ppda,
                     AVG(press_height) AS avg_ph
              FROM gold WHERE team_name IS NOT NULL GROUP BY 1, 2, 3) t) r
  WHERE rk <= 5""")
def _pressing_leaders(L: Layers) -> DataFrame:
    return V.pressing_leaders(L.gold)


@register("recent_results", """SELECT competition_id, season_id, match_id, match_date, home_team,
  home_score, away_score, away_team FROM matches_c m
  WHERE EXISTS (SELECT 1 FROM gold g
                WHERE g.competition_id = m.competition_id AND g.season_id = m.season_id)""")
def _recent_results(L: Layers) -> DataFrame:
    return V.recent_results(L.bronze_matches, L.gold)


@register("season_options", """SELECT season_id, season_id = (SELECT MAX(season_id) FROM gold) AS is_default,
  CAST(row_number() OVER (ORDER BY season_id) AS INTEGER) AS position
  FROM (SELECT DISTINCT season_id FROM gold) s""")
def _season_options(L: Layers) -> DataFrame:
    return V.season_options(L.gold)


@register("team_options", """SELECT season_id, team_name,
  CAST(row_number() OVER (PARTITION BY season_id ORDER BY team_name) AS INTEGER) AS position
  FROM (SELECT DISTINCT season_id, team_name FROM gold WHERE team_name IS NOT NULL) t""")
def _team_options(L: Layers) -> DataFrame:
    return V.team_options(L.gold)


_METRICS = ("ppda", "press_height", "high_turnover_rate", "defensive_line_height",
            "progressive_carry_rate")


@register("league_average", "SELECT season_id, " + ", ".join(
    r6(f"league_{m}", m) for m in _METRICS) + " FROM league_avg")
def _league_average(L: Layers) -> DataFrame:
    return V.league_average(L.gold)


@register("team_profile", "SELECT season_id, team_name, " + ", ".join(
    [r6(m, m) for m in _METRICS] + [r6(f"league_{m}", f"league_{m}") for m in _METRICS])
    + " FROM profile")
def _team_profile(L: Layers) -> DataFrame:
    return V.team_profile(L.gold)


@register("team_dna", f"""SELECT season_id, team_name, metric, label, {r6('value', 'value')},
  {r6('league_value', 'league_value')}, {r6('pct', 'pct_of_avg')}, {r6('pct - 100', 'delta_pct')}
  FROM (SELECT *, CASE WHEN league_value = 0 THEN 0.0 ELSE value / league_value * 100 END AS pct
        FROM metric_rows) m""")
def _team_dna(L: Layers) -> DataFrame:
    return V.team_dna(L.gold)


@register("team_style", f"""SELECT season_id, team_name, {r6('ppda', 'team_ppda')},
  {r6('league_ppda', 'league_ppda')},
  CASE WHEN ppda < league_ppda * 0.9 THEN 'Aggressive Pressing'
       WHEN ppda > league_ppda * 1.1 THEN 'Passive Block' END AS style
  FROM profile""")
def _team_style(L: Layers) -> DataFrame:
    return V.team_style(L.gold)


@register("radar_long", f"""SELECT m.season_id, m.team_name, m.metric_order, m.radar_label AS label,
  {r6('m.value', 'team_value')}, {r6('m.league_value', 'league_value')}, {r6('a.axis_max', 'axis_max')}
  FROM metric_rows m JOIN (
    SELECT season_id, team_name,
           1.2 * greatest(ppda, press_height, high_turnover_rate, defensive_line_height,
                          progressive_carry_rate, league_ppda, league_press_height,
                          league_high_turnover_rate, league_defensive_line_height,
                          league_progressive_carry_rate) AS axis_max
    FROM profile) a ON m.season_id = a.season_id AND m.team_name = a.team_name""")
def _radar_long(L: Layers) -> DataFrame:
    return V.radar_long(L.gold)


@register("analyzable_matches", """SELECT competition_id, season_id, match_id, match_date, home_team,
  away_team, home_score, away_score,
  coalesce(match_date, 'None') || ' | ' || home_team || ' ' || CAST(home_score AS VARCHAR) || '-' ||
  CAST(away_score AS VARCHAR) || ' ' || away_team AS label
  FROM analyzable""")
def _analyzable_matches(L: Layers) -> DataFrame:
    return V.analyzable_matches(L.bronze_matches, L.shots)


@register("match_momentum", f"""SELECT s.match_id, s.side, s.team_name, CAST(c.shot_seq AS BIGINT) AS seq,
  c.minute, {r6('c.cum_xg', 'cum_xg')}
  FROM shot_cum c JOIN sides s ON c.match_id = s.match_id AND c.team_name = s.team_name
  UNION ALL
  SELECT match_id, side, team_name, seq, minute, {r6('cum_xg', 'cum_xg')} FROM anchors""")
def _match_momentum(L: Layers) -> DataFrame:
    return V.match_momentum(L.bronze_matches, L.shots)


@register("shot_map", f"""SELECT s.match_id, s.team_name, s.player_name, s.minute, s.second,
  s.event_order, {r6('s.xg', 'xg')}, s.outcome,
  {r6('CASE WHEN s.team_name = m.away_team THEN 120 - s.location_x ELSE s.location_x END', 'location_x')},
  {r6('CASE WHEN s.team_name = m.away_team THEN 80 - s.location_y ELSE s.location_y END', 'location_y')}
  FROM silver_shots s JOIN matches_c m ON s.match_id = m.match_id""")
def _shot_map(L: Layers) -> DataFrame:
    return V.shot_map(L.bronze_matches, L.shots)


@register("shot_summary", f"""SELECT match_id, team_name, {r6('total', 'total_xg')},
  shots, {r6('total / shots', 'xg_per_shot')}
  FROM (SELECT match_id, team_name, COALESCE(SUM(xg), 0.0) AS total, COUNT(match_id) AS shots
        FROM silver_shots WHERE team_name IS NOT NULL
          AND match_id IN (SELECT match_id FROM matches_c) GROUP BY 1, 2) t""")
def _shot_summary(L: Layers) -> DataFrame:
    return V.shot_summary(L.bronze_matches, L.shots)


# source/sink and single-operator keys register themselves on import
from pitchlake.plans import catalog_io as _io  # noqa: E402,F401
from pitchlake.plans import catalog_ops as _ops  # noqa: E402,F401
