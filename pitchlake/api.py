"""User-level API: one function per composite dataset, named like its query key.

Every function is ``DataFrame(s) -> DataFrame`` (lazy plans; nothing runs until
an action or a write). Inputs are Bronze tables (``sources.bronze.scan_*``),
Silver tables (``plans.pipeline.read_silver``) or Gold (``plans.pipeline.read_gold``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from pitchlake.config import DEFAULT_THRESHOLDS, Thresholds
from pitchlake.operators import gold as _G
from pitchlake.operators.silver import (silver_carries, silver_events, silver_lineups,
                                        silver_pressures, silver_shots)
from pitchlake.plans.serving import (analyzable_matches, competition_options, league_average,
                                     match_momentum, pressing_leaders, radar_long,
                                     recent_results, season_options, season_readiness,
                                     shot_map, shot_summary, team_dna, team_options,
                                     team_profile, team_style)


def gold_match_teams(events: DataFrame) -> DataFrame:
    return _G.match_teams(events)


def gold_defensive_actions(events: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    return _G.defensive_actions(events, t)


def gold_opponent_passes(events: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    return _G.opponent_passes(events, t)


def gold_ppda(events: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    return _G.ppda(events, t)


def gold_press_metrics(events: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    return _G.press_metrics(events, t)


def gold_defensive_line(events: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    return _G.defensive_line(events, t)


def gold_progressive_carries(events: DataFrame, carries: DataFrame,
                             t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    return _G.progressive_carry_rate(events, carries, t)


def gold_fingerprints(events: DataFrame, carries: DataFrame,
                      t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    return _G.fingerprints(events, carries, t)


__all__ = [
    "silver_events", "silver_shots", "silver_pressures", "silver_carries", "silver_lineups",
    "gold_match_teams", "gold_defensive_actions", "gold_opponent_passes", "gold_ppda",
    "gold_press_metrics", "gold_defensive_line", "gold_progressive_carries", "gold_fingerprints",
    "competition_options", "season_readiness", "pressing_leaders", "recent_results",
    "season_options", "team_options", "league_average", "team_profile", "team_dna",
    "team_style", "radar_long", "analyzable_matches", "match_momentum", "shot_map",
    "shot_summary",
]
