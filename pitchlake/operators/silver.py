"""Silver: typed, row-wise projections of Bronze (no shuffle, streaming-safe).

Each function is ``DataFrame -> DataFrame`` over Bronze events (or lineups).
The filters are plain equality / null tests on a source column, so Catalyst
pushes them into the Parquet scan, and only the referenced columns are read.
Every output keeps ``competition_id, season_id`` (partition columns) and the
events keep ``event_order`` (feed position: deterministic ordering of ties).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.functions.parse import (coord, float_of, int_of, long_of, null_if_missing,
                                       to_bool_default_false)

_PART = ("event_order", "competition_id", "season_id")


def _kind(name: str):
    return F.col("type") == name


def silver_events(df: DataFrame) -> DataFrame:
    """Typed events: every event with a kind."""
    return (df
            .where(F.col("type").isNotNull() & ~F.col("type").isin("nan", "None", ""))
            .select(
                long_of(df, "match_id").alias("match_id"),
                int_of(df, "team_id").alias("team_id"),
                F.col("team").alias("team_name"),
                int_of(df, "player_id").alias("player_id"),
                F.col("player").alias("player_name"),
                F.col("type"),
                int_of(df, "period").alias("period"),
                int_of(df, "minute").alias("minute"),
                int_of(df, "second").alias("second"),
                coord("location", 1).alias("location_x"),
                coord("location", 2).alias("location_y"),
                F.col("possession_team").alias("possession_team_name"),
                F.col("play_pattern"),
                *_PART))


def silver_shots(df: DataFrame) -> DataFrame:
    """Shots with xG, location, body part, outcome and a non-null under_pressure."""
    return (df.where(_kind("Shot"))
            .select(
                long_of(df, "match_id").alias("match_id"),
                F.col("team").alias("team_name"),
                int_of(df, "player_id").alias("player_id"),
                F.col("player").alias("player_name"),
                int_of(df, "minute").alias("minute"),
                int_of(df, "second").alias("second"),
                float_of(df, "shot_statsbomb_xg").alias("xg"),
                coord("location", 1).alias("location_x"),
                coord("location", 2).alias("location_y"),
                null_if_missing("shot_body_part").alias("body_part"),
                null_if_missing("shot_outcome").alias("outcome"),
                to_bool_default_false("under_pressure").alias("under_pressure"),
                *_PART))


def silver_pressures(df: DataFrame) -> DataFrame:
    return (df.where(_kind("Pressure"))
            .select(
                long_of(df, "match_id").alias("match_id"),
                int_of(df, "team_id").alias("team_id"),
                F.col("team").alias("team_name"),
                coord("location", 1).alias("location_x"),
                coord("location", 2).alias("location_y"),
                int_of(df, "minute").alias("minute"),
                int_of(df, "second").alias("second"),
                *_PART))


def silver_carries(df: DataFrame) -> DataFrame:
    """Carries with start, end and displacement (no team column, as in the feed)."""
    start_x, start_y = coord("location", 1), coord("location", 2)
    end_x, end_y = coord("carry_end_location", 1), coord("carry_end_location", 2)
    return (df.where(_kind("Carry"))
            .select(
                long_of(df, "match_id").alias("match_id"),
                int_of(df, "player_id").alias("player_id"),
                F.col("player").alias("player_name"),
                start_x.alias("start_x"), start_y.alias("start_y"),
                end_x.alias("end_x"), end_y.alias("end_y"),
                *_PART)
            .withColumn("delta_x", F.col("end_x") - F.col("start_x"))
            .withColumn("delta_y", F.col("end_y") - F.col("start_y"))
            .select("match_id", "player_id", "player_name", "start_x", "start_y", "end_x",
                    "end_y", "delta_x", "delta_y", *_PART))


def silver_lineups(df: DataFrame) -> DataFrame:
    return df.select(
        long_of(df, "match_id").alias("match_id"),
        F.col("team_name"),
        int_of(df, "player_id").alias("player_id"),
        F.col("player_name"),
        int_of(df, "jersey_number").alias("jersey_number"),
        "competition_id", "season_id")


SILVER_TABLES = {
    "events": silver_events,
    "shots": silver_shots,
    "pressures": silver_pressures,
    "carries": silver_carries,
}
