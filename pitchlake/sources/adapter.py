"""Adapter: the driver's generic ``events`` table -> feed-shaped Bronze tables.

The test data ships no football feed, so a landed feed is derived from
``events(event_id, ts, user_id, event_type, value, props)`` by arithmetic
only. The same SQL text runs in Spark (``spark.sql(text, events=df)``) and in
DuckDB (the oracle), so both sides start from identical Bronze rows; the
mapping itself is documented in FIXTURES.md §2.

The derivation is a row-wise projection (events) plus one aggregation per
match (matches) and a distinct (lineups): its work grows with ``events``, and
so does the number of matches (a further round of them for every 150 users). Some events have no team or a third team, some matches no date.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

# Row-wise mapping of one generic event to one match event (text-form columns,
# as a stringified feed lands them: lists as '[x, y]', missing as 'nan').
EVENTS_SQL = """
SELECT
  CAST((round_no * 100 + d) * 100 + CAST(floor(slot / 2) AS INT) AS BIGINT) AS match_id,
  team_no AS team_id,
  team,
  CAST(user_id AS DOUBLE) AS player_id,
  concat('Player_', CAST(user_id AS STRING)) AS player,
  CASE event_type
    WHEN 'click' THEN 'Pass'
    WHEN 'view' THEN 'Carry'
    WHEN 'signup' THEN 'Pressure'
    WHEN 'purchase' THEN 'Shot'
    WHEN 'error' THEN CASE k % 6
        WHEN 0 THEN 'Interception' WHEN 1 THEN 'Tackle' WHEN 2 THEN 'Foul Committed'
        WHEN 3 THEN 'Block' WHEN 4 THEN 'Clearance' END
  END AS type,
  CASE WHEN mi < 47 THEN 1 ELSE 2 END AS period,
  mi AS minute,
  se AS second,
  CASE WHEN k % 17 = 0 THEN 'nan'
       ELSE concat('[', CAST(CAST(floor(xi / 10) AS BIGINT) AS STRING), '.', CAST(xi % 10 AS STRING),
                   ', ', CAST(CAST(floor(yi / 10) AS BIGINT) AS STRING), '.', CAST(yi % 10 AS STRING), ']')
  END AS location,
  team AS possession_team,
  CASE WHEN k % 2 = 0 THEN 'Regular Play' ELSE 'From Throw In' END AS play_pattern,
  CASE WHEN event_type = 'view'
       THEN concat('[', CAST((event_id * 29 + k * 13) % 121 AS STRING), '.0, ',
                   CAST((event_id * 31 + k) % 81 AS STRING), '.0]')
       ELSE 'nan' END AS carry_end_location,
  CASE WHEN event_type = 'purchase' THEN least(value, 95.0) / 100 END AS shot_statsbomb_xg,
  CASE WHEN event_type = 'purchase' THEN
       CASE k % 3 WHEN 0 THEN 'Right Foot' WHEN 1 THEN 'Left Foot' ELSE 'Head' END END AS shot_body_part,
  CASE WHEN event_type = 'purchase' THEN
       CASE WHEN k % 5 = 0 THEN 'Goal' ELSE 'Saved' END END AS shot_outcome,
  CASE WHEN k % 3 = 0 THEN 'True' ELSE 'nan' END AS under_pressure,
  event_id AS event_order,
  CAST(11 AS BIGINT) AS competition_id,
  CAST(CASE WHEN d <= 15 THEN 26 ELSE 27 END AS BIGINT) AS season_id
FROM (
  SELECT b.*,
         CASE WHEN event_id % 97 = 13 THEN NULL
              WHEN event_id % 89 = 7 THEN concat('Guest_', CAST(team_no AS STRING))
              ELSE concat('Team_', CAST(team_no AS STRING)) END AS team,
         (team_no + d) % 10 AS slot,
         (event_id * 37 + k * 11) % 1201 AS xi,
         (event_id * 53 + k * 7) % 801 AS yi
  FROM (
    SELECT event_id, user_id, value, event_type,
           TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
           CAST(floor(user_id / 150) AS BIGINT) AS round_no,
           CAST(day(ts) AS INT) AS d,
           CAST((hour(ts) * 60 + minute(ts)) % 94 AS INT) AS mi,
           CAST(second(ts) AS INT) AS se,
           CAST(user_id % 10 AS INT) AS team_no
    FROM {events}
  ) b
) s
"""

# One row per match; the home/away team numbers follow from the match id,
# scores are the Goal count of each side (kept as text, as a feed lands them).
MATCHES_SQL = """
SELECT match_id, competition_id, season_id,
       CASE WHEN match_id % 1000 <> 703
            THEN concat(CAST(2024 + round_no AS STRING), '-01-', lpad(CAST(d AS STRING), 2, '0')) END AS match_date,
       concat('Team_', CAST(home_no AS STRING)) AS home_team,
       concat('Team_', CAST(away_no AS STRING)) AS away_team,
       CAST(home_goals AS STRING) AS home_score,
       CAST(away_goals AS STRING) AS away_score
FROM (
  SELECT match_id, competition_id, season_id, round_no, d, home_no, away_no,
         sum(CASE WHEN shot_outcome = 'Goal' AND team_id = home_no THEN 1 ELSE 0 END) AS home_goals,
         sum(CASE WHEN shot_outcome = 'Goal' AND team_id = away_no THEN 1 ELSE 0 END) AS away_goals
  FROM (
    SELECT match_id, competition_id, season_id, team_id, shot_outcome, round_no, d,
           CAST(((2 * p - d) % 10 + 10) % 10 AS INT) AS home_no,
           CAST(((2 * p + 1 - d) % 10 + 10) % 10 AS INT) AS away_no
    FROM (
      SELECT match_id, competition_id, season_id, team_id, shot_outcome,
             CAST(floor(match_id / 10000) AS BIGINT) AS round_no,
             CAST(floor(match_id / 100) AS BIGINT) % 100 AS d,
             match_id % 100 AS p
      FROM {bronze_events}
    ) e0
  ) e1
  GROUP BY match_id, competition_id, season_id, round_no, d, home_no, away_no
) m
"""

# Players seen in a match, per team; jersey number from the player id.
LINEUPS_SQL = """
SELECT DISTINCT match_id, competition_id, season_id,
       team AS team_name,
       CAST(player_id AS BIGINT) AS player_id,
       player AS player_name,
       CAST(1 + CAST(player_id AS BIGINT) % 99 AS BIGINT) AS jersey_number
FROM {bronze_events}
WHERE player_id IS NOT NULL
"""

# Competitions catalogue: every season present in the matches, plus seasons
# that are known to the catalogue but not loaded (readiness = false).
COMPETITIONS_SQL = """
SELECT competition_id, season_id,
       concat('Competition ', CAST(competition_id AS STRING)) AS competition_name,
       concat('Season ', CAST(season_id AS STRING)) AS season_name
FROM (
  SELECT DISTINCT competition_id, season_id FROM {bronze_matches}
  UNION
  SELECT competition_id, season_id FROM {catalogue_only}
) c
"""

# (competition_id, season_id) pairs listed in the catalogue without data.
CATALOGUE_ONLY = ((16, 4),)


def catalogue_only_sql() -> str:
    rows = " UNION ALL ".join(
        f"SELECT CAST({c} AS BIGINT) AS competition_id, CAST({s} AS BIGINT) AS season_id"
        for c, s in CATALOGUE_ONLY)
    return f"({rows})"


def read_driver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generic events table, split as the scan splits it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(EVENTS_SQL, events=read_driver_events(spark, sf_dir))


def bronze_matches_from(spark: SparkSession, events: DataFrame) -> DataFrame:
    return spark.sql(MATCHES_SQL, bronze_events=events)


def bronze_lineups_from(spark: SparkSession, events: DataFrame) -> DataFrame:
    return spark.sql(LINEUPS_SQL, bronze_events=events)


def bronze_competitions_from(spark: SparkSession, matches: DataFrame) -> DataFrame:
    sql = COMPETITIONS_SQL.replace("{catalogue_only}", catalogue_only_sql())
    return spark.sql(sql, bronze_matches=matches)


class Feed:
    """The four landed feed tables derived from one driver ``events`` table
    (plans are built on first use)."""

    def __init__(self, spark: SparkSession, sf_dir: str, events: DataFrame | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self._events = events

    def from_events(self, events: DataFrame) -> Feed:
        """The same feed with its other tables derived from the given (stored) events."""
        return Feed(self.spark, self.sf_dir, events)

    @cached_property
    def events(self) -> DataFrame:
        return self._events if self._events is not None else bronze_events(self.spark, self.sf_dir)

    @cached_property
    def matches(self) -> DataFrame:
        return bronze_matches_from(self.spark, self.events)

    @cached_property
    def lineups(self) -> DataFrame:
        return bronze_lineups_from(self.spark, self.events)

    @cached_property
    def competitions(self) -> DataFrame:
        return bronze_competitions_from(self.spark, self.matches)


def duckdb_ctes() -> str:
    """The adapter as DuckDB CTEs over the pre-registered ``events`` view."""
    ev = EVENTS_SQL.replace("{events}", "events")
    ma = MATCHES_SQL.replace("{bronze_events}", "bronze_events")
    li = LINEUPS_SQL.replace("{bronze_events}", "bronze_events")
    co = (COMPETITIONS_SQL.replace("{bronze_matches}", "bronze_matches")
          .replace("{catalogue_only}", catalogue_only_sql()))
    return (f"bronze_events AS ({ev}),\n bronze_matches AS ({ma}),\n"
            f" bronze_lineups AS ({li}),\n bronze_competitions AS ({co})")
