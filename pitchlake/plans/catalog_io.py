"""Source and sink keys: each writes to a fresh lake folder
under the session's checkpoint dir and returns what a reader sees afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake import schemas as _schemas
from pitchlake.config import DEFAULT_SOURCE
from pitchlake.oracle import r6
from pitchlake.plans import pipeline as P
from pitchlake.plans.catalog import _EV_COLS, GOLD_SELECT, register
from pitchlake.plans.context import Layers
from pitchlake.session import scratch_lake
from pitchlake.sources import bronze as B
from pitchlake.sources.landing import LandedFeed

_INGESTED_EPOCH = int(B.DEFAULT_INGESTED_AT.timestamp())
_BRONZE_EV_COLS = ("match_id, team_id, team, player_id, player, type, period, minute, second, "
                   "location, possession_team, play_pattern, carry_end_location, "
                   f"{r6('shot_statsbomb_xg', 'shot_statsbomb_xg')}, shot_body_part, shot_outcome, "
                   "under_pressure, event_order, competition_id, season_id")
_AUDIT = f"CAST({_INGESTED_EPOCH} AS BIGINT) AS _ingested_at, '{DEFAULT_SOURCE}' AS _source"


@register("bronze_events", f"SELECT {_BRONZE_EV_COLS}, {_AUDIT} FROM bronze_events")
def _bronze_events(L: Layers) -> DataFrame:
    root = scratch_lake(L.spark)
    B.land_events(L.feed.events, root)
    return B.scan_events(L.spark, root)


@register("bronze_competitions", f"""SELECT competition_id, season_id, competition_name, season_name,
  {_AUDIT} FROM bronze_competitions""")
def _bronze_competitions(L: Layers) -> DataFrame:
    root = scratch_lake(L.spark)
    B.land_competitions(L.feed.competitions, root)
    return B.scan_competitions(L.spark, root)


@register("bronze_matches", f"""SELECT match_id, match_date, home_team, away_team, home_score,
  away_score, {_AUDIT}, competition_id, season_id FROM bronze_matches""")
def _bronze_matches(L: Layers) -> DataFrame:
    root = scratch_lake(L.spark)
    B.land_matches(L.feed.matches, root)
    return B.scan_matches(L.spark, root)


@register("bronze_lineups", f"""SELECT match_id, team_name, player_id, player_name, jersey_number,
  {_AUDIT}, competition_id, season_id FROM bronze_lineups""")
def _bronze_lineups(L: Layers) -> DataFrame:
    root = scratch_lake(L.spark)
    B.land_lineups(L.feed.lineups, root)
    return B.scan_lineups(L.spark, root)


@register("audit_columns", f"SELECT event_order, match_id, {_AUDIT} FROM bronze_events")
def _audit_columns(L: Layers) -> DataFrame:
    return B.add_audit_columns(L.feed.events.select("event_order", "match_id"))


@register("stringify_complex", """SELECT event_order,
  CASE WHEN location = 'nan' THEN NULL ELSE location END AS location,
  CASE WHEN carry_end_location = 'nan' THEN NULL ELSE carry_end_location END AS carry_end_location,
  CASE WHEN type IS NULL THEN NULL ELSE '{"kind":"' || type || '"}' END AS type_obj
  FROM bronze_events""")
def _stringify_complex(L: Layers) -> DataFrame:
    # the feed shape before landing: coordinates as native lists, kind as an object
    ev = L.feed.events

    def xy(c):
        parts = F.split(F.translate(F.col(c), "[]", ""), ",")
        return F.when(F.col(c) != "nan", F.array(
            F.trim(F.get(parts, 0)).try_cast("double"), F.trim(F.get(parts, 1)).try_cast("double")))
    native = ev.select("event_order", xy("location").alias("location"),
                       xy("carry_end_location").alias("carry_end_location"),
                       F.when(F.col("type").isNotNull(),
                              F.struct(F.col("type").alias("kind"))).alias("type_obj"))
    return B.stringify_complex(native)


@register("partitioned_write", """SELECT competition_id, season_id, match_id, COUNT(*) AS n_rows
  FROM bronze_events GROUP BY 1, 2, 3""")
def _partitioned_write(L: Layers) -> DataFrame:
    root = scratch_lake(L.spark)
    B.land_events(L.feed.events, root)
    ev = B.scan_events(L.spark, root)
    return ev.groupBy(*B.MATCH).agg(F.count(F.lit(1)).alias("n_rows"))


@register("empty_guard", """SELECT competition_id, season_id, COUNT(*) AS n_rows
  FROM bronze_events GROUP BY 1, 2""")
def _empty_guard(L: Layers) -> DataFrame:
    # an empty rerun of a season must not remove what is there
    root = scratch_lake(L.spark)
    B.land_events(L.feed.events, root)
    B.land_events(L.feed.events.where(F.col("season_id") < 0), root)
    ev = B.scan_events(L.spark, root)
    return ev.groupBy(*B.SEASON_PARTS).agg(F.count(F.lit(1)).alias("n_rows"))


@register("limit_matches", """SELECT match_id, competition_id, season_id, match_date FROM (
  SELECT *, row_number() OVER (PARTITION BY competition_id, season_id
                               ORDER BY match_date ASC NULLS LAST, match_id) AS rn
  FROM bronze_matches) m WHERE rn <= 10""")
def _limit_matches(L: Layers) -> DataFrame:
    return B.limit_matches(L.bronze_matches, 10).select(
        "match_id", "competition_id", "season_id", "match_date")


@register("multi_file_scan", f"""SELECT {_BRONZE_EV_COLS}, {_AUDIT} FROM bronze_events""")
def _multi_file_scan(L: Layers) -> DataFrame:
    # two landings whose files differ in columns (no carry end where there is none) and in types
    # (numbers as text), read as one typed table
    root = scratch_lake(L.spark)
    ev = B.add_audit_columns(L.feed.events)
    carry = F.col("carry_end_location") != "nan"
    ev.where(carry).withColumn("shot_statsbomb_xg", F.col("shot_statsbomb_xg").cast("string")) \
        .withColumn("minute", F.col("minute").cast("string")).write.parquet(f"{root}/drift/carries")
    ev.where(~carry).withColumn("player_id", F.col("player_id").cast("string")).drop("carry_end_location") \
        .write.parquet(f"{root}/drift/others")
    df = B.scan_drifted(L.spark, [f"{root}/drift/carries", f"{root}/drift/others"], _schemas.BRONZE_EVENTS)
    return df.withColumn("carry_end_location", F.coalesce("carry_end_location", F.lit("nan")))


def _deliver(L: Layers, fmt: str) -> str:
    """The feed as files, its events with nested values and a field that no schema knows."""
    folder = f"{scratch_lake(L.spark)}/feed"

    def xy(c):
        return F.when(F.col(c) != "nan", F.from_json(F.col(c), "array<double>")).alias(c)
    nested = ("location", "carry_end_location", "under_pressure")
    L.feed.events.select(
        *[c for c in L.feed.events.columns if c not in nested], xy("location"), xy("carry_end_location"),
        F.when(F.col("under_pressure") == "True", F.lit(True)).alias("under_pressure"),
        F.when(F.col("type") == "Pass", F.col("event_order") % 23).alias("pass_recipient_id"),
    ).write.format(fmt).save(f"{folder}/events")
    for name in ("matches", "lineups", "competitions"):
        getattr(L.feed, name).write.format(fmt).save(f"{folder}/{name}")
    return folder


def _landed(L: Layers, fmt: str) -> DataFrame:
    root = scratch_lake(L.spark)
    P.ingest(LandedFeed(L.spark, _deliver(L, fmt), fmt), root)
    return B.scan_with(L.spark, B.paths(root)["events"], _schemas.BRONZE_EVENTS, ["pass_recipient_id"])


_LANDED_SQL = f"""SELECT match_id, team_id, team, player_id, player, type, period, minute, second,
  nullif(location, 'nan') AS location, possession_team, play_pattern,
  nullif(carry_end_location, 'nan') AS carry_end_location, {r6('shot_statsbomb_xg', 'shot_statsbomb_xg')},
  shot_body_part, shot_outcome, CASE WHEN under_pressure = 'True' THEN 'true' END AS under_pressure,
  event_order, competition_id, season_id, {_AUDIT},
  CASE WHEN type = 'Pass' THEN CAST(event_order % 23 AS VARCHAR) END AS pass_recipient_id FROM bronze_events"""


@register("landed_feed_json", _LANDED_SQL)
def _landed_feed_json(L: Layers) -> DataFrame:
    # JSON lines: the unknown field lies in the VARIANT column of Bronze
    return _landed(L, "json")


@register("landed_feed_parquet", _LANDED_SQL)
def _landed_feed_parquet(L: Layers) -> DataFrame:
    # Parquet files: the unknown field is a column of Bronze
    return _landed(L, "parquet")


@register("drifted_lake", f"SELECT {_EV_COLS} FROM silver_events")
def _drifted_lake(L: Layers) -> DataFrame:
    # Bronze as another writer leaves it: one season's files have ids and clock as text; transform runs over both
    root = scratch_lake(L.spark)
    ev, path = L.bronze_events, B.paths(root)["events"]
    season = F.col("season_id") == 27
    text = [F.col(c).cast("string").alias(c) if c in ("match_id", "player_id", "minute") else F.col(c) for c in ev.columns]
    for part in (ev.where(~season), ev.where(season).select(*text)):
        part.write.mode("append").partitionBy(*B.SEASON_PARTS).parquet(path)
    P.transform(L.spark, root)
    return P.read_silver(L.spark, root, "events").select(*_schemas.SILVER_EVENTS.fieldNames())


@register("normalize_match_id", """SELECT CAST(match_id AS BIGINT) AS match_id, competition_id,
  season_id, match_date FROM bronze_matches""")
def _normalize_match_id(L: Layers) -> DataFrame:
    # match ids landed as text ('123.0'), as a stringified feed stores them
    root = scratch_lake(L.spark)
    path = f"{root}/matches_text"
    m = L.feed.matches.select(
        F.concat(F.col("match_id").cast("string"), F.lit(".0")).alias("match_id"),
        "competition_id", "season_id", "match_date")
    B.write_partitioned(m, path, B.SEASON_PARTS)
    return B.normalize_match_id(B.point_read(L.spark, path)).select(
        "match_id", F.col("competition_id").cast("bigint").alias("competition_id"),
        F.col("season_id").cast("bigint").alias("season_id"), "match_date")


@register("point_read", GOLD_SELECT)
def _point_read(L: Layers) -> DataFrame:
    root = scratch_lake(L.spark)
    path = f"{root}/gold_object"
    B.write_partitioned(L.gold, path)
    return B.point_read(L.spark, path)


@register("silver_write", f"SELECT {_EV_COLS} FROM silver_events")
def _silver_write(L: Layers) -> DataFrame:
    root = scratch_lake(L.spark)
    B.write_partitioned(L.silver_from_bronze("events"), P.silver_path(root, "events"), B.SEASON_PARTS,
                        cluster_by=("match_id",))
    return P.read_silver(L.spark, root, "events").select(*_schemas.SILVER_EVENTS.fieldNames())


@register("gold_write", GOLD_SELECT)
def _gold_write(L: Layers) -> DataFrame:
    root = scratch_lake(L.spark)
    B.write_partitioned(L.gold_from_silver(), B.paths(root)["gold"], B.SEASON_PARTS,
                        cluster_by=("match_id",))
    return P.read_gold(L.spark, root)


_STATUS_SQL = """SELECT r.competition_id, r.season_id,
  CAST(COALESCE(b.n, 0) AS BIGINT) AS bronze_events, CAST(COALESCE(s.n, 0) AS BIGINT) AS silver_events,
  CAST(COALESCE(g.n, 0) AS BIGINT) AS gold_rows,
  CASE WHEN COALESCE(g.n, 0) > 0 THEN 'ok' ELSE 'empty' END AS status, CAST(NULL AS VARCHAR) AS error
  FROM (SELECT DISTINCT competition_id, season_id FROM bronze_competitions) r
  LEFT JOIN (SELECT competition_id, season_id, COUNT(*) AS n FROM bronze_events {where} GROUP BY 1, 2) b
    ON r.competition_id = b.competition_id AND r.season_id = b.season_id
  LEFT JOIN (SELECT competition_id, season_id, COUNT(*) AS n FROM silver_events {where} GROUP BY 1, 2) s
    ON r.competition_id = s.competition_id AND r.season_id = s.season_id
  LEFT JOIN (SELECT competition_id, season_id, COUNT(*) AS n FROM gold {where} GROUP BY 1, 2) g
    ON r.competition_id = g.competition_id AND r.season_id = g.season_id"""
#: Matches of each season in the warm-up batch.
WARM_UP_LIMIT = 10
_LIMITED = f"""WHERE match_id IN (SELECT match_id FROM (
  SELECT *, row_number() OVER (PARTITION BY competition_id, season_id
                               ORDER BY match_date ASC NULLS LAST, match_id) AS rn
  FROM bronze_matches) m WHERE rn <= {WARM_UP_LIMIT})"""


@register("run_pipeline", _STATUS_SQL.format(where=""))
def _run_pipeline(L: Layers) -> DataFrame:
    return P.run_pipeline(L.spark, L.feed, scratch_lake(L.spark))


@register("multi_season_batch", _STATUS_SQL.format(where=_LIMITED))
def _multi_season_batch(L: Layers) -> DataFrame:
    # the warm-up: some matches of every catalogued season; one without data reports 'empty'
    return P.run_pipeline(L.spark, L.feed, scratch_lake(L.spark), limit=WARM_UP_LIMIT)
