"""Batch pipeline over a set of seasons.

``run_pipeline`` = ingest (feed -> Bronze) -> transform (Bronze -> Silver)
-> features (Silver -> Gold) for all requested (competition, season) pairs in
one set of Spark jobs, not one season or one match at a time. Each layer is
read back from its written files by the next one, so a lost executor only
recomputes from the last written layer (lineage is cut at every layer).

Returns a per-season status table (rows per layer, ok/empty/failed); a season
without data, or one that fails, does not stop the others.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake import schemas
from pitchlake.config import DEFAULT_SOURCE, DEFAULT_THRESHOLDS, Thresholds
from pitchlake.operators import gold as G
from pitchlake.operators import silver as S
from pitchlake.session import join_path
from pitchlake.sources import bronze as B
from pitchlake.sources.adapter import Feed
from pitchlake.sources.drift import or_by_groups

#: Held while a table that belongs to no season is overwritten (seasons may run side by side).
_WHOLE_TABLE = threading.Lock()
SILVER_EVENT_TABLES = ("events", "shots", "pressures", "carries")
#: Silver tables that Gold is computed from.
GOLD_READS = ("events", "carries")
SILVER_SCHEMAS = schemas.SILVER
#: What a viewer selects one match or team by.
SELECTED_BY = ("match_id", "team_name")


def run_concurrently(tasks: Sequence[Callable[[], object]], workers: int = 4) -> list:
    """Submit independent Spark jobs (writes of different tables) together.

    Each task is one action; the scheduler runs their stages side by side, so a
    small table is written while a large one is still running instead of
    after it. The first failure is raised once all tasks have finished.
    """
    if workers <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(workers, len(tasks))) as pool:
        futures = [pool.submit(inheritable_thread_target(t)) for t in tasks]
        return [f.result() for f in futures]


def silver_path(root: str, table: str) -> str:
    return join_path(B.paths(root)["silver"], table)


def _landing(feed: Feed, root: str, seasons: Sequence[tuple[int, int]] | None = None,
             limit: int | None = None, ingested_at: dt.datetime = B.DEFAULT_INGESTED_AT,
             source: str = DEFAULT_SOURCE) -> dict[str, Callable[[], object]]:
    """One write job per feed table that is yet to be landed. A feed whose tables all follow from its
    events (``from_events``) is read once: its events are landed here, and the others derived from
    stored Bronze."""
    cond = B.season_filter(seasons)

    def wanted(df: DataFrame) -> DataFrame:
        return df if cond is None else df.where(cond)

    events = wanted(feed.events)
    if limit:
        events = B.events_of_matches(events, B.limit_matches(wanted(feed.matches), limit))
    first = {}
    if getattr(feed, "from_events", None) is None:
        matches = B.limit_matches(wanted(feed.matches), limit)
        lineups, competitions = wanted(feed.lineups), feed.competitions
        if limit:
            lineups = B.events_of_matches(lineups, matches)
        first = {"events": lambda: B.land_events(events, root, ingested_at, source, seasons)}
    else:
        spark = feed.spark
        B.land_events(events, root, ingested_at, source, seasons)
        stored = feed.from_events(B.scan_events(spark, root, seasons))
        matches = B.limit_matches(stored.matches, limit)
        lineups = B.events_of_matches(stored.lineups, matches) if limit else stored.lineups
        competitions = stored.competitions if cond is None else feed.competitions
    corrupt = getattr(feed, "corrupt", {})

    def whole(write: Callable[[], object]) -> Callable[[], object]:
        def run() -> object:
            with _WHOLE_TABLE:
                return write()
        return run

    return {
        **first,
        "matches": lambda: B.land_matches(matches, root, ingested_at, source),
        "lineups": lambda: B.land_lineups(lineups, root, ingested_at, source),
        "competitions": whole(lambda: B.land_competitions(competitions, root, ingested_at, source)),
        **{f"corrupt/{name}": whole(lambda name=name, df=df: df.write.mode("overwrite").parquet(
            join_path(B.paths(root)["corrupt"], name))) for name, df in corrupt.items()},
    }


def ingest(feed: Feed, root: str, seasons: Sequence[tuple[int, int]] | None = None,
           limit: int | None = None, ingested_at: dt.datetime = B.DEFAULT_INGESTED_AT,
           source: str = DEFAULT_SOURCE, workers: int = 4) -> None:
    """Feed -> Bronze for the requested seasons (all seasons when None). Lines of a landed feed that
    did not parse are kept under ``bronze/_corrupt/<table>``."""
    run_concurrently(list(_landing(feed, root, seasons, limit, ingested_at, source).values()), workers)


def _silver_tasks(spark: SparkSession, root: str, seasons: Sequence[tuple[int, int]] | None,
                  drifted: bool = False, tables: Sequence[str] = (*SILVER_EVENT_TABLES, "lineups"),
                  ) -> dict[str, Callable[[], int]]:
    """One write job per given Silver table whose Bronze source has been landed; ``drifted`` reads Bronze
    by groups of files with the same types."""
    def write(table: str, df: DataFrame):
        return lambda: B.write_partitioned(df, silver_path(root, table), B.SEASON_PARTS,
                                           cluster_by=("match_id",), selected_by=SELECTED_BY)

    def lineups() -> DataFrame:
        path = B.paths(root)["lineups"]
        if drifted:
            return B.scan_drifted(spark, [path], schemas.BRONZE_LINEUPS, path, B.season_filter(seasons))
        return B.scan_lineups(spark, root, seasons)

    tasks = {}
    of_events = [t for t in SILVER_EVENT_TABLES if t in tables]
    if of_events and B.table_exists(spark, B.paths(root)["events"]):
        events = B.scan_events(spark, root, seasons, drifted)
        tasks.update({t: write(t, S.SILVER_TABLES[t](events)) for t in of_events})
    if "lineups" in tables and B.table_exists(spark, B.paths(root)["lineups"]):
        tasks["lineups"] = write("lineups", S.silver_lineups(lineups()))
    return tasks


def transform(spark: SparkSession, root: str,
              seasons: Sequence[tuple[int, int]] | None = None, workers: int = 4,
              tables: Sequence[str] = (*SILVER_EVENT_TABLES, "lineups")) -> None:
    """Bronze -> Silver; a season is rebuilt from all of its Bronze matches.

    An input split may hold files of several seasons, so the rows are rebalanced
    on the season before the write: few files per season, large seasons in
    several tasks, each sorted by match. Files whose columns have other types than Bronze's are read
    by groups of the same types.
    """
    or_by_groups(lambda drifted: run_concurrently(
        list(_silver_tasks(spark, root, seasons, drifted, tables).values()), workers))


def read_silver(spark: SparkSession, root: str, table: str,
                seasons: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    return B.scan(spark, silver_path(root, table), SILVER_SCHEMAS[table], seasons)


def features(spark: SparkSession, root: str, seasons: Sequence[tuple[int, int]] | None = None,
             t: Thresholds = DEFAULT_THRESHOLDS) -> None:
    """Silver -> Gold fingerprints (guarded: an empty result writes nothing)."""
    gold = G.fingerprints(read_silver(spark, root, "events", seasons),
                          read_silver(spark, root, "carries", seasons), t)
    B.write_partitioned(gold, B.paths(root)["gold"], B.SEASON_PARTS, cluster_by=("match_id",), selected_by=SELECTED_BY)


def read_gold(spark: SparkSession, root: str,
              seasons: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    return B.scan(spark, B.paths(root)["gold"], schemas.GOLD_FINGERPRINTS, seasons)


def status(spark: SparkSession, root: str, seasons: Sequence[tuple[int, int]],
           errors: dict[tuple[int, int], str] | None = None) -> DataFrame:
    """Rows per layer for each requested season; ``ok``, ``empty`` or ``failed`` with its error."""
    errors = errors or {}
    req = spark.createDataFrame(
        [(int(c), int(s), errors.get((c, s))) for c, s in seasons],
        T.StructType([T.StructField("competition_id", T.LongType()),
                      T.StructField("season_id", T.LongType()),
                      T.StructField("error", T.StringType())]))
    sound = [s for s in seasons if s not in errors]
    out = req
    for name, path in (("bronze_events", B.paths(root)["events"]), ("silver_events", silver_path(root, "events")),
                       ("gold_rows", B.paths(root)["gold"])):
        if B.table_exists(spark, path):
            out = out.join(B.stored_counts(spark, path, sound, name), list(B.SEASON_PARTS), "left")
        else:  # the layer has not been written: no rows
            out = out.withColumn(name, F.lit(0).cast("bigint"))
    out = out.fillna(0, subset=["bronze_events", "silver_events", "gold_rows"])
    return out.select(
        *B.SEASON_PARTS, "bronze_events", "silver_events", "gold_rows",
        F.when(F.col("error").isNotNull(), "failed").when(F.col("gold_rows") > 0, "ok")
        .otherwise("empty").alias("status"), "error")


def _build(spark: SparkSession, root: str, seasons: Sequence[tuple[int, int]] | None,
           t: Thresholds, tables: Sequence[str] = (*SILVER_EVENT_TABLES, "lineups")) -> None:
    """Silver and Gold of the seasons. Gold reads only Silver events and carries, so these are begun
    first, and it starts as soon as they are written, while other Silver tables are still being written."""
    def build(drifted: bool) -> None:
        tasks = _silver_tasks(spark, root, seasons, drifted, tables)
        with ThreadPoolExecutor(max_workers=len(tasks) + 1) as pool:
            done = {name: pool.submit(inheritable_thread_target(tasks[name]))
                    for name in sorted(tasks, key=lambda name: name not in GOLD_READS)}

            def gold() -> None:
                for name in GOLD_READS:
                    if name in done:
                        done[name].result()
                features(spark, root, seasons, t)

            futures = [*done.values(), pool.submit(inheritable_thread_target(gold))]
            for f in futures:
                f.result()

    or_by_groups(build)


def build_lake(feed: Feed, root: str, t: Thresholds = DEFAULT_THRESHOLDS) -> None:
    """Feed -> Bronze -> Silver -> Gold of all seasons. A table is written as soon as those that it is
    derived from are stored, so that no layer waits for the last small table of the layer below."""
    spark = feed.spark
    landing = _landing(feed, root)
    if "events" in landing:
        landing.pop("events")()
    land_lineups = landing.pop("lineups")

    def lineups() -> None:
        land_lineups()
        transform(spark, root, tables=("lineups",))

    tasks = [lambda: _build(spark, root, None, t, SILVER_EVENT_TABLES), lineups, *landing.values()]
    run_concurrently(tasks, len(tasks))


#: Seasons that run side by side when a common run has failed.
SIDE_BY_SIDE = 8


def _isolated(spark: SparkSession, step: Callable[[Sequence[tuple[int, int]]], None],
              seasons: Sequence[tuple[int, int]], errors: dict[tuple[int, int], str],
              workers: int = SIDE_BY_SIDE) -> None:
    """Runs a step for all sound seasons at once. If that fails, every season runs by itself, side by
    side, so that only the seasons that fail by themselves are marked. Each has a scheduler pool (with
    ``spark.scheduler.mode=FAIR`` they share the cluster evenly) and a job tag of its own: when one of
    its writes fails, its other jobs are cancelled and those of other seasons go on."""
    sound = [s for s in seasons if s not in errors]

    def failed(season: tuple[int, int], e: Exception) -> None:
        lines = str(e).splitlines() or [type(e).__name__]
        errors[season] = next((x for x in lines if "Exception: " in x), lines[0]).strip()[:500]

    def alone(season: tuple[int, int]) -> None:
        sc, name = spark.sparkContext, f"season-{season[0]}-{season[1]}-{uuid.uuid4().hex[:8]}"
        sc.setLocalProperty("spark.scheduler.pool", name)
        sc.addJobTag(name)
        try:
            step([season])
        except Exception as e:  # noqa: BLE001 - whatever failed, the other seasons go on
            sc.cancelJobsWithTag(name)
            failed(season, e)
        finally:
            sc.removeJobTag(name)
            sc.setLocalProperty("spark.scheduler.pool", None)

    try:
        step(sound)
    except Exception as e:  # noqa: BLE001
        if len(sound) == 1:
            failed(sound[0], e)
        else:
            with ThreadPoolExecutor(max_workers=min(workers, len(sound))) as pool:
                list(pool.map(alone, sound))


def seasons_of(feed: Feed) -> list[tuple[int, int]]:
    """The seasons of a feed's catalogue (a row per season: a bounded list)."""
    rows = feed.competitions.select(*B.SEASON_PARTS).distinct().orderBy(*B.SEASON_PARTS).collect()
    return [(int(r[0]), int(r[1])) for r in rows]


def run_pipeline(spark: SparkSession, feed: Feed, root: str,
                 seasons: Sequence[tuple[int, int]] | None = None, limit: int | None = None,
                 t: Thresholds = DEFAULT_THRESHOLDS,
                 ingested_at: dt.datetime = B.DEFAULT_INGESTED_AT) -> DataFrame:
    """Ingest -> transform -> features for all ``seasons`` in one run (None: every season
    of the catalogue). A season that fails is reported with its error and does not stop the others."""
    seasons = [(int(c), int(s)) for c, s in (seasons if seasons is not None else seasons_of(feed))]
    errors: dict[tuple[int, int], str] = {}
    B.roll_forward(spark, root)
    _isolated(spark, lambda some: ingest(feed, root, some, limit, ingested_at), seasons, errors)
    _isolated(spark, lambda some: _build(spark, root, some, t), seasons, errors)
    return status(spark, root, seasons, errors)
