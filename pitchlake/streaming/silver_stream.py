"""Incremental Bronze -> Silver -> Gold with Structured Streaming.

The Silver projections are stateless and row-wise, so the same functions run
on a streaming DataFrame: newly landed Bronze event files (a new match folder)
are picked up by the file source, and each micro-batch is written to the
Silver tables (appended; a season is rewritten only when a batch re-delivers
events it already holds). An event is known by its match and its place in the
feed, so a match may arrive in any number of batches. Gold needs whole
matches, so after a batch the Gold
rows of the matches the batch touched are recomputed from stored Silver (only
the touched seasons are read: they are joined as a small broadcast table; no
driver collect).

Progress lives in a checkpoint folder under the lake root, so a restarted or
failed query resumes with the files it has not processed yet; a replayed batch
finds its events already stored and takes the rewrite path, so replays never
duplicate rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pitchlake import schemas
from pitchlake.config import DEFAULT_THRESHOLDS, Thresholds
from pitchlake.operators import gold as G
from pitchlake.operators import silver as S
from pitchlake.plans import pipeline as P
from pitchlake.session import join_path
from pitchlake.sources import bronze as B


MATCH = (*B.SEASON_PARTS, "match_id")
#: What identifies an event.
EVENT = (*MATCH, "event_order")
#: Files of a micro-batch, unless the caller says otherwise.
MAX_FILES = 1000


def bronze_event_stream(spark: SparkSession, root: str,
                        max_files_per_trigger: int | None = MAX_FILES) -> DataFrame:
    reader = (spark.readStream.schema(schemas.BRONZE_EVENTS)
              .option("basePath", B.paths(root)["events"]))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(B.paths(root)["events"])


def _seasons_of(spark: SparkSession, root: str, touched: DataFrame, table: str) -> DataFrame:
    """All stored Silver rows of the touched seasons (season rebuild, H11)."""
    return P.read_silver(spark, root, table).join(F.broadcast(touched), list(B.SEASON_PARTS),
                                                  "left_semi")


def _matches_of(spark: SparkSession, root: str, touched: DataFrame, matches: DataFrame, table: str) -> DataFrame:
    """All stored Silver rows of the touched matches; only the touched seasons are read."""
    return _seasons_of(spark, root, touched, table).join(matches, list(MATCH), "left_semi")


def _append(df: DataFrame, path: str) -> None:
    (df.sortWithinPartitions(*B.SEASON_PARTS, "match_id").write.mode("append")
     .partitionBy(*B.SEASON_PARTS).parquet(path))


def process_batch(spark: SparkSession, root: str, batch: DataFrame,
                  t: Thresholds = DEFAULT_THRESHOLDS) -> None:
    """One micro-batch: add its Silver rows, then rebuild Gold of its seasons.

    New events only (the usual case): the Silver rows are appended, nothing
    stored is rewritten. If the batch re-delivers events already in Silver (a
    corrected event, or this batch replayed after a failure), the touched
    seasons are rewritten as stored rows minus those events plus the batch, so
    nothing is counted twice and nothing else of a match is lost.
    """
    batch = batch.persist()
    try:
        touched = batch.select(*B.SEASON_PARTS).distinct()
        keys = batch.select(*[F.col(c).alias(f"b_{c}") for c in EVENT]).distinct()

        def same(df: DataFrame):
            return reduce(lambda x, y: x & y, [df[c].eqNullSafe(keys[f"b_{c}"]) for c in EVENT])

        for table in P.SILVER_EVENT_TABLES:
            path = P.silver_path(root, table)
            new = S.SILVER_TABLES[table](batch)
            if not B.table_exists(spark, path):
                B.write_partitioned(new, path, B.SEASON_PARTS, cluster_by=("match_id",))
                continue
            stored = _seasons_of(spark, root, touched, table)
            if stored.join(keys, same(stored), "left_semi").isEmpty():
                _append(new, path)
                continue
            old = stored.join(keys, same(stored), "left_anti")
            # cut lineage: the stored files are about to be replaced
            merged = old.unionByName(new.select(*old.columns)).checkpoint(eager=True)
            B.write_partitioned(merged, path, B.SEASON_PARTS, cluster_by=("match_id",))
        matches = batch.select(*MATCH).distinct()
        gold = G.fingerprints(_matches_of(spark, root, touched, matches, "events"),
                              _matches_of(spark, root, touched, matches, "carries"), t)
        path = B.paths(root)["gold"]
        if B.table_exists(spark, path):
            # a season's Gold is a few rows per match: keep those of its other matches
            stored = P.read_gold(spark, root).join(F.broadcast(touched), list(B.SEASON_PARTS), "left_semi")
            others = stored.join(matches, list(MATCH), "left_anti")
            gold = others.unionByName(gold.select(*others.columns)).checkpoint(eager=True)
        B.write_partitioned(gold, path, B.SEASON_PARTS, cluster_by=("match_id",))
    finally:
        batch.unpersist()


def start(spark: SparkSession, root: str, available_now: bool = True,
          t: Thresholds = DEFAULT_THRESHOLDS, max_files_per_trigger: int | None = MAX_FILES,
          processing_time: str = "1 minute") -> StreamingQuery:
    """Start the incremental query; ``available_now`` drains what is landed and stops."""
    stream = bronze_event_stream(spark, root, max_files_per_trigger)
    writer = (stream.writeStream
              .foreachBatch(lambda df, _epoch: process_batch(spark, root, df, t))
              .option("checkpointLocation", join_path(root, "_streaming/silver_gold")))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    return writer.start()
