"""Layers of one input directory, as the queries see them.

The feed derived from the driver tables is landed once per session and input
into a lake of the session's own under the checkpoint dir and run through the
pipeline (Bronze -> Silver -> Gold, each written, each a lineage cut);
``prepare`` does this explicitly. The input is named by its file listing (path,
length, modification time), on any file system, so changed input is landed
anew; the lake is removed when the driver ends. Queries then
read the stored layer below the one they compute, as in production:

* Silver keys compute Silver from stored Bronze (filters reach the scan);
* Gold keys compute Gold from stored Silver;
* serving keys read stored Gold / Silver shots / Bronze matches.

The source/sink keys land the adapter output themselves (``feed``).
"""

from __future__ import annotations

import threading
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from pitchlake import schemas
from pitchlake.config import DEFAULT_THRESHOLDS, Thresholds
from pitchlake.operators import gold as G
from pitchlake.operators import silver as S
from pitchlake.session import scratch_lake
from pitchlake.sources import bronze as B
from pitchlake.sources.adapter import Feed

_LOCK = threading.Lock()
_LANDED: dict[tuple, str] = {}


def input_listing(spark: SparkSession, sf_dir: str) -> tuple:
    """(path, length, modification time) of every file of the input, from its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/events.parquet")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    files, out = fs.listFiles(p, True), []
    while files.hasNext():
        st = files.next()
        out.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return tuple(sorted(out))


def prepare(spark: SparkSession, sf_dir: str, t: Thresholds = DEFAULT_THRESHOLDS) -> str:
    """Lake root with Bronze/Silver/Gold of ``sf_dir``, landed on the session's first use.

    A lake belongs to one session, so no other driver can write or read it half-written."""
    from pitchlake.plans import pipeline as P
    key = (spark.sparkContext.applicationId, input_listing(spark, sf_dir), repr(t))
    with _LOCK:
        if key not in _LANDED:
            root = scratch_lake(spark)
            P.build_lake(Feed(spark, sf_dir), root, t)
            _LANDED[key] = root
        return _LANDED[key]


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str, t: Thresholds = DEFAULT_THRESHOLDS):
        self.spark, self.sf_dir, self.t = spark, sf_dir, t

    # ------------------------------------------------------------ adapter output
    @cached_property
    def feed(self) -> Feed:
        return Feed(self.spark, self.sf_dir)

    # ------------------------------------------------------------ stored layers
    @cached_property
    def root(self) -> str:
        return prepare(self.spark, self.sf_dir, self.t)

    @cached_property
    def bronze_events(self) -> DataFrame:
        return B.scan_events(self.spark, self.root)

    @cached_property
    def bronze_matches(self) -> DataFrame:
        return B.scan_matches(self.spark, self.root)

    @cached_property
    def bronze_lineups(self) -> DataFrame:
        return B.scan_lineups(self.spark, self.root)

    @cached_property
    def bronze_competitions(self) -> DataFrame:
        return B.scan_competitions(self.spark, self.root)

    def stored_silver(self, table: str) -> DataFrame:
        from pitchlake.plans import pipeline as P
        return P.read_silver(self.spark, self.root, table)

    @cached_property
    def events(self) -> DataFrame:
        return self.stored_silver("events")

    @cached_property
    def shots(self) -> DataFrame:
        return self.stored_silver("shots")

    @cached_property
    def pressures(self) -> DataFrame:
        return self.stored_silver("pressures")

    @cached_property
    def carries(self) -> DataFrame:
        return self.stored_silver("carries")

    @cached_property
    def lineups(self) -> DataFrame:
        return self.stored_silver("lineups")

    @cached_property
    def gold(self) -> DataFrame:
        """Stored Gold (what the serving views read)."""
        return B.scan(self.spark, B.paths(self.root)["gold"], schemas.GOLD_FINGERPRINTS)

    # ------------------------------------------------------------ computed now
    def silver_from_bronze(self, table: str) -> DataFrame:
        if table == "lineups":
            return S.silver_lineups(self.bronze_lineups)
        return S.SILVER_TABLES[table](self.bronze_events)

    def gold_from_silver(self) -> DataFrame:
        return G.fingerprints(self.events, self.carries, self.t)
