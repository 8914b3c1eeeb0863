"""Hot matches are dealt over salts, places need no global window, counts come from footers, shots are
scanned once, selections read few row groups, seasons fail side by side."""

import glob
import os
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pitchlake.operators import gold as G
from pitchlake.operators.ranking import positions
from pitchlake.operators.running import running_total, running_total_single_window
from pitchlake.plans import catalog
from pitchlake.plans import pipeline as P
from pitchlake.plans import serving as V
from pitchlake.plans.context import Layers
from pitchlake.sources import bronze as B
from pitchlake.sources.adapter import Feed
from tests.conftest import SF01, SF001


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


# --------------------------------------------------------------- opponent passes

def _naive_opponent_passes(ev):
    p = ev.where("type = 'Pass' AND location_x < 80").select(
        *G.MATCH, F.col("team_name").alias("pass_team"), "location_x", "event_order")
    spine = ev.select(*G.TEAM_MATCH).distinct()
    return p.join(spine, list(G.MATCH)).where("pass_team <> team_name").select(
        *G.MATCH, "team_name", "pass_team", "location_x", "event_order")


@pytest.mark.parametrize("salt_rows", [1, 7, 100_000])
def test_salted_opponent_passes_equal_the_plain_join(spark, salt_rows):
    rng = random.Random(salt_rows)
    rows = [(11, 26, rng.choice([1, 1, 2, 3, None]), rng.choice(["A", "B", "C", None]), rng.choice(["Pass", "Pass", "Shot"]),
             rng.choice([10.0, 79.0, 90.0, None]), rng.choice([k, None])) for k in range(500)]
    ev = spark.createDataFrame(rows, "competition_id long, season_id long, match_id long, team_name string, type string, "
                                     "location_x float, event_order long")
    got, want = _rows(G.opponent_passes(ev, salt_rows=salt_rows)), _rows(_naive_opponent_passes(ev))
    assert got == want and len(got) > 100
    assert G.opponent_passes(ev.limit(0), salt_rows=salt_rows).count() == 0


# --------------------------------------------------------------- places

def test_positions_equal_a_window(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, None]), rng.choice(["x", "y", None]) if k % 3 else f"n{k}", k) for k in range(700)]
    df = spark.createDataFrame(rows, "g long, name string, id long").repartition(7)
    first = lambda c: (c[0] is None, c[0] or 0)
    key = lambda r: ((r.name is None, r.name or ""), r.id)
    got = positions(df, ["name", "id"]).collect()
    assert [r.id for r in sorted(got, key=lambda r: r.position)] == [r.id for r in sorted(got, key=key)]
    assert sorted(r.position for r in got) == list(range(1, 701))
    got = positions(df, ["name", "id"], within=["g"]).collect()
    for g in (1, 2, None):
        own = sorted((r for r in got if r.g == g), key=key)
        assert [r.position for r in own] == list(range(1, len(own) + 1)) and own
    assert first((None,)) > first((5,))
    assert positions(df.limit(0), ["name"], within=["g"]).count() == 0


@pytest.mark.parametrize("key", ["competition_options", "season_options", "team_options", "sorted_options"])
def test_sorted_options_have_no_window(spark, key):
    plan = executed(catalog.run(key, spark, SF001))
    assert not re.search(r"\bWindow\b", plan) and "SinglePartition" not in plan.replace("Exchange SinglePartition, ENSURE", "")


# --------------------------------------------------------------- counts from footers

@pytest.mark.parametrize("key", ["season_readiness", "readiness", "row_counts", "run_pipeline"])
def test_counts_are_pushed_into_the_scan(spark, key):
    plan = catalog.run(key, spark, SF001)._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.splitlines() if "BatchScan parquet" in ln]
    assert scans and all("PushedAggregation: [COUNT(*)]" in s for s in scans)
    assert all("match_id" not in s and "team_name" not in s for s in scans)


def test_footer_counts_equal_a_scan(spark, lake):
    P.ingest(Feed(spark, SF001), lake)
    path = B.paths(lake)["events"]
    want = B.scan_events(spark, lake).groupBy(*B.SEASON_PARTS).agg(F.count(F.lit(1)).alias("n_rows"))
    assert _rows(B.stored_counts(spark, path)) == _rows(want)
    assert _rows(B.stored_counts(spark, path, [(11, 27)])) == _rows(want.where("season_id = 27"))
    assert B.stored_counts(spark, path, []).count() == 0
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")  # other reads stay as they were


# --------------------------------------------------------------- running totals

def test_running_totals_scan_the_shots_once(spark):
    plan = executed(V.cumulative_xg(Layers(spark, SF01).shots))
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final, final


def test_running_total_keeps_other_columns_and_null_buckets(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "a", "a", None]), rng.choice([1, 2, None]), k, rng.choice([None, 0.5, 1.0]), f"x{k}")
            for k in range(400)]
    df = spark.createDataFrame(rows, "k string, b int, t long, v double, other string").repartition(5)
    got = running_total(df, ["k"], ["b"], ["t"], "v", "s", position="n")
    want = running_total_single_window(df, ["k"], ["b", "t"], "v", "s")
    assert _rows(got.drop("n")) == _rows(want)
    assert {(r.k, r.n) for r in got.collect()} == {(k, n) for k in ("a", None) for n in range(1, sum(r[0] == k for r in rows) + 1)}


# --------------------------------------------------------------- selections

def test_a_selection_reads_the_row_groups_that_have_it(spark, lake):
    rows = spark.range(60_000).select(
        (F.col("id") % 997).alias("match_id"),
        F.concat(F.lit("T"), F.floor(F.col("id") / 2000)).alias("team_name"), F.lit(11).cast("long").alias("competition_id"),
        F.lit(26).cast("long").alias("season_id"), F.rand(1).alias("x")).coalesce(1)
    conf = spark._jsc.hadoopConfiguration()
    conf.setInt("parquet.block.size", 64 * 1024)
    conf.setInt("parquet.page.size.row.check.min", 100)
    try:  # sorted by match: the team's name is spread over the file
        B.write_partitioned(rows.withColumn("match_id", F.col("match_id") + 1), f"{lake}/t", B.SEASON_PARTS,
                            cluster_by=("match_id",), selected_by=("match_id", "team_name"))
    finally:
        conf.unset("parquet.block.size")
        conf.unset("parquet.page.size.row.check.min")
    files = glob.glob(f"{lake}/t".replace("file:", "") + "/**/*.parquet", recursive=True)
    sizes = [pq.ParquetFile(f).metadata.row_group(g).num_rows for f in files
             for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
    assert len(sizes) >= 4

    def read(condition: str) -> tuple[int, int]:
        df = spark.read.parquet(f"{lake}/t").where(condition)
        n = len(df.collect())
        node, todo = None, [df._jdf.queryExecution().executedPlan()]
        while todo and node is None:
            p = todo.pop()
            if p.nodeName().startswith("Scan parquet"):
                node = p
            kids = p.children()
            todo += [kids.apply(i) for i in range(kids.size())]
            if p.nodeName() == "AdaptiveSparkPlan":
                todo.append(p.executedPlan())
        return n, int(node.metrics().apply("numOutputRows").value())

    n, seen = read("match_id = 500")
    assert n in (60, 61) and seen <= 2 * max(sizes)
    assert read("team_name = 'no such team'") == (0, 0)  # inside every row group's range of names
    assert read("match_id = 100000000") == (0, 0)


# --------------------------------------------------------------- seasons side by side

def test_one_broken_season_costs_no_run_of_seasons_one_after_another(spark):
    import threading
    import time
    seasons, errors = [(1, k) for k in range(8)], {}
    together, most, lock, calls = [0], [0], threading.Lock(), []

    def step(some):
        calls.append(tuple(some))
        with lock:
            together[0] += 1
            most[0] = max(most[0], together[0])
        try:
            time.sleep(0.3)
            if (1, 3) in some:
                raise RuntimeError("broken")
            if len(some) == 1:
                assert spark.sparkContext.getLocalProperty("spark.scheduler.pool").startswith(f"season-1-{some[0][1]}-")
                assert any(t.startswith(f"season-1-{some[0][1]}-") for t in spark.sparkContext.getJobTags())
                spark.range(10).count()
        finally:
            with lock:
                together[0] -= 1

    P._isolated(spark, step, seasons, errors)
    assert errors == {(1, 3): "broken"} and len(calls) == 9 and most[0] >= 4
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None and not spark.sparkContext.getJobTags()


def test_seasons_ingested_side_by_side_do_not_meet(spark, lake):
    feed = Feed(spark, SF001)
    first = feed.events.where("match_id < 500")
    B.land_events(first, lake)

    class Broken(Feed):
        """A feed of whose seasons one can't be read."""

        @property
        def events(self):
            bad = F.raise_error(F.lit("unreadable")).cast("long")
            return feed.events.where("match_id >= 500").withColumn(
                "event_order", F.when(F.col("season_id") == 16, bad).otherwise(F.col("event_order"))).unionByName(
                feed.events.limit(1).select(*[(F.lit(16) if c == "competition_id" else F.lit(4) if c == "season_id" else
                                              bad if c == "event_order" else F.col(c)).cast(feed.events.schema[c].dataType).alias(c)
                                             for c in feed.events.columns]))

    errors = {}
    broken = Broken(spark, SF001)
    seasons = [(11, 26), (11, 27), (16, 4)]
    P._isolated(spark, lambda some: P.ingest(broken, lake, some), seasons, errors)
    assert set(errors) == {(16, 4)}
    got = B.scan_events(spark, lake)
    assert got.count() == feed.events.count() and got.select("event_order").distinct().count() == got.count()
    assert not [d for d, _, _ in os.walk(B.paths(lake)["events"].replace("file:", "")) if d.endswith("_temporary")]


# --------------------------------------------------------------- re-delivered matches

@pytest.mark.parametrize("gone", [False, True])
def test_a_replacement_that_is_stopped_leaves_a_readable_season(spark, lake, monkeypatch, gone):
    feed = Feed(spark, SF001)
    B.land_events(feed.events, lake)
    n, path = feed.events.count(), B.paths(lake)["events"]
    again = feed.events.where("season_id = 26 AND match_id < 400").withColumn("play_pattern", F.lit("corrected"))
    write = B._write_events

    def stopped(df, where, mode, season=None):
        assert mode == "overwrite"
        if gone:  # the old files are deleted, the new ones not yet there
            import shutil
            shutil.rmtree(path.replace("file:", "") + "/competition_id=11/season_id=26")
        raise KeyboardInterrupt

    monkeypatch.setattr(B, "_write_events", stopped)
    with pytest.raises(KeyboardInterrupt):
        B.land_events(again, lake)
    monkeypatch.setattr(B, "_write_events", write)
    for rows in (B.scan_events(spark, lake), B.scan_events(spark, lake, [(11, 26), (11, 27)])):
        assert rows.count() == n and rows.where("play_pattern = 'corrected'").count() == again.count()
    assert B.scan_events(spark, lake, [(11, 27)]).where("season_id = 26").count() == 0
    P.transform(spark, lake)  # readers and Silver see the season as delivered
    assert P.read_silver(spark, lake, "events").where("play_pattern = 'corrected'").count() > 0
    assert B.roll_forward(spark, lake) == 1 and B.staged_folders(spark, lake) == []
    stored = spark.read.parquet(path)
    assert stored.count() == n and stored.where("play_pattern = 'corrected'").count() == again.count()
    assert B.roll_forward(spark, lake) == 0


def test_an_unfinished_staged_folder_is_no_season(spark, lake):
    feed = Feed(spark, SF001)
    B.land_events(feed.events, lake)
    half = f"{lake}/bronze/_staged-half"
    feed.events.limit(5).write.partitionBy(*B.SEASON_PARTS).parquet(half)
    os.remove(half.replace("file:", "") + "/_SUCCESS")
    assert B.staged_folders(spark, lake) == [] and B.scan_events(spark, lake).count() == feed.events.count()
