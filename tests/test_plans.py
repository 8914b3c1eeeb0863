"""Plan checks: pushdown, pruning, no cartesian/nested-loop joins, no global windows."""

import re

import pytest

from pitchlake.plans import serving as V
from pitchlake.plans.context import Layers
from tests.conftest import SF01


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def layers(spark):
    return Layers(spark, SF01)


def _no_bad_joins(p: str):
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def _windows_partitioned(p: str):
    # "Window [exprs], [partition spec], [order spec]": the partition spec is never empty
    for line in p.splitlines():
        if re.search(r"\bWindow \[", line):
            assert not re.search(r"\], \[\]", line), line


def test_silver_filter_reaches_parquet_scan(layers):
    p = plan(layers.silver_from_bronze("shots"))
    assert "EqualTo(type,Shot)" in p
    scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln][0]
    assert "play_pattern" not in scan and "possession_team" not in scan


def test_gold_plan_shape(layers):
    p = plan(layers.gold_from_silver())
    _no_bad_joins(p)
    _windows_partitioned(p)
    assert "partial_count" in p                 # map-side partial aggregation
    scans = [ln for ln in p.splitlines() if "FileScan parquet" in ln]
    assert scans and all("play_pattern" not in s for s in scans)


def test_gold_has_one_exchange_per_source_and_one_of_player_rows(layers):
    p = plan(layers.gold_from_silver())
    exchanges = [ln for ln in p.splitlines() if re.search(r"\bExchange \w+partitioning", ln)]
    assert len(exchanges) == 3, p
    assert sum("REPARTITION_BY_COL" in e for e in exchanges) == 1
    assert p.count("FileScan parquet") == 2 and "Join" not in p
    # what goes through the exchanges of the sources is aggregated before
    for i, ln in enumerate(p.splitlines()):
        if "Exchange hashpartitioning" in ln and "ENSURE_REQUIREMENTS" in ln:
            assert "partial_" in p.splitlines()[i + 1] or "partial_" in p.splitlines()[i + 2]


@pytest.mark.parametrize("build", [
    lambda L: V.match_momentum(L.bronze_matches, L.shots),
    lambda L: V.team_dna(L.gold),
    lambda L: V.radar_long(L.gold),
    lambda L: V.shot_map(L.bronze_matches, L.shots),
    lambda L: V.season_readiness(L.bronze_competitions, L.gold),
])
def test_serving_plans_have_no_global_work(layers, build):
    p = plan(build(layers))
    _no_bad_joins(p)
    _windows_partitioned(p)
    assert "SinglePartition" not in p


def test_top_k_is_limited_before_the_shuffle(layers):
    p = plan(V.pressing_leaders(layers.gold))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_season_filter_prunes_partitions(spark, layers):
    from pitchlake.plans import pipeline as P
    df = P.read_gold(spark, layers.root, [(11, 27)])
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in p and "season_id" in p


def test_running_total_spreads_a_key_over_its_buckets(layers):
    p = plan(V.cumulative_xg(layers.shots))
    raw_window = [ln for ln in p.splitlines() if re.search(r"\bWindow \[sum\(xg", ln)]
    assert raw_window, p
    # the window over raw shot rows is partitioned by (match, team, minute, second), one struct
    spec = raw_window[0].split("], [")[-2]      # "Window [exprs], [partition], [order]"
    assert "_part" in spec, raw_window[0]
    made = [ln for ln in p.splitlines() if "AS _part" in ln][0]
    for col in ("match_id", "team_name", "minute", "second"):
        assert col in made
    _no_bad_joins(p)


def test_opponent_passes_is_an_equi_join_with_residual(layers):
    from pitchlake.operators import gold as G
    p = plan(G.opponent_passes(layers.events))
    _no_bad_joins(p)
    assert "HashJoin" in p or "SortMergeJoin" in p


def test_streaming_season_reads_use_dynamic_partition_pruning(spark, layers):
    from pyspark.sql import functions as F

    from pitchlake.sources import bronze as B
    from pitchlake.streaming.silver_stream import _seasons_of
    touched = (B.scan_events(spark, layers.root).where(F.col("season_id") == 27)
               .select("competition_id", "season_id").distinct())
    df = _seasons_of(spark, layers.root, touched, "events")
    assert "dynamicpruning" in plan(df)
    assert {r[0] for r in df.select("season_id").distinct().collect()} == {27}
