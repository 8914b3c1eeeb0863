"""Pipeline behaviour: seasons kept, re-runs idempotent, empty input guarded, status."""

import warnings

import pytest
from pyspark.sql import functions as F

from pitchlake import schemas
from pitchlake.plans import pipeline as P
from pitchlake.sources import bronze as B
from pitchlake.sources.adapter import Feed
from tests.conftest import SF01


@pytest.fixture(scope="module")
def feed(spark):
    return Feed(spark, SF01)


def _gold_counts(spark, root):
    g = P.read_gold(spark, root)
    return {(r.competition_id, r.season_id): r["count"]
            for r in g.groupBy("competition_id", "season_id").count().collect()}


def test_two_separate_runs_keep_both_seasons_and_rerun_is_idempotent(spark, feed, lake):
    P.run_pipeline(spark, feed, lake, [(11, 26)])
    first = _gold_counts(spark, lake)
    assert set(first) == {(11, 26)}
    P.run_pipeline(spark, feed, lake, [(11, 27)])
    both = _gold_counts(spark, lake)
    assert set(both) == {(11, 26), (11, 27)} and both[(11, 26)] == first[(11, 26)]
    P.run_pipeline(spark, feed, lake, [(11, 26)])
    assert _gold_counts(spark, lake) == both
    silver = P.read_silver(spark, lake, "events")
    assert silver.count() == silver.dropDuplicates(["event_order"]).count()


def test_status_reports_empty_season_without_stopping_others(spark, feed, lake):
    st = {(r.competition_id, r.season_id): r for r in
          P.run_pipeline(spark, feed, lake, [(11, 26), (11, 27), (16, 4)]).collect()}
    assert st[(16, 4)].status == "empty" and st[(16, 4)].gold_rows == 0
    assert st[(11, 26)].status == "ok" and st[(11, 27)].status == "ok"
    assert st[(11, 26)].bronze_events + st[(11, 27)].bronze_events == 10_000


def test_limit_keeps_first_matches_per_season(spark, feed, lake):
    P.ingest(feed, lake, [(11, 26), (11, 27)], limit=3)
    m = B.scan_matches(spark, lake)
    per = {r.season_id: r["count"] for r in m.groupBy("season_id").count().collect()}
    assert per == {26: 3, 27: 3}
    ev_matches = {r.match_id for r in B.scan_events(spark, lake).select("match_id").distinct()
                  .collect()}
    assert ev_matches == {r.match_id for r in m.collect()}


def test_empty_write_keeps_existing_partitions(spark, feed, lake):
    B.land_events(feed.events, lake)
    before = B.scan_events(spark, lake).count()
    with warnings.catch_warnings(record=True):
        warnings.simplefilter("always")
        assert B.land_events(feed.events.where(F.col("season_id") < 0), lake) == 0
        assert B.land_competitions(feed.competitions.where(F.lit(False)), lake) == 0
    assert B.scan_events(spark, lake).count() == before


def test_drifted_files_read_together(spark, lake):
    a = spark.createDataFrame([(1, 10.5)], "match_id long, shot_statsbomb_xg double")
    b = spark.createDataFrame([(2, "0.25"), (3, "nan")], "match_id long, shot_statsbomb_xg string")
    a.write.parquet(f"{lake}/drift/a")
    b.write.parquet(f"{lake}/drift/b")
    df = B.scan_drifted(spark, [f"{lake}/drift/a", f"{lake}/drift/b"], schemas.BRONZE_EVENTS)
    got = {r.match_id: r.shot_statsbomb_xg for r in df.collect()}
    assert got[1] == 10.5 and got[2] == 0.25
    assert set(df.columns) == set(schemas.BRONZE_EVENTS.fieldNames())


def test_stringify_complex(spark):
    df = spark.createDataFrame([([61.0, 40.1], {"a": 1}), (None, None)],
                               "loc array<double>, obj struct<a:int>")
    out = B.stringify_complex(df).collect()
    assert out[0].loc == "[61.0, 40.1]" and out[0].obj == '{"a":1}'
    assert out[1].loc is None and out[1].obj is None


def test_landing_json_roundtrip_to_bronze(spark, feed, lake):
    """A nested JSON landing (lists, booleans) lands as the same Bronze text form."""
    from pitchlake.sources.landing import FEED_EVENTS, read_landing
    ev = feed.events.where(F.col("match_id") < 200)   # one day of matches as a landing
    parts = F.split(F.translate("location", "[]", ""), ",")
    end = F.split(F.translate("carry_end_location", "[]", ""), ",")
    nested = ev.select(
        *[c for c in ev.columns if c not in ("location", "carry_end_location", "under_pressure")],
        F.when(F.col("location") != "nan", F.array(F.trim(F.get(parts, 0)).cast("double"),
                                                   F.trim(F.get(parts, 1)).cast("double")))
        .alias("location"),
        F.when(F.col("carry_end_location") != "nan",
               F.array(F.trim(F.get(end, 0)).cast("double"), F.trim(F.get(end, 1)).cast("double")))
        .alias("carry_end_location"),
        (F.col("under_pressure") == "True").alias("under_pressure"))
    nested.write.json(f"{lake}/landing/events")
    landed = read_landing(spark, f"{lake}/landing/events", FEED_EVENTS)
    assert B.land_events(landed, lake) == ev.count()
    got = {r.event_order: r.location for r in B.scan_events(spark, lake).collect()}
    want = {r.event_order: (None if r.location == "nan" else r.location) for r in ev.collect()}
    assert got == want


def test_cli_runs_pipeline(spark, lake, capsys):
    from pitchlake import cli
    assert cli.main(["--input", "/root/testdata/sf0.001", "--seasons", "11:26,16:4",
                     "--lake", lake]) == 0
    out = capsys.readouterr().out
    assert "empty" in out and "ok" in out


def test_season_scan_lists_only_that_season(spark, feed, lake):
    B.land_events(feed.events, lake)
    files = B.scan_events(spark, lake, [(11, 26)]).inputFiles()
    assert files and all("season_id=26" in f for f in files)
    assert B.scan_events(spark, lake, [(99, 1)]).count() == 0


def test_reloading_one_match_replaces_only_that_match(spark, feed, lake):
    B.land_events(feed.events, lake)
    P.transform(spark, lake)
    before = {r.match_id: r["count"] for r in
              B.scan_events(spark, lake).groupBy("match_id").count().collect()}
    mid = sorted(before)[0]
    # the match arrives again with half of its events
    again = feed.events.where((F.col("match_id") == mid) & (F.col("event_order") % 2 == 0))
    B.land_events(again, lake)
    after = {r.match_id: r["count"] for r in
             B.scan_events(spark, lake).groupBy("match_id").count().collect()}
    assert after[mid] == again.count() < before[mid]
    assert {k: v for k, v in after.items() if k != mid} == \
        {k: v for k, v in before.items() if k != mid}
    P.transform(spark, lake)       # the season is rebuilt from all of its Bronze matches
    silver = P.read_silver(spark, lake, "events").where(F.col("match_id") == mid)
    assert silver.count() == again.where(F.col("type").isNotNull()).count()


def test_cli_runs_from_a_landed_feed(spark, lake, capsys):
    """A feed delivered as JSON files (nested lists) runs through the same pipeline
    and gives the same Gold as the adapter-fed run."""
    from pitchlake import cli
    small = Feed(spark, "/root/testdata/sf0.001")
    ev = small.events
    parts = F.split(F.translate("location", "[]", ""), ",")
    end = F.split(F.translate("carry_end_location", "[]", ""), ",")
    nested = ev.select(
        *[c for c in ev.columns if c not in ("location", "carry_end_location")],
        F.when(F.col("location") != "nan", F.array(F.trim(F.get(parts, 0)).cast("double"),
                                                   F.trim(F.get(parts, 1)).cast("double")))
        .alias("location"),
        F.when(F.col("carry_end_location") != "nan",
               F.array(F.trim(F.get(end, 0)).cast("double"), F.trim(F.get(end, 1)).cast("double")))
        .alias("carry_end_location")).drop("under_pressure")
    feed_dir = f"{lake}/feed"
    nested.write.json(f"{feed_dir}/events")
    small.matches.write.json(f"{feed_dir}/matches")
    small.lineups.write.json(f"{feed_dir}/lineups")
    small.competitions.write.json(f"{feed_dir}/competitions")
    assert cli.main(["--feed", feed_dir, "--seasons", "11:26,11:27", "--lake", f"{lake}/a"]) == 0
    P.run_pipeline(spark, small, f"{lake}/b", [(11, 26), (11, 27)])
    cols = ["match_id", "team_name", "ppda", "press_height", "defensive_line_height",
            "progressive_carry_rate"]
    a = sorted(map(tuple, P.read_gold(spark, f"{lake}/a").select(cols).collect()), key=str)
    b = sorted(map(tuple, P.read_gold(spark, f"{lake}/b").select(cols).collect()), key=str)
    assert a == b and len(a) > 0
    assert "ok" in capsys.readouterr().out
