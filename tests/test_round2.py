"""Nothing is lost on the way in, changed input is seen, seasons fail alone, totals shuffle once."""

import os
import re
import shutil

import pytest
from pyspark.sql import functions as F

from pitchlake import schemas, streaming
from pitchlake.operators import gold as G
from pitchlake.operators import silver as S
from pitchlake.plans import pipeline as P
from pitchlake.plans import serving as V
from pitchlake.plans.context import Layers, input_listing, prepare
from pitchlake.sources import bronze as B
from pitchlake.sources.adapter import Feed
from pitchlake.sources.landing import FEED_MATCHES, LandedFeed, read_landing
from tests import edge_fixture as FX
from tests.conftest import SF001


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_stream_keeps_a_match_that_arrives_in_parts(spark, lake):
    feed = Feed(spark, SF001)
    events = feed.events.where(F.col("season_id") == 26)
    half = F.col("event_order") % 2 == 0
    B.land_events(events, f"{lake}/whole")
    streaming.process_batch(spark, f"{lake}/whole", B.scan_events(spark, f"{lake}/whole"))
    bronze = B.scan_events(spark, f"{lake}/whole")
    for part in (bronze.where(half), bronze.where(~half), bronze.where(half)):  # the last one is a replay
        streaming.process_batch(spark, f"{lake}/parts", part)
    for table in P.SILVER_EVENT_TABLES:
        assert _rows(P.read_silver(spark, f"{lake}/parts", table)) == _rows(P.read_silver(spark, f"{lake}/whole", table))
    assert _rows(P.read_gold(spark, f"{lake}/parts")) == _rows(P.read_gold(spark, f"{lake}/whole"))


def test_stream_one_file_per_batch_equals_one_batch(spark, lake):
    feed = Feed(spark, SF001)
    events = feed.events.where((F.col("season_id") == 26) & (F.col("match_id") < 200))
    B.land_events(events, lake)
    streaming.start(spark, lake, max_files_per_trigger=3).awaitTermination(300)
    assert P.read_silver(spark, lake, "events").count() == events.where(F.col("type").isNotNull()).count()


def test_bronze_keeps_unknown_columns_and_unparsable_values(spark, lake):
    feed = Feed(spark, SF001)
    ev = feed.events.withColumn("pass_length", F.col("event_order") * 0.5) \
        .withColumn("tags", F.array(F.lit("a"), F.lit("b"))) \
        .withColumn("minute", F.when(F.col("event_order") % 7 == 0, "soon").otherwise(F.col("minute").cast("string")))
    B.land_events(ev, lake)
    path = B.paths(lake)["events"]
    extra = B.extra_columns(spark, path, schemas.BRONZE_EVENTS)
    assert sorted(extra) == ["_unparsed", "pass_length", "tags"]
    got = {r.event_order: r for r in B.scan(spark, path, B.with_columns(schemas.BRONZE_EVENTS, extra)).collect()}
    assert len(got) == ev.count()
    for r in ev.collect():
        g = got[r.event_order]
        assert float(g.pass_length) == r.event_order * 0.5 and g.tags == "[a, b]"
        assert (g.minute, g._unparsed) == ((None, '{"minute":"soon"}') if r.minute == "soon" else (int(r.minute), None))
    for name, land in (("matches", B.land_matches), ("lineups", B.land_lineups), ("competitions", B.land_competitions)):
        land(getattr(feed, name).withColumn("venue", F.lit("x")), lake)
        assert "venue" in spark.read.parquet(B.paths(lake)[name]).columns


def test_lines_that_do_not_parse_are_kept_and_counted(spark, lake, tmp_path):
    feed = Feed(spark, SF001)
    for name in ("events", "matches", "lineups", "competitions"):
        df = getattr(feed, name)
        if name == "events":
            df = df.drop("location", "carry_end_location", "under_pressure")
        df.coalesce(1).write.json(str(tmp_path / name))
    bad = ['{"match_id": 1, "competition_id": ', "not json"]
    (tmp_path / "matches" / "more.json").write_text("\n".join(bad))
    n = feed.matches.count()
    assert len(read_landing(spark, str(tmp_path / "matches"), FEED_MATCHES).collect()) == n
    P.ingest(LandedFeed(spark, str(tmp_path)), lake)
    assert B.scan_matches(spark, lake).count() == n
    kept = spark.read.parquet(f"{B.paths(lake)['corrupt']}/matches").collect()
    assert sorted(r.line for r in kept) == sorted(bad) and all(r.file.endswith("more.json") for r in kept)


def test_ids_beyond_int_stay_and_overflow_fails(spark):
    rows = [dict(FX.ev(1, 3_000_000_000, "A", "Pass", "[10.0, 10.0]", player=5)),
            dict(FX.ev(2, 5_000_000_000, "B", "Carry", "[10.0, 10.0]", player=6, end="[30.0, 1.0]"))]
    df = spark.createDataFrame(rows, FX.bronze(spark).schema)
    assert {r.match_id for r in S.silver_events(df).collect()} == {3_000_000_000, 5_000_000_000}
    assert {r.match_id for r in S.silver_carries(df).collect()} == {5_000_000_000}
    text = df.withColumn("match_id", F.concat(F.col("match_id").cast("string"), F.lit(".0")))
    assert {r.match_id for r in B.normalize_match_id(text).collect()} == {3_000_000_000, 5_000_000_000}
    too_large = df.withColumn("player_id", F.lit(3e9))
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        S.silver_events(too_large).collect()


def test_one_match_id_in_two_seasons_has_its_own_carries(spark):
    def carry(order, season, gain):
        return FX.ev(order, 1, "A", "Carry", "[10.0, 1.0]", player=7, end=f"[{10 + gain}.0, 1.0]", season=season)
    df = spark.createDataFrame([carry(1, 1, 20), carry(2, 1, 1), carry(3, 2, 20)], FX.bronze(spark).schema)
    ev, ca = S.silver_events(df), S.silver_carries(df)
    for rates in (G.fingerprints(ev, ca), G.progressive_carry_rate(ev, ca)):
        assert {r.season_id: r.progressive_carry_rate for r in rates.collect()} == {1: 0.5, 2: 1.0}
    assert {r.season_id: r.joined_rows for r in G.carry_join_counts(ev, ca).collect()} == {1: 4, 2: 1}


def test_changed_input_under_the_same_path_is_landed_anew(spark, tmp_path):
    path = str(tmp_path / "in")
    src = spark.read.parquet(f"{SF001}/events.parquet")
    src.where("event_id < 300").coalesce(1).write.parquet(f"{path}/events.parquet")
    first, listing = Layers(spark, path).events.count(), input_listing(spark, path)
    shutil.rmtree(f"{path}/events.parquet")
    src.where("event_id < 600").coalesce(1).write.parquet(f"{path}/events.parquet")
    assert input_listing(spark, path) != listing
    assert Layers(spark, path).events.count() > first
    uri = f"file://{path}"
    before = prepare(spark, uri)
    assert prepare(spark, uri) == before and Layers(spark, uri).events.count() > first
    src.coalesce(1).write.mode("overwrite").parquet(f"{path}/events.parquet")
    assert prepare(spark, uri) != before


def test_a_broken_season_fails_alone(spark, lake):
    feed = Feed(spark, SF001)
    seasons = [(11, 26), (11, 27), (16, 4)]
    P.ingest(feed, lake, seasons)
    folder = B.paths(lake)["events"].replace("file:", "") + "/competition_id=11/season_id=26"
    file = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    with open(f"{folder}/{file}", "wb") as f:
        f.write(b"no parquet at all")
    errors = {}
    P._isolated(spark, lambda some: P._build(spark, lake, some, Layers(spark, SF001).t), seasons, errors)
    assert set(errors) == {(11, 26)}, errors
    st = {(r.competition_id, r.season_id): r for r in P.status(spark, lake, seasons, errors).collect()}
    assert st[(11, 26)].status == "failed" and st[(11, 26)].error
    assert st[(11, 27)].status == "ok" and st[(11, 27)].gold_rows > 0 and st[(16, 4)].status == "empty"


def test_events_are_landed_once_and_the_rest_derived_from_bronze(spark, lake):
    feed = Feed(spark, SF001)
    P.ingest(feed, f"{lake}/a")
    other = feed.from_events(B.scan_events(spark, f"{lake}/a"))
    raw = "events.parquet"
    for df in (other.matches, other.lineups, other.competitions):
        assert raw not in df._jdf.queryExecution().optimizedPlan().toString()
        assert not any(raw in f for f in df.inputFiles())
    assert _rows(B.scan_matches(spark, f"{lake}/a").select(feed.matches.columns)) == _rows(feed.matches)


def test_running_total_shuffles_raw_rows_once(spark):
    shots = Layers(spark, SF001).shots
    plan = V.cumulative_xg(shots)._jdf.queryExecution().executedPlan().toString()
    raw = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(_part" in ln]
    assert len(raw) <= 2 and "SortMergeJoin" in plan or "HashJoin" in plan
    # between the window over raw rows and the join there is no further exchange of them
    above = plan.split("Window [sum(xg")[0]
    assert not re.search(r"Exchange hashpartitioning\(.*event_order", above)


def test_silver_has_few_files_per_season(spark, lake):
    P.ingest(Feed(spark, SF001), lake)
    P.transform(spark, lake)
    for table in P.SILVER_EVENT_TABLES:
        files = P.read_silver(spark, lake, table).inputFiles()
        assert len(files) <= 4, (table, len(files))


def test_null_match_dates_come_last(spark):
    shots = spark.createDataFrame([(1, "A"), (2, "B")], "match_id long, team_name string")
    matches = spark.createDataFrame([(1, None, "A", "B", "0", "0", 1, 1), (2, "2024-01-02", "B", "C", "0", "0", 1, 1)],
                                    FX.matches(spark).schema)
    assert [r.match_id for r in V.default_match_shots(matches, shots).collect()] == [2]


def test_a_type_filter_skips_row_groups_of_bronze(spark, lake):
    import glob

    import pyarrow.parquet as pq
    conf = spark._jsc.hadoopConfiguration()
    conf.setInt("parquet.block.size", 32 * 1024)
    try:
        B.land_events(Feed(spark, "/root/testdata/sf0.01").events, lake)
    finally:
        conf.unset("parquet.block.size")
    all_groups = with_shots = 0
    for f in glob.glob(B.paths(lake)["events"].replace("file:", "") + "/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        at = next(k for k in range(meta.num_columns) if meta.schema.column(k).name == "type")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            all_groups += 1
            with_shots += bool(stats and stats.has_min_max and stats.min <= "Shot" <= stats.max)
    assert all_groups >= 8 and with_shots <= all_groups / 2, (with_shots, all_groups)


def test_new_matches_are_appended_and_old_files_stay(spark, lake):
    feed = Feed(spark, SF001)
    first = feed.events.where((F.col("season_id") == 26) & (F.col("match_id") < 800))
    B.land_events(first, lake)
    files = set(B.scan_events(spark, lake).inputFiles())
    B.land_events(feed.events.where(F.col("match_id") >= 800), lake)
    assert files <= set(B.scan_events(spark, lake).inputFiles())
    assert B.scan_events(spark, lake).count() == first.count() + feed.events.where(F.col("match_id") >= 800).count()
