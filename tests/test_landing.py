"""Nothing a feed delivers is lost, and files that disagree on types run through the pipeline."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pitchlake import schemas
from pitchlake.plans import pipeline as P
from pitchlake.sources import bronze as B
from pitchlake.sources import drift
from pitchlake.sources.adapter import Feed
from pitchlake.sources.landing import FEED_EVENTS, FEED_MATCHES, LandedFeed, read_landing
from tests.conftest import SF001


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def _numbers(c):
    return F.when(F.col(c) != "nan", F.from_json(F.col(c), "array<double>"))


def _delivered(feed, tmp_path, fmt):
    """The feed as files, its events with fields that no schema knows."""
    ev = (feed.events.withColumn("location", _numbers("location"))
          .withColumn("carry_end_location", _numbers("carry_end_location"))
          .withColumn("under_pressure", F.when(F.col("under_pressure") == "True", True))
          .withColumn("pass_length", F.col("event_order") * 0.5)
          .withColumn("tags", F.when(F.col("event_order") % 2 == 0, F.array(F.lit("a"), F.lit("b")))))
    ev.write.format(fmt).save(str(tmp_path / "events"))
    for name in ("matches", "lineups", "competitions"):
        df = getattr(feed, name)
        (df.withColumn("venue", F.lit("x")) if name == "matches" else df).write.format(fmt).save(str(tmp_path / name))
    return ev


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_feed_fields_outside_the_schema_stay_in_bronze(spark, lake, tmp_path, fmt):
    feed = Feed(spark, SF001)
    want = {r.event_order: r for r in _delivered(feed, tmp_path, fmt).collect()}
    P.ingest(LandedFeed(spark, str(tmp_path), fmt), lake)
    path = B.paths(lake)["events"]
    got = B.scan_with(spark, path, schemas.BRONZE_EVENTS, ["pass_length", "tags", "nowhere"]).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r.event_order]
        assert float(r.pass_length) == w.pass_length and r.nowhere is None
        assert (json.loads(r.tags) if r.tags else None) == w.tags
        assert r.location == (None if w.location is None else str(w.location))
        assert (r.match_id, r.minute, r.shot_statsbomb_xg) == (w.match_id, w.minute, w.shot_statsbomb_xg)
    if fmt == "json":
        stored = spark.read.parquet(path)
        assert sorted(B.extra_fields(stored)) == ["pass_length", "tags"]
    got = B.scan_with(spark, B.paths(lake)["matches"], schemas.BRONZE_MATCHES, ["venue"]).collect()
    assert len(got) == feed.matches.count() and {r.venue for r in got} == {"x"}


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_a_landed_feed_gives_the_same_layers(spark, lake, tmp_path, fmt):
    feed = Feed(spark, SF001)
    _delivered(feed, tmp_path, fmt)
    seasons = [(11, 26), (11, 27)]
    P.run_pipeline(spark, feed, f"{lake}/plain", seasons).collect()
    status = P.run_pipeline(spark, LandedFeed(spark, str(tmp_path), fmt), f"{lake}/landed", seasons).collect()
    assert {r.status for r in status} == {"ok"}
    assert _rows(P.read_gold(spark, f"{lake}/landed")) == _rows(P.read_gold(spark, f"{lake}/plain"))
    for table in P.SILVER_EVENT_TABLES:
        assert _rows(P.read_silver(spark, f"{lake}/landed", table)) == _rows(P.read_silver(spark, f"{lake}/plain", table))


def test_json_values_that_do_not_fit_and_lines_that_are_no_objects(spark, tmp_path):
    lines = ['{"match_id": 1, "minute": "soon", "team": {"id": 3}, "location": [1, 2.5], "x": {"y": [1]}, "n": null}',
             '[{"match_id": 2}, {"match_id": 3, "minute": 4}]', '{"match_id": 4, "second": null}', "7", '"text"', "null",
             '{"match_id": 5', '{"a": 1, "a": 2}', "", "{}"]
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "f.json").write_text("\n".join(lines))
    got = {r.match_id: r for r in read_landing(spark, str(tmp_path / "e"), FEED_EVENTS).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    assert got[1].minute is None and json.loads(got[1]._unparsed) == {"minute": "soon"}
    assert json.loads(got[1].team) == {"id": 3} and got[1].location == [1.0, 2.5]
    assert json.loads(str(got[1]._extra.toJson())) == {"n": None, "x": {"y": [1]}}
    assert got[3].minute == 4 and got[3]._extra is None and got[4]._unparsed is None
    bad = read_landing(spark, str(tmp_path / "e"), FEED_EVENTS, corrupt=True).collect()
    assert sorted(r.line for r in bad) == sorted(["7", '"text"', "null", '{"match_id": 5', '{"a": 1, "a": 2}'])
    assert all(r.file.endswith("f.json") for r in bad)


def test_parquet_feed_whose_files_disagree_on_types(spark, tmp_path):
    path = str(tmp_path / "m")
    one = "match_id long, competition_id long, season_id long, match_date string, home_score long, venue string"
    two = "match_id string, competition_id long, season_id long, home_score string, venue double"
    spark.createDataFrame([(1, 11, 26, "2024-01-01", 3, "x")], one).write.parquet(path)
    spark.createDataFrame([("2", 11, 26, "two", 1.5), ("soon", 11, 26, None, None)], two).write.mode("append").parquet(path)
    got = {r.match_id: r for r in read_landing(spark, path, FEED_MATCHES, "parquet").collect()}
    assert (got[1].home_score, got[1].venue, got[1].match_date) == ("3", "x", "2024-01-01")
    assert (got[2].home_score, got[2].venue, got[2].match_date) == ("two", "1.5", None)
    assert json.loads(got[None]._unparsed) == {"match_id": "soon"}


def _drifted_lake(spark, root):
    """Bronze as another writer left it: the same rows, one season's columns in other types."""
    B.land_events(Feed(spark, SF001).events, f"{root}/plain")
    P.ingest(Feed(spark, SF001), f"{root}/drift")
    bronze = B.scan_events(spark, f"{root}/drift").where(F.col("season_id") == 27)
    other = (bronze.withColumn("minute", F.col("minute").cast("string")).withColumn("player_id", F.col("player_id").cast("string"))
             .withColumn("match_id", F.col("match_id").cast("string")).drop("competition_id", "season_id", "play_pattern"))
    stage = f"{root}/stage"
    other.withColumn("half", F.col("event_order") % 2).repartition(2, "half").drop("half").write.parquet(stage)
    spark.read.parquet(stage).write.mode("overwrite").parquet(f"{B.paths(f'{root}/drift')['events']}/competition_id=11/season_id=27")


def test_a_lake_with_conflicting_types_runs_through_transform(spark, lake):
    _drifted_lake(spark, lake)
    P.ingest(Feed(spark, SF001), f"{lake}/want")
    for root in (f"{lake}/want", f"{lake}/drift"):
        P.transform(spark, root)
        P.features(spark, root)
    for table in ("shots", "pressures", "carries", "lineups"):
        assert _rows(P.read_silver(spark, f"{lake}/drift", table)) == _rows(P.read_silver(spark, f"{lake}/want", table))
    keep = [c for c in schemas.SILVER_EVENTS.fieldNames() if c != "play_pattern"]
    a, b = (P.read_silver(spark, f"{lake}/{r}", "events").select(keep) for r in ("drift", "want"))
    assert _rows(a) == _rows(b)
    assert _rows(P.read_gold(spark, f"{lake}/drift")) == _rows(P.read_gold(spark, f"{lake}/want"))
    status = P.run_pipeline(spark, Feed(spark, SF001), f"{lake}/drift", [(11, 26)]).collect()
    assert status[0].status == "ok"


def test_footers_are_read_in_a_job_and_one_file_a_group_by_the_driver(spark, lake, monkeypatch):
    _drifted_lake(spark, lake)
    path = B.paths(f"{lake}/drift")["events"]
    files = drift.files_of(spark, [path]).count()
    plan = drift.footers(drift.files_of(spark, [path]))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "content" not in plan.split("ReadSchema")[-1]
    monkeypatch.setattr(drift, "_driver_kinds", lambda *a: pytest.fail("a footer was read by the driver"))
    groups = drift.groups(spark, [path])
    assert sum(map(len, groups)) == files and len(groups) == 2
    seen = drift.footers(drift.files_of(spark, [path])).agg(F.sum("n_rows")).first()[0]
    assert seen == B.scan_drifted(spark, [path], schemas.BRONZE_EVENTS, path).count()


def test_a_store_that_only_spark_reads(spark, lake):
    _drifted_lake(spark, lake)
    path = B.paths(f"{lake}/drift")["events"]
    paths = [r.path for r in drift.files_of(spark, [path]).collect()]
    assert sorted(map(len, drift._driver_kinds(spark, paths).values())) == sorted(map(len, drift.groups(spark, [path])))
    assert drift._uri("file:/a/b") == "file:///a/b" and drift._uri("s3://b/k") == "s3://b/k"


def test_limit_takes_the_season_into_account(spark):
    events = spark.createDataFrame([(1, 11, 26), (1, 11, 27), (2, 11, 26)], "match_id long, competition_id long, season_id long")
    matches = events.where("match_id = 1 AND season_id = 26")
    assert [tuple(r) for r in B.events_of_matches(events, matches).select("match_id", "season_id").collect()] == [(1, 26)]


def test_run_stamp_is_one_instant(spark, lake):
    at = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
    B.land_matches(Feed(spark, SF001).matches, lake, at)
    assert B.scan_matches(spark, lake).select("_ingested_at").distinct().count() == 1
