"""Coordinates are parsed once, Gold does not wait for the line-ups."""

import threading

import pytest
from pyspark.sql import functions as F

from pitchlake.functions.parse import coord, list_index, strip_brackets, to_float
from pitchlake.operators import silver as S
from pitchlake.plans import context
from pitchlake.plans import pipeline as P
from pitchlake.session import lake_root
from pitchlake.sources import bronze as B
from pitchlake.sources.adapter import Feed, bronze_events
from tests.conftest import SF001


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


ODD = ["[61.0, 40.1]", "[ 1e1 ,\t-0.0]", "[nan, 3]", "[NaN, None]", "nan", " None ", "", " ", "[]", "[,]", "[7]", "[1,2,3]",
       "[[4, 5], 6]", "][8][, 9", "[x, 1f]", "[Infinity, -inf]", "[1e99, 1d]", "[é1, 2 ]", "[ 5, 6]", "1;2", None]


def test_coordinates_of_odd_texts_equal_the_parse_of_the_list_element(spark):
    df = spark.createDataFrame([(k, s) for k, s in enumerate(ODD)], "k int, s string")
    for i in (1, 2, 3):
        got = df.select("k", coord("s", i).alias("v")).orderBy("k").collect()
        assert str(got) == str(df.select("k", to_float(list_index("s", i)).alias("v")).orderBy("k").collect())
    assert df.select("k", strip_brackets("s").alias("v")).orderBy("k").collect() == \
        df.select("k", F.translate("s", "[]", "").alias("v")).orderBy("k").collect()


def test_a_coordinate_is_parsed_once(spark):
    carries = S.silver_carries(bronze_events(spark, SF001)).select("start_x", "end_y")
    plan = carries._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as float)") == 2  # one cast for each of them
    assert "isnan" not in plan and "translate" not in plan


def test_gold_does_not_wait_for_the_line_ups(spark, monkeypatch):
    step = lake_root(spark)
    P.ingest(Feed(spark, SF001), step)
    P.transform(spark, step)
    P.features(spark, step)
    gold, waited = threading.Event(), []
    features, land_lineups = P.features, B.land_lineups

    def features_(*args, **kw):
        features(*args, **kw)
        gold.set()

    def land_lineups_(*args, **kw):
        waited.append(gold.wait(120))
        return land_lineups(*args, **kw)

    monkeypatch.setattr(P, "features", features_)
    monkeypatch.setattr(B, "land_lineups", land_lineups_)
    monkeypatch.setattr(context, "_LANDED", {})
    root = context.prepare(spark, SF001)
    assert waited == [True]
    for path in [B.paths(root)["gold"], *[P.silver_path(root, t) for t in P.SILVER_SCHEMAS],
                 *[B.paths(root)[t] for t in ("events", "matches", "lineups", "competitions")]]:
        got = _rows(spark.read.parquet(path))
        assert got and got == _rows(spark.read.parquet(path.replace(root, step))), path


@pytest.mark.parametrize("table", ["events", "lineups"])
def test_transform_of_some_tables_leaves_the_others(spark, lake, table):
    P.ingest(Feed(spark, SF001), lake)
    P.transform(spark, lake, tables=(table,))
    assert [t for t in P.SILVER_SCHEMAS if B.table_exists(spark, P.silver_path(lake, t))] == [table]
