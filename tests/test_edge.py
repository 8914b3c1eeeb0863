"""Edge cases of SURVEY §3.5 on the hand-made fixture."""


import pytest
from pyspark.sql import functions as F

from pitchlake.config import Thresholds
from pitchlake.functions import parse as PZ
from pitchlake.operators import gold as G
from pitchlake.operators import silver as S
from pitchlake.plans import serving as V
from tests import edge_fixture as FX


@pytest.fixture(scope="module")
def bronze(spark):
    return FX.bronze(spark)


def _by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_q1_under_pressure_missing_is_false(bronze):
    shots = S.silver_shots(bronze).where(F.col("match_id") == 1).orderBy("event_order")
    assert [r.under_pressure for r in shots.collect()] == [False, False, False, True]


def test_q2_missing_locations_are_null_never_nan(bronze):
    p = S.silver_pressures(bronze).where(F.col("team_name") == "A").orderBy("event_order")
    xs = [r.location_x for r in p.collect()]
    ys = [r.location_y for r in p.collect()]
    assert xs == [None, None, None, None, 90.0, 90.0]
    assert ys == [None, None, None, None, None, 40.0]


def test_silver_drops_events_without_kind(bronze):
    assert S.silver_events(bronze).where(F.col("type").isNull()).count() == 0
    assert S.silver_events(bronze).count() == bronze.where(F.col("type").isNotNull()).count()


def test_gold_thresholds_and_null_team(bronze):
    ev = S.silver_events(bronze)
    gold = _by(G.fingerprints(ev, S.silver_carries(bronze)), "match_id", "team_name")
    a = gold[(1, "A")]
    assert a.ppda == pytest.approx(0.5)                # 2 opp passes / 4 actions x > 40
    assert a.press_height == pytest.approx(90.0)        # NULL locations skipped
    assert a.high_turnover_rate == pytest.approx(2 / 6)  # Q15: NULL locations in the count
    assert a.defensive_line_height == pytest.approx(45.0)  # 40 and 50; 60 excluded
    assert a.progressive_carry_rate == pytest.approx(0.4)  # Q3 weighted: (1*3+1*1)/(3*3+1*1)
    b = gold[(1, "B")]
    assert b.ppda == pytest.approx(1.0) and b.high_turnover_rate == 0.0  # x = 80 not > 80
    assert b.progressive_carry_rate is None
    # match 2: three names (Q16), no qualifying action -> NULL (Q14), NULL team gets nothing
    assert gold[(2, "C")].ppda is None
    assert gold[(2, "D")].ppda == pytest.approx(2.0)
    assert gold[(2, "E")].ppda == pytest.approx(3.0)
    assert gold[(2, "E")].defensive_line_height == pytest.approx(50.0)
    n = gold[(2, None)]
    assert (n.ppda, n.press_height, n.high_turnover_rate, n.defensive_line_height) == (
        None, None, None, None)
    assert {r.press_success_rate for r in gold.values()} == {0.5}


def test_q3_plain_carry_weighting(bronze):
    r = G.progressive_carry_rate(S.silver_events(bronze), S.silver_carries(bronze),
                                 Thresholds(carry_weighting="plain")).collect()
    assert [x.progressive_carry_rate for x in r] == [pytest.approx(0.5)]


def test_ppda_counts_exposed(bronze):
    p = _by(G.ppda(S.silver_events(bronze)), "match_id", "team_name")
    assert (p[(1, "A")].opp_passes, p[(1, "A")].def_actions) == (2, 4)
    assert (p[(2, None)].opp_passes, p[(2, None)].def_actions) == (0, 0)


def test_momentum_order_ties_gap_and_anchors(spark, bronze):
    shots = S.silver_shots(bronze)
    mom = V.match_momentum(FX.matches(spark), shots).where(F.col("match_id") == 3)
    home = [(r.seq, r.minute, r.cum_xg) for r in
            mom.where(F.col("side") == "home").orderBy("seq").collect()]
    expect = [(0, 0, 0.0), (1, 10, 0.01), (2, 10, 0.06), (3, 45, 0.26), (4, 46, 0.36),
              (5, 50, None), (6, 97, 0.66), (7, 95, 0.66)]
    assert [(s, m) for s, m, _ in home] == [(s, m) for s, m, _ in expect]
    for (_, _, got), (_, _, want) in zip(home, expect):
        assert (got is None and want is None) or got == pytest.approx(want, abs=1e-6)
    away = [(r.seq, r.minute, r.cum_xg) for r in
            mom.where(F.col("side") == "away").orderBy("seq").collect()]
    assert away == [(0, 0, 0.0), (1, 95, 0.0)]        # H8: side without shots


def test_momentum_last_value_equals_summary_total(spark, bronze):
    shots = S.silver_shots(bronze)
    final = _by(V.final_cum_xg(FX.matches(spark), shots), "match_id", "team_name")
    summ = _by(V.shot_summary(FX.matches(spark), shots), "match_id", "team_name")
    for k, s in summ.items():
        if k in final:
            assert final[k].final_cum_xg == pytest.approx(s.total_xg, abs=1e-6)


def test_q17_null_ppda_ranks_last(spark, bronze):
    gold = G.fingerprints(S.silver_events(bronze), S.silver_carries(bronze))
    leaders = V.pressing_leaders(gold).orderBy("rank").collect()
    assert leaders[-1].avg_pressing_intensity_ppda is None
    assert [r.rank for r in leaders] == list(range(1, len(leaders) + 1))


def test_p13_coercion_and_p4_cast(spark):
    df = spark.createDataFrame([("2",), ("2.0",), ("nan",), ("abc",), (None,)], "s string")
    assert [r[0] for r in df.select(PZ.coerce_numeric_zero("s")).collect()] == [2, 2, 0, 0, 0]
    nums = spark.createDataFrame([(7.0,), (float("nan"),), (2.5,), (3.5,)], "x double")
    assert [r[0] for r in nums.select(PZ.num_to_int("x")).collect()] == [7, None, 2, 4]
    txt = spark.createDataFrame([("7.0",), ("5503.0",), ("x",)], "s string")
    assert [r[0] for r in txt.select(PZ.to_int("s")).collect()] == [7, 5503, None]


def test_labels_and_flip(spark, bronze):
    m = V.analyzable_matches(FX.matches(spark), S.silver_shots(bronze))
    labels = {r.match_id: r.label for r in m.collect()}
    assert labels[1] == "2024-01-01 | A 2-0 B"
    assert labels[3] == "2024-01-03 | H 0-0 W"
    assert 2 not in labels                            # no shots -> not analyzable


def test_style_thresholds(spark):
    from pitchlake import schemas
    rows = [(1, "X", 0.8), (2, "Y", 1.2), (3, "Z", 1.0)]
    gold = spark.createDataFrame(
        [(m, t, p, None, None, None, None, 0.5, 0.5, 0.5, 1, 1) for m, t, p in rows],
        schemas.GOLD_FINGERPRINTS)
    style = {r.team_name: r.style for r in V.team_style(gold).collect()}
    assert style == {"X": "Aggressive Pressing", "Y": "Passive Block", "Z": None}


def test_q19_by_competition_option(spark):
    from pitchlake import schemas
    rows = [(1, "X", 1.0, 10, 7), (2, "X", 3.0, 11, 7), (3, "Y", 5.0, 10, 7)]
    gold = spark.createDataFrame(
        [(m, t, p, None, None, None, None, 0.5, 0.5, 0.5, c, s) for m, t, p, c, s in rows],
        schemas.GOLD_FINGERPRINTS)
    by_season = {r.season_id: r.ppda for r in V.league_average(gold).collect()}
    assert by_season == {7: pytest.approx(3.0)}         # mixes competitions sharing a season
    by_comp = {(r.competition_id, r.season_id): r.ppda
               for r in V.league_average(gold, by_competition=True).collect()}
    assert by_comp == {(10, 7): pytest.approx(3.0), (11, 7): pytest.approx(3.0)}
    prof = {(r.competition_id, r.team_name): (r.ppda, r.league_ppda)
            for r in V.team_profile(gold, by_competition=True).collect()}
    assert prof[(10, "X")] == (pytest.approx(1.0), pytest.approx(3.0))


def test_q3_plain_weighting_in_the_gold_rollup(bronze):
    t = Thresholds(carry_weighting="plain")
    gold = _by(G.fingerprints(S.silver_events(bronze), S.silver_carries(bronze), t),
               "match_id", "team_name")
    assert gold[(1, "A")].progressive_carry_rate == pytest.approx(0.5)
    assert gold[(1, "B")].progressive_carry_rate is None
