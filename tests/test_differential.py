"""Every registered query vs its DuckDB oracle (the driver's correctness gate)."""

import pytest

import __spark_entry__ as E
from tests import diffcheck
from tests.conftest import SF001, SF01

GATE = ["gold_fingerprints", "gold_ppda", "gold_progressive_carries", "match_momentum",
        "cumulative_xg", "team_dna", "radar_long", "pressing_leaders", "shot_summary",
        "join_carry_team", "silver_events"]


@pytest.fixture(scope="module")
def con001():
    return diffcheck.duck(SF001)


@pytest.fixture(scope="module")
def con01():
    return diffcheck.duck(SF01)


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_query_matches_oracle_sf0001(spark, con001, key):
    ok, msg = diffcheck.compare(spark, key, SF001, con001)
    assert ok, msg


@pytest.mark.parametrize("key", GATE)
def test_query_matches_oracle_sf001(spark, con01, key):
    ok, msg = diffcheck.compare(spark, key, SF01, con01)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "ppda" in df.columns and "team_name" in df.columns
