import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pitchlake.session import build_session
    s = build_session("local[*]", app="pitchlake-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def lake(spark):
    from pitchlake.session import lake_root
    return lake_root(spark)
