import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from dockcast.session import build_session
    s = build_session("local[*]", app="dockcast-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{SF01}/events.parquet")
