import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

@pytest.fixture(scope="session")
def spark():
    from tickwise.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def bars_small(spark):
    from helpers import SF_SMALL
    from tickwise.sources.fixtures import load_bars
    return load_bars(spark, SF_SMALL).cache()


@pytest.fixture(scope="session")
def bars_pd(bars_small):
    return bars_small.toPandas().sort_values(["ticker", "d"]).reset_index(drop=True)

