"""Bars from the lineitem price walk with chunk widths small enough that
most (ticker, day) groups span many chunks: the per-day and per-ticker level
carries must give the same bars as the plain running-sum SQL."""

import duckdb
import pytest

from helpers import SF_SMALL
from tickwise.catalog import SQL
from tickwise.sources.fixtures import load_bars
from tools.compare import digest, norm


@pytest.fixture(scope="module")
def expected():
    con = duckdb.connect()
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{SF_SMALL}/lineitem.parquet'")
    return digest(norm(con.sql(SQL["ohlcv_daily"]).df()))


@pytest.mark.parametrize("width", [1, 5, 97])
def test_bars_match_walk_with_many_chunks_per_day(spark, expected, width):
    got = load_bars(spark, SF_SMALL, chunk_keys=width).toPandas()
    assert digest(norm(got)) == expected


def test_sized_chunks_from_the_data(spark, expected):
    """The sizing subquery with a tiny target: many
    data-sized chunks per day, same bars."""
    from tickwise.sources import fixtures as FX
    li = FX.table(spark, SF_SMALL, "lineitem")
    width = FX.chunk_width(li, target_rows=3)
    assert not isinstance(width, int)
    got = FX.bars_from_lineitem(li, width).toPandas()
    assert digest(norm(got)) == expected
