"""Paths and hand-made series shared by the tests."""

import datetime as dt

from tickwise.schemas import BARS

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def series_df(spark, values, ticker="T", start="2020-01-01"):
    """A bars frame from a list of closes (None: no close); ``values`` may be
    a dict of ticker -> list."""
    d0 = dt.date.fromisoformat(start)
    series = values if isinstance(values, dict) else {ticker: values}
    rows = []
    for name, closes in series.items():
        for i, v in enumerate(closes):
            v = None if v is None else float(v)
            rows.append((name, d0 + dt.timedelta(days=i), v, v, v, v, 100))
    return spark.createDataFrame(rows, BARS)
