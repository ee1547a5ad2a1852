"""Property test: for random multi-ticker series and random block sizes, the
blocked plans (index, halo, carries, EMA sub-blocks) equal pandas on the
plain per-ticker series."""

import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickwise.operators import indicators as I

START = dt.date(2020, 1, 1)


@st.composite
def panels(draw):
    n_tickers = draw(st.integers(1, 3))
    rows = []
    for t in range(n_tickers):
        n = draw(st.integers(1, 200))
        gaps = draw(st.lists(st.integers(1, 4), min_size=n, max_size=n))
        closes = draw(st.lists(st.floats(1.0, 1000.0, allow_nan=False), min_size=n, max_size=n))
        day = 0
        for g, c in zip(gaps, closes):
            day += g
            rows.append((f"T{t}", START + dt.timedelta(days=day), float(c)))
    return rows, draw(st.sampled_from([8, 16, 64])), draw(st.integers(2, 12))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=panels())
def test_blocked_series_equal_pandas(spark, data):
    rows, block_rows, n = data
    df = spark.createDataFrame(rows, "ticker string, d date, close double")
    # rolling frame and cummax on blocks as small as the halo allows
    f = I.prepare(df, n, block_rows=max(block_rows, n))
    f = I.add_cummax(I.add_sma(f, n, out="sma"), out="ath")
    got = I.finish(f).toPandas().sort_values(["ticker", "d"]).reset_index(drop=True)
    # a short exponent for the sub-blocks, so that the halo is small and blocks cut the series
    e = I.prepare(df, I.EMA_HALO([0.999]), block_rows=64)
    e = I.finish(I.add_ema(e, alpha=0.999, out="ema")).toPandas().sort_values(["ticker", "d"])
    got["ema"] = e["ema"].to_numpy()
    pdf = pd.DataFrame(rows, columns=["ticker", "d", "close"]).sort_values(["ticker", "d"]).reset_index(drop=True)
    g = pdf.groupby("ticker", sort=True)["close"]
    exp = {
        "sma": g.transform(lambda s: s.rolling(n).mean()),
        "ema": g.transform(lambda s: s.ewm(alpha=0.999, adjust=False).mean()),
        "ath": g.transform(lambda s: s.cummax()),
    }
    assert len(got) == len(pdf)
    for c, ref in exp.items():
        a, b = got[c].to_numpy(dtype=float), ref.to_numpy(dtype=float)
        assert (np.isnan(a) == np.isnan(b)).all(), c
        m = ~np.isnan(b)
        np.testing.assert_allclose(a[m], b[m], rtol=1e-9, atol=1e-9, err_msg=c)
