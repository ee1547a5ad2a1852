"""Hand-made series with known answers (pandas semantics), and the
expected leaderboard values of the fixture."""

import math

import pytest
from pyspark.sql import functions as F

from helpers import SF_MID, SF_SMALL, series_df
from tickwise.operators import backtest as BT
from tickwise.operators import indicators as I
from tickwise.operators import snapshot as SN
from tickwise.sources.fixtures import load_bars


def col(df, c):
    return [r[c] for r in df.orderBy("d").collect()]


def test_rsi_on_rising_series_is_missing_then_100(spark):
    rsi = col(I.rsi_sma(series_df(spark, range(1, 17))), "rsi")
    assert all(v is None for v in rsi[:13]) and all(v == 100.0 for v in rsi[13:])


def test_rsi_constant_is_missing_and_falling_is_zero(spark):
    assert all(v is None for v in col(I.rsi_sma(series_df(spark, [5.0] * 16)), "rsi"))
    falling = col(I.rsi_sma(series_df(spark, range(30, 14, -1))), "rsi")
    assert falling[13:] == [0.0] * 3


def test_strict_macd_and_wilder_first_valid_rows(spark):
    s = series_df(spark, [100 + i * 0.5 for i in range(60)])
    m = I.macd(s, strict=True).orderBy("d").collect()
    first_macd = next(i for i, r in enumerate(m) if r["macd"] is not None)
    first_sig = next(i for i, r in enumerate(m) if r["signal_line"] is not None)
    assert (first_macd, first_sig) == (25, 33)
    w = I.wilder(I.finish(I._gain_loss(I.prepare(s, 2), "close", I.KEYS)).drop("close")
                 .withColumnRenamed("_gain", "close"), 14).orderBy("d").collect()
    assert next(i for i, r in enumerate(w) if r["wilder_14"] is not None) == 13


def test_short_series_all_missing_signal_flat(spark):
    s = series_df(spark, [10, 11, 12, 11, 10])
    st = BT.strategy_frame(s).filter("NOT _halo").toPandas()
    sma = st[st.strategy == "SMA Crossover"]
    assert (sma["signal"] == 0.0).all()
    assert sma.sort_values("d")["position"].isna().tolist() == [True, False, False, False, False]


def test_one_row_series(spark):
    s = series_df(spark, [42.0])
    m = BT.run_all(s).collect()
    assert len(m) == 4
    assert all(r["final_equity"] is None and r["sharpe_ratio"] == 0.0 for r in m)
    assert SN.price_delta(s).count() == 0


def test_touching_smas_are_not_crosses(spark):
    # short == long on the prior bar: neither golden nor death cross fires
    vals = [1, 1, 1, 2, 0, 3]
    df = series_df(spark, vals)
    f = I.prepare(df, 3)
    f = I.add_sma(f, 1, out="s1").withColumn("s2", F.lit(1.0))
    out = I.finish(I.add_crosses(f, "s1", "s2")).orderBy("d").collect()
    golden = [r["golden_cross"] for r in out]
    death = [r["death_cross"] for r in out]
    assert golden == [False, False, False, False, False, True]
    assert death == [False, False, False, False, True, False]


@pytest.mark.parametrize("sf,expect", [
    (SF_SMALL, [("NO", "Bollinger Bands", 10090.9437, 0.909437, 0.807748),
                ("RF", "RSI Filter", 10087.0591, 0.870591, 0.578586)]),
    (SF_MID, [("AF", "RSI Filter", 10282.8410, 2.828410, 0.340295),
              ("RF", "Bollinger Bands", 10276.6766, 2.766766, 0.429408)]),
])
def test_leaderboard_matches_pandas_reference(spark, sf, expect):
    lb = BT.leaderboard(BT.run_all(load_bars(spark, sf))).collect()
    assert len(lb) == 24
    for row, (t, s, eq, ret, sh) in zip(lb, expect):
        assert (row["ticker"], row["strategy"]) == (t, s)
        assert row["final_equity"] == pytest.approx(eq, abs=1e-4)
        assert row["return_pct"] == pytest.approx(ret, abs=1e-6)
        assert row["sharpe"] == pytest.approx(sh, abs=1e-6)


def test_invariants(spark, bars_small):
    p = I.technical_panel(bars_small).toPandas()
    assert (p["drawdown_pct"] <= 0).all()
    r = p["rsi"].dropna()
    assert ((r >= 0) & (r <= 100)).all()
    assert not (p["golden_cross"] & p["death_cross"]).any()


def test_correlation_matrix_properties(spark):
    from tickwise.operators import correlation as CR
    bars = load_bars(spark, SF_MID)
    c = CR.corr_matrix(CR.complete_returns(CR.daily_returns(bars))).toPandas()
    assert len(c) == 36
    m = c.pivot(index="ticker_a", columns="ticker_b", values="corr")
    assert ((m.values >= -1 - 1e-12) & (m.values <= 1 + 1e-12)).all()
    assert (abs(m.values - m.values.T) < 1e-12).all()
    assert all(abs(m.loc[t, t] - 1) < 1e-12 for t in m.index)
    # the fixture's aligned, padded AF-AO return correlation (2,497 dates)
    assert m.loc["AF", "AO"] == pytest.approx(0.012000185743, abs=1e-9)


def test_constant_series_correlation_is_null(spark):
    from tickwise.operators import correlation as CR
    a = series_df(spark, [10.0] * 10, "A")
    b = series_df(spark, [10 + (i % 3) for i in range(10)], "B")
    c = CR.corr_matrix(CR.complete_returns(CR.daily_returns(a.unionByName(b)))).collect()
    vals = {(r["ticker_a"], r["ticker_b"]): r["corr"] for r in c}
    assert vals[("A", "B")] is None and vals[("A", "A")] is None
    assert vals[("B", "B")] == pytest.approx(1.0)


def test_backtest_by_hand(spark):
    """Long from the second bar: equity grows 100 -> 110 -> 99, on 10,000."""
    import datetime as dt
    rows = [("T", dt.date(2020, 1, k + 1), c, sg, po) for k, (c, sg, po) in enumerate(
        [(100.0, 1.0, None), (110.0, 1.0, 1.0), (99.0, 0.0, 1.0), (120.0, 0.0, 0.0)])]
    df = spark.createDataFrame(rows, "ticker string, d date, close double, signal double, position double")
    curve = BT.backtest_signals(df).orderBy("d").collect()
    assert [None if r.equity is None else round(r.equity, 6) for r in curve] == [None, 11000.0, 9900.0, 9900.0]
    m = BT.signal_metrics(df).first()
    assert m.final_equity == pytest.approx(9900.0) and m.total_return == pytest.approx(-0.01)
    # returns 0.1, -0.1, 0: mean 0, so the ratio is 0 too
    assert m.sharpe_ratio == pytest.approx(0.0, abs=1e-12)


def test_short_series_stay_flat(spark):
    vals = [100, 101, 99, 102, 103, 101, 104, 103, 106, 105, 107, 104, 108]
    m = {r["strategy"]: r for r in BT.run_all(series_df(spark, vals)).collect()}
    # fewer bars than every rolling window: flat, equity unchanged, Sharpe 0
    for name in ("SMA Crossover", "RSI Filter", "Bollinger Bands"):
        assert m[name]["final_equity"] == pytest.approx(10000.0)
        assert m[name]["sharpe_ratio"] == 0.0


def test_kde_against_brute_force_and_constant_series(spark):
    import numpy as np

    from tickwise.operators import correlation as CR
    rng = np.random.default_rng(7)
    vals = rng.normal(0, 0.01, 300)
    rows = [("A", i, float(v)) for i, v in enumerate(vals)] + [("C", i, 0.5) for i in range(20)]
    df = spark.createDataFrame(rows, "ticker string, i int, ret double").repartition(5)
    out = CR.return_density(df, gridsize=50).toPandas()
    a = out[out.ticker == "A"].sort_values("k")
    n, h = len(vals), vals.std(ddof=1) * len(vals) ** -0.2
    grid = np.linspace(vals.min() - 3 * h, vals.max() + 3 * h, 50)
    exp = np.exp(-((grid[:, None] - vals[None, :]) / h) ** 2 / 2).sum(axis=1) / (n * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose(a["x"].to_numpy(), grid, rtol=1e-12, atol=1e-15)
    np.testing.assert_allclose(a["density"].to_numpy(), exp, rtol=1e-9)
    c = out[out.ticker == "C"]
    assert len(c) == 50 and c["density"].isna().all()


@pytest.mark.parametrize("tile", [1, 2, 4])
def test_corr_matrix_tiled_equals_untiled(spark, tile):
    """Ticker blocks of 1, 2 and 4 (6 tickers -> 6, 3 and 2 blocks): the
    diagonal and cross tiles together give the single-tile matrix."""
    from tickwise.operators import correlation as CR
    comp = CR.complete_returns(CR.daily_returns(load_bars(spark, SF_MID))).cache()
    ref = {(r["ticker_a"], r["ticker_b"]): r["corr"] for r in CR.corr_matrix(comp).collect()}
    got = {(r["ticker_a"], r["ticker_b"]): r["corr"] for r in CR.corr_matrix(comp, tile_tickers=tile).collect()}
    assert set(got) == set(ref) and len(ref) == 36
    for k, v in ref.items():
        assert (v is None and got[k] is None) or abs(got[k] - v) < 1e-12, k


def test_padding_before_returns(spark):
    """A missing close is the last one before it: the move after the gap is kept whole."""
    import datetime as dt

    from tickwise.operators import correlation as CR
    day = lambda k: dt.date(2020, 1, 1) + dt.timedelta(days=k)
    rows = [("A", day(k), v) for k, v in enumerate([100.0, None, 110.0, 121.0])]
    rows += [("B", day(k), 50.0 + k) for k in (0, 1, 3)]
    df = spark.createDataFrame(rows, "ticker string, d date, close double")
    ret = {(r.ticker, r.d): r.ret for r in CR.daily_returns(df).collect()}
    assert [ret["A", day(k)] for k in range(2)] == [None, 0.0]
    assert ret["A", day(2)] == pytest.approx(0.1) and ret["A", day(3)] == pytest.approx(0.1)
    assert ret["B", day(2)] == 0.0 and ret["B", day(3)] == pytest.approx(53 / 51 - 1)
    for block_rows in (1, 2):
        closes = CR.padded_closes(df, block_rows=block_rows).orderBy("ticker", "d").collect()
        assert [r.close for r in closes] == [100.0, 100.0, 110.0, 121.0, 50.0, 51.0, 51.0, 53.0]


def test_constant_returns_have_no_correlation(spark):
    import datetime as dt

    from tickwise.operators import correlation as CR
    rows = [(t, dt.date(2020, 1, 1) + dt.timedelta(days=k), r) for k in range(10)
            for t, r in (("A", 0.1), ("B", 0.01 * (k % 3)), ("C", 1e6 + 1e-3 * k), ("D", -2e-3 * k))]
    c = CR.corr_matrix(spark.createDataFrame(rows, "ticker string, d date, ret double")).collect()
    v = {(r.ticker_a, r.ticker_b): r["corr"] for r in c}
    assert len(v) == 16 and all(v["A", t] is None and v[t, "A"] is None for t in "ABCD")
    assert v["B", "B"] == pytest.approx(1.0) and v["C", "D"] == pytest.approx(-1.0, abs=1e-6)


def test_one_tile_is_held_at_a_time():
    """Fed tile after tile, the partial products hand each on when the next begins."""
    import pandas as pd

    from tickwise.operators import correlation as CR
    live = []

    class Acc(CR._GramAcc):
        def __init__(self):
            super().__init__()
            live.append(self)

    def batches():
        for t in range(5):
            yield pd.DataFrame({"_ta": t, "_tb": t, "d": [1, 1, 2, 2], "_blk": t, "ticker": [f"a{t}", f"b{t}"] * 2, "x": [1.0, 2.0, 3.0, 4.0]})

    plain, CR._GramAcc = CR._GramAcc, Acc
    try:
        out = []
        for frame in CR._partial_gram(batches()):
            out.append(frame)
            assert len([a for a in live if a.index]) <= len(out) + 1
    finally:
        CR._GramAcc = plain
    assert len(out) == 5 and all(f.set_index(["ticker_a", "ticker_b"]).sxy.tolist() == [10.0, 14.0, 20.0] for f in out)
