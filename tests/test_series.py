"""Blocked series frames against plain pandas, with blocks small enough to
force many blocks and halo copies per ticker."""

import numpy as np
import pandas as pd
import pytest

from tickwise.operators import indicators as I
from tickwise.plans import series as S


def _cmp(spark_df, col, ref: pd.Series, bars_pd, rtol=1e-9):
    got = spark_df.select("ticker", "d", col).toPandas().sort_values(["ticker", "d"]).reset_index(drop=True)
    assert len(got) == len(bars_pd)
    a, b = got[col].to_numpy(dtype=float), ref.to_numpy(dtype=float)
    assert (np.isnan(a) == np.isnan(b)).all(), f"{col}: null positions differ"
    m = ~np.isnan(b)
    np.testing.assert_allclose(a[m], b[m], rtol=rtol, atol=1e-9)


def _by_ticker(bars_pd, fn):
    return pd.concat([fn(g) for _, g in bars_pd.groupby("ticker", sort=True)]).reset_index(drop=True)


def test_index_is_dense_and_ordered(bars_small, bars_pd):
    idx = S.index_series(bars_small, ["ticker"], ["d"], S.date_bucket("d", 8)).toPandas()
    idx = idx.sort_values(["ticker", "d"])
    for _, g in idx.groupby("ticker"):
        assert list(g["_i"]) == list(range(len(g)))


@pytest.mark.parametrize("block_rows", [64, 256])
def test_rolling_and_scans_across_blocks(bars_small, bars_pd, block_rows):
    f = I.prepare(bars_small, 50, block_rows=block_rows)
    f = I.add_sma(f, 20)
    f = I.add_rolling_std(f, 20)
    f = I.add_sma(f, 50)
    f = I.add_drawdown(f)
    f = I.add_pct_change(f)
    f = I.add_cumprod(f.withColumn("g", 1 + f["ret"]), "g", "cp")
    out = I.finish(f).cache()
    c = bars_pd.groupby("ticker", sort=True)["close"]
    _cmp(out, "sma_20", c.transform(lambda s: s.rolling(20).mean()), bars_pd)
    _cmp(out, "std_20", c.transform(lambda s: s.rolling(20).std()), bars_pd, rtol=1e-6)
    _cmp(out, "sma_50", c.transform(lambda s: s.rolling(50).mean()), bars_pd)
    _cmp(out, "ath", c.transform(lambda s: s.cummax()), bars_pd)
    ret = c.transform(lambda s: s.pct_change())
    _cmp(out, "ret", ret, bars_pd)
    cp = (1 + ret).groupby(bars_pd["ticker"]).cumprod()
    _cmp(out, "cp", cp, bars_pd)


@pytest.mark.parametrize("span,mp", [(9, 0), (12, 12), (26, 0)])
def test_ema_block_scan_matches_pandas(bars_small, bars_pd, span, mp):
    out = I.ema(bars_small, span, min_periods=mp, block_rows=256)
    ref = bars_pd.groupby("ticker", sort=True)["close"].transform(
        lambda s: s.ewm(span=span, adjust=False, min_periods=mp).mean())
    _cmp(out, f"ema_{span}", ref, bars_pd, rtol=1e-12)


def test_nested_ema_strict_macd_across_blocks(bars_small, bars_pd):
    out = I.macd(bars_small, strict=True, block_rows=64)

    def ref(g):
        c = g["close"]
        k = c.ewm(span=12, adjust=False, min_periods=12).mean()
        d = c.ewm(span=26, adjust=False, min_periods=26).mean()
        m = k - d
        return pd.DataFrame({"macd": m, "sig": m.ewm(span=9, adjust=False, min_periods=9).mean()})
    r = _by_ticker(bars_pd, ref)
    _cmp(out, "macd", r["macd"], bars_pd, rtol=1e-6)
    _cmp(out, "signal_line", r["sig"], bars_pd, rtol=1e-6)


def test_ffill_scan(spark):
    from tickwise.plans.series import ffill_scan
    rows = [("A", i, None if i % 3 else float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "ticker string, k int, x double")
    f = S.with_blocks(S.index_series(df, ["ticker"], ["k"], (df["k"] / 4).cast("long")), 4, 8)
    out = S.drop_halo(ffill_scan(f, ["ticker"], "x", "xf")).orderBy("k").toPandas()
    exp = pd.Series([r[2] for r in rows]).ffill()
    assert out["xf"].tolist() == exp.tolist()


def test_halo_larger_than_block_is_rejected(bars_small):
    idx = S.index_series(bars_small, ["ticker"], ["d"], S.date_bucket("d"))
    with pytest.raises(ValueError):
        S.with_blocks(idx, 100, 64)


def test_backtest_curves_same_with_many_blocks(bars_small):
    """Both equity products share one carry table; 64-row blocks must give the
    single-block curves (signals, positions and cumulative products)."""
    from tickwise.operators import backtest as BT
    cols = ["ticker", "strategy", "d", "position", "equity", "market"]
    a = BT.backtest_curves(bars_small, block_rows=64).select(*cols).toPandas()
    b = BT.backtest_curves(bars_small).select(*cols).toPandas()
    key = ["ticker", "strategy", "d"]
    a, b = a.sort_values(key).reset_index(drop=True), b.sort_values(key).reset_index(drop=True)
    assert len(a) == len(b) and (a[key] == b[key]).all().all()
    for c in ["position", "equity", "market"]:
        x, y = a[c].to_numpy(dtype=float), b[c].to_numpy(dtype=float)
        assert (np.isnan(x) == np.isnan(y)).all()
        m = ~np.isnan(y)
        np.testing.assert_allclose(x[m], y[m], rtol=1e-9)


def test_adaptive_buckets_index_ticks_densely(spark):
    """A width targeting ~4 rows per (ticker, bucket) gives many buckets per
    ticker; the positions must still be 0..n-1 in time order."""
    from tickwise.sources.fixtures import load_ticks
    from tickwise.operators.medallion import dedup_ticks
    t = dedup_ticks(load_ticks(spark, "/root/testdata/sf0.001")).select("ticker", "timestamp")
    width = S.adaptive_width(t, "timestamp", ["ticker"], target_rows=4)
    idx = S.index_series(t, ["ticker"], ["timestamp"], S.seconds_bucket("timestamp", width)).toPandas()
    assert t.select(S.seconds_bucket("timestamp", width).alias("b")).distinct().count() > 20
    for _, g in idx.sort_values(["ticker", "timestamp"]).groupby("ticker"):
        assert list(g["_i"]) == list(range(len(g)))


def _one(spark, values):
    import datetime as dt
    return spark.createDataFrame([("T", dt.date(1900, 1, 1) + dt.timedelta(days=k), v) for k, v in enumerate(values)],
                                 "ticker string, d date, close double")


def test_ema_decays_by_position_over_gaps(spark):
    values = [None, 1.0, None, 3.0, 4.0, None, None, 2.0]
    out = I.ema(_one(spark, values), 3).orderBy("d").toPandas()["ema_3"]
    want = pd.Series(values, dtype=float).ewm(alpha=0.5, adjust=False).mean()
    np.testing.assert_allclose(out.to_numpy(dtype=float), want.to_numpy(), rtol=1e-14)
    assert abs(out[3] - 7 / 3) < 1e-14


@pytest.mark.parametrize("every", [1, 3, 997])
def test_wilder_rsi_of_a_ticker_that_stops_and_has_gaps(spark, every):
    """200 moving closes, then 9,000 flat ones, in many blocks of the least
    size the halo allows; with ``every`` > 1 gaps in between."""
    rng = np.random.default_rng(2)
    values = list(100 + np.cumsum(rng.standard_normal(200))) + [100.0] * 9000
    values += list(100 + np.cumsum(rng.standard_normal(20000)))
    x = pd.Series([v if k % every == 0 or k < 200 else None for k, v in enumerate(values)], dtype=float)
    df = _one(spark, [None if np.isnan(v) else float(v) for v in x])
    f = I.prepare(df, S.ema_halo([1 / 14]), block_rows=1)
    f = S.add_emas(f, ["ticker"], [("close", "y", 1 / 14, 14)])
    out = I.finish(f).orderBy("d").toPandas()["y"].to_numpy(dtype=float)
    want = x.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean().to_numpy()
    assert (np.isnan(out) == np.isnan(want)).all()
    np.testing.assert_allclose(out[~np.isnan(want)], want[~np.isnan(want)], rtol=1e-10)


def test_wilder_rsi_stays_while_flat(spark):
    rng = np.random.default_rng(3)
    c = pd.Series(list(100 + np.cumsum(rng.standard_normal(200))) + [100.0] * 4000)
    d = c.diff()
    g, l = (x.fillna(0.0).ewm(alpha=1 / 14, adjust=False, min_periods=14).mean() for x in (d.clip(lower=0), (-d).clip(lower=0)))
    want = (100 - 100 / (1 + g / l)).to_numpy()
    out = I.rsi_wilder(_one(spark, [float(v) for v in c])).orderBy("d").toPandas()["rsi"].to_numpy(dtype=float)
    assert (np.isnan(out) == np.isnan(want)).all()
    np.testing.assert_allclose(out[13:], want[13:], rtol=1e-9)


def test_parameters_do_not_depend_on_blocks(spark):
    from tickwise.operators import backtest as BT
    from tickwise.operators import strategies as ST
    rng = np.random.default_rng(4)
    df = _one(spark, [float(v) for v in 100 * np.exp(np.cumsum(rng.standard_normal(6000) / 100))])
    p = {"short": 40, "long": 700, "slow": 60}
    a = BT.run_all(df, block_rows=1, **p).orderBy("strategy_ord").collect()
    b = BT.run_all(df, **p).orderBy("strategy_ord").collect()
    np.testing.assert_allclose([r.final_equity for r in a], [r.final_equity for r in b], rtol=1e-9)
    one = BT.signal_metrics(ST.strategy_sma_crossover(df, 40, 700), "SMA Crossover").first()
    assert abs(one.final_equity - b[0].final_equity) < 1e-6
    last = BT.backtest_signals(ST.strategy_sma_crossover(df, 40, 700)).orderBy("d").collect()[-1]
    assert abs(last.equity - one.final_equity) < 1e-6


def test_flat_closes_give_no_macd_sign(spark):
    """Eight tickers that never move, at levels a double can't hold exactly."""
    from helpers import series_df

    from tickwise.operators import strategies as ST
    from tickwise.operators import zones as Z
    levels = [5001.5, 0.1, 99.99, 1234.56, 1 / 3, 7e-9, 3.3e7, 17.35]
    df = series_df(spark, {f"T{k}": [v] * 300 for k, v in enumerate(levels)})
    for strict in (False, True):
        m = I.macd(df, strict=strict, block_rows=64).toPandas()
        start = 25 if strict else 0
        got = m.sort_values(["ticker", "d"])["macd"].to_numpy(dtype=float).reshape(8, 300)
        assert np.isnan(got[:, :start]).all() and (got[:, start:] == 0).all()
    assert Z.macd_regime(I.macd(df)).where("regime IS NOT NULL").count() == 0
    assert Z.hist_sign(I.macd(df, strict=True)).where("hist_sign = 'neg'").count() == 0
    assert ST.strategy_macd(df).where("signal > 0").count() == 0


def test_macd_sign_holds_on_in_a_flat_stretch(spark):
    """A rise, then 400 equal closes: the slow average lags behind all along,
    and the exact signs are those of the plain recursion in high precision."""
    from decimal import Decimal, getcontext
    getcontext().prec = 60
    c = [100 + k for k in range(30)] + [129] * 400

    def ema(xs, span):
        a, y, out = Decimal(2) / (span + 1), None, []
        for x in xs:
            y = Decimal(x) if y is None else (1 - a) * y + a * Decimal(x)
            out.append(y)
        return out
    m = [f - s for f, s in zip(ema(c, 12), ema(c, 26))]
    out = I.macd(_one(spark, [float(v) for v in c]), block_rows=64).orderBy("d").toPandas()
    np.testing.assert_allclose(out["macd"].to_numpy(dtype=float), [float(x) for x in m], rtol=1e-9, atol=1e-12)
    assert (out["macd"].iloc[1:] > 0).all()


def test_ema_over_a_long_null_run(spark):
    """300 values, 2,500 NULLs, 300 values, in blocks of 64 to 2,048 rows."""
    rng = np.random.default_rng(6)
    values = [*rng.uniform(10, 20, 300), *[None] * 2500, *rng.uniform(10, 20, 300)]
    values = [None if v is None else float(v) for v in values]
    x = pd.Series(values, dtype=float)
    for rows in (64, 2048):
        for span, mp in ((3, 0), (200, 310)):
            out = I.ema(_one(spark, values), span, min_periods=mp, block_rows=rows).orderBy("d").toPandas()[f"ema_{span}"].to_numpy(dtype=float)
            want = x.ewm(span=span, adjust=False, min_periods=mp).mean().to_numpy()
            assert (np.isnan(out) == np.isnan(want)).all()
            np.testing.assert_allclose(out[~np.isnan(want)], want[~np.isnan(want)], rtol=1e-12)


def test_averages_carry_over_many_blocks_without_a_halo(spark):
    rng = np.random.default_rng(7)
    x = pd.Series(5000 + np.cumsum(rng.standard_normal(7000)))
    assert I.panel_halo() <= 201 and S.ema_halo([2 / 201]) == 0
    for span in (2, 9, 200, 5000):
        out = I.ema(_one(spark, [float(v) for v in x]), span, block_rows=128).orderBy("d").toPandas()[f"ema_{span}"]
        np.testing.assert_allclose(out, x.ewm(span=span, adjust=False).mean(), rtol=1e-12)


@pytest.mark.parametrize("n", [2, 20, 2000])
def test_rolling_moments_of_any_length(spark, n):
    """Against pandas; closes with gaps, a flat stretch and a large level."""
    rng = np.random.default_rng(8)
    x = pd.Series(1e5 + np.cumsum(rng.standard_normal(6000)))
    x[2500:2600] = x[2500]
    x[[7, 5000]] = np.nan
    df = _one(spark, [None if np.isnan(v) else float(v) for v in x])
    f = S.add_rolling(I.prepare(df, n), ["ticker"], [S.Rolling("close", n, "m", "s")])
    out = I.finish(f).orderBy("d")
    assert f"RowFrame, -{n - 1}, currentrow" not in out._jdf.queryExecution().executedPlan().toString()  # no frame of n rows
    out = out.toPandas()
    # straight from the definition: pandas' own running sums are off by 1e-5 at this level
    frames = np.lib.stride_tricks.sliding_window_view(x.to_numpy() - 1e5, n)
    lead = np.full(n - 1, np.nan)
    for c, want, near in (("m", frames.mean(1) + 1e5, 1e-9), ("s", frames.std(1, ddof=1), 2e-8)):
        got, want = out[c].to_numpy(dtype=float), np.concatenate([lead, want])
        assert (np.isnan(got) == np.isnan(want)).all()
        np.testing.assert_allclose(got[~np.isnan(want)], want[~np.isnan(want)], rtol=1e-9, atol=near)
    if n == 20:
        assert (out["s"].iloc[2520:2600] == 0).all() and (out["m"].iloc[2520:2600] == x[2500]).all()


def test_wilder_rsi_on_a_quiet_ticker(spark):
    """Closes that move at every 700th row only."""
    rng = np.random.default_rng(9)
    c = pd.Series([float(100 + k) if k < 200 else (float(rng.uniform(90, 110)) if k % 700 == 0 else np.nan) for k in range(5000)]).ffill()
    d = c.diff()
    g, l = (v.fillna(0.0).ewm(alpha=1 / 14, adjust=False, min_periods=14).mean() for v in (d.clip(lower=0), (-d).clip(lower=0)))
    want = (100 - 100 / (1 + g / l)).to_numpy()
    out = I.rsi_wilder(_one(spark, [float(v) for v in c])).orderBy("d").toPandas()["rsi"].to_numpy(dtype=float)
    assert (np.isnan(out) == np.isnan(want)).all()
    np.testing.assert_allclose(out[13:], want[13:], rtol=1e-9)


def test_averages_of_the_given_bars_equal_exact_arithmetic(spark):
    """To 2e-12 of the recursion in 50 digits, closer than the recursion in
    doubles, which is off by 2e-11 at AF's 1,882nd bar."""
    from decimal import Decimal, getcontext

    from helpers import SF_MID

    from tickwise.sources.fixtures import load_bars
    getcontext().prec = 50
    out = I.ema(load_bars(spark, SF_MID, positions=True).where("ticker = 'AF'"), 200).orderBy("d").toPandas()
    a, y, far = Decimal(2) / 201, None, []
    for x, got in zip(out["close"], out["ema_200"]):
        y = Decimal(repr(float(x))) if y is None else (1 - a) * y + a * Decimal(repr(float(x)))
        far.append(abs(Decimal(repr(float(got))) - y))
    assert max(far) < Decimal("2e-12")
