"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and the matching
DuckDB SQL.  Every query reads the driver tables and runs over all rows.

Doubles are rounded identically on both sides so the value hash compares
like with like: price levels and averages to 6 dp (exact decimals of cent
prices stay away from ties), returns and drawdowns to 12 dp, other ratios to
6 dp, correlations to 9 dp, money curves to 2 dp.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise import oracle as O
from tickwise.operators import backtest as BT
from tickwise.operators import indicators as I
from tickwise.operators import strategies as ST
from tickwise.plans.materialize import materialize
from tickwise.sources import fixtures as FX

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def rnd(df: DataFrame, spec: dict[str, int]) -> DataFrame:
    """Round the named double columns (``+ 0.0`` folds -0.0 into 0.0)."""
    return df.withColumns({c: F.round(F.col(c), dp) + F.lit(0.0) for c, dp in spec.items()})


def sel(cols: list[tuple[str, int | None]]) -> str:
    """SQL select list: (expr AS name, dp) pairs; dp None = as is."""
    out = []
    for c, dp in cols:
        expr, _, name = c.partition(" AS ")
        name = name or expr
        out.append(f"{expr} AS {name}" if dp is None else f"(ROUND({expr}, {dp}) + 0.0) AS {name}")
    return ", ".join(out)


def bars(spark, sf):
    """Fixture bars of all of lineitem."""
    return FX.load_bars(spark, sf)


def series_bars(spark, sf):
    """The same with each bar's position in its series, which the day table of
    the walk gives for nothing: no series plan has to index them again."""
    return FX.load_bars(spark, sf, positions=True)


def written_bars(spark, sf):
    """Bars written once, for plans that read them for several purposes
    (calendar, first dates, closes)."""
    return materialize(FX.load_bars(spark, sf), "bars")


BASE = O.with_(O.BARS)

# ------------------------------------------------------------------ bars

register("ohlcv_daily", f"{BASE} SELECT ticker, d, open, high, low, close, volume FROM bars")(
    lambda spark, sf: bars(spark, sf))

# ------------------------------------------------------------------ E2, E3, F1


@register("sma_20_50_200", f"""{BASE}
SELECT ticker, d, {sel([(O.roll('AVG', 'close', 20) + ' AS sma_20', 6),
                        (O.roll('AVG', 'close', 50) + ' AS sma_50', 6),
                        (O.roll('AVG', 'close', 200) + ' AS sma_200', 6)])} FROM b""")
def q_sma(spark, sf):
    f = I.prepare(series_bars(spark, sf), 200)
    for n in (20, 50, 200):
        f = I.add_sma(f, n)
    return rnd(I.finish(f).select("ticker", "d", "sma_20", "sma_50", "sma_200"),
               {"sma_20": 6, "sma_50": 6, "sma_200": 6})


@register("rolling_std_20", f"""{BASE}
SELECT ticker, d, {sel([(O.roll('STDDEV_SAMP', 'close', 20) + ' AS std_20', 6)])} FROM b""")
def q_std(spark, sf):
    return rnd(I.rolling_std(series_bars(spark, sf), 20).select("ticker", "d", "std_20"), {"std_20": 6})


@register("bollinger", f"""{BASE},
bb AS (SELECT ticker, d, {O.roll('AVG', 'close', 20)} AS m, {O.roll('STDDEV_SAMP', 'close', 20)} AS s FROM b)
SELECT ticker, d, {sel([('m AS bb_middle', 6), ('m + 2 * s AS bb_upper', 6), ('m - 2 * s AS bb_lower', 6)])}
FROM bb""")
def q_bollinger(spark, sf):
    out = I.bollinger(series_bars(spark, sf), 20, 2.0).select("ticker", "d", "bb_middle", "bb_upper", "bb_lower")
    return rnd(out, {"bb_middle": 6, "bb_upper": 6, "bb_lower": 6})


# ------------------------------------------------------------------ E4, E5


def _ema_sql(span: int) -> str:
    a = 2 / (span + 1)
    return f"""{O.with_(O.BARS, O.ema_rec('e', 'b', [('y', 'close', a)], ['d']))}
SELECT ticker, d, {sel([(f'y AS ema_{span}', 6)])} FROM e"""


for _span in (20, 200):
    register(f"ema_{_span}", _ema_sql(_span))(
        (lambda s: lambda spark, sf: rnd(I.ema(series_bars(spark, sf), s).select("ticker", "d", f"ema_{s}"),
                                         {f"ema_{s}": 6}))(_span))


@register("wilder_gain", f"""{O.with_(O.BARS, O.gain_loss_cte('b'),
                                      O.ema_rec('e', 'gl', [('ag', 'gain', 1 / 14), ('al', 'loss', 1 / 14)], ['d']))}
SELECT ticker, d, {sel([('CASE WHEN i >= 13 THEN ag END AS avg_gain', 6),
                        ('CASE WHEN i >= 13 THEN al END AS avg_loss', 6)])} FROM e""")
def q_wilder(spark, sf):
    from tickwise.plans import series as S
    f = I.prepare(series_bars(spark, sf), 1)
    f = I._gain_loss(f, "close", I.KEYS)
    f = S.add_emas(f, ["ticker"], [("_gain", "avg_gain", 1 / 14, 14), ("_loss", "avg_loss", 1 / 14, 14)])
    return rnd(I.finish(f).select("ticker", "d", "avg_gain", "avg_loss"), {"avg_gain": 6, "avg_loss": 6})


# ------------------------------------------------------------------ F2, F3


@register("rsi_sma", f"""{O.with_(O.BARS, O.gain_loss_cte('b'))},
a AS (SELECT ticker, d, {O.roll('AVG', 'gain', 14)} AS ag, {O.roll('AVG', 'loss', 14)} AS al FROM gl)
SELECT ticker, d, {sel([(O.rsi_expr('ag', 'al') + ' AS rsi', 6)])} FROM a""")
def q_rsi_sma(spark, sf):
    return rnd(I.rsi_sma(series_bars(spark, sf), 14).select("ticker", "d", "rsi"), {"rsi": 6})


@register("rsi_wilder", f"""{O.with_(O.BARS, O.gain_loss_cte('b'),
                                     O.ema_rec('e', 'gl', [('ag', 'gain', 1 / 14), ('al', 'loss', 1 / 14)], ['d']))}
SELECT ticker, d, {sel([('CASE WHEN i >= 13 THEN ' + O.rsi_expr('ag', 'al') + ' END AS rsi', 6)])} FROM e""")
def q_rsi_wilder(spark, sf):
    return rnd(I.rsi_wilder(series_bars(spark, sf), 14).select("ticker", "d", "rsi"), {"rsi": 6})


# ------------------------------------------------------------------ F4, F5, B7, B13

register("macd", f"""{O.with_(O.BARS, O.macd_ctes())}
SELECT ticker, d, {sel([('macd', 6), ('sig AS signal_line', 6)])} FROM m""")(
    lambda spark, sf: rnd(I.macd(series_bars(spark, sf)).select("ticker", "d", "macd", "signal_line"),
                          {"macd": 6, "signal_line": 6}))

register("macd_strict", f"""{O.with_(O.BARS, O.macd_ctes(strict=True))}
SELECT ticker, d, {sel([('macd', 6), ('sig AS macd_signal', 6), ('macd - sig AS macd_hist', 6)])} FROM m""")(
    lambda spark, sf: rnd(I.macd(series_bars(spark, sf), strict=True)
                          .withColumnRenamed("signal_line", "macd_signal")
                          .select("ticker", "d", "macd", "macd_signal", "macd_hist"),
                          {"macd": 6, "macd_signal": 6, "macd_hist": 6}))

# ------------------------------------------------------------------ F6, F7, B10, H1

_CROSS_SQL = f"""{BASE},
s AS (SELECT ticker, d, {O.roll('AVG', 'close', 50)} AS s50, {O.roll('AVG', 'close', 200)} AS s200 FROM b),
x AS (SELECT *, COALESCE(s50 > s200 AND {O.lag('s50')} < {O.lag('s200')}, FALSE) AS golden,
                COALESCE(s50 < s200 AND {O.lag('s50')} > {O.lag('s200')}, FALSE) AS death FROM s)"""


def _events(spark, sf, mode):
    from tickwise.operators import zones as Z
    return rnd(Z.signal_events(I.crosses(series_bars(spark, sf)), mode), {"sma_50": 6, "sma_200": 6})


register("golden_cross", f"""{_CROSS_SQL}
SELECT ticker, d, 'entry' AS event, {sel([('s50 AS sma_50', 6), ('s200 AS sma_200', 6)])} FROM x WHERE golden""")(
    lambda spark, sf: _events(spark, sf, "Entry"))
register("death_cross", f"""{_CROSS_SQL}
SELECT ticker, d, 'exit' AS event, {sel([('s50 AS sma_50', 6), ('s200 AS sma_200', 6)])} FROM x WHERE death""")(
    lambda spark, sf: _events(spark, sf, "Exit"))
register("signal_events", f"""{_CROSS_SQL}
SELECT ticker, d, 'entry' AS event, {sel([('s50 AS sma_50', 6), ('s200 AS sma_200', 6)])} FROM x WHERE golden
UNION ALL
SELECT ticker, d, 'exit' AS event, {sel([('s50 AS sma_50', 6), ('s200 AS sma_200', 6)])} FROM x WHERE death""")(
    lambda spark, sf: _events(spark, sf, "Both"))

# ------------------------------------------------------------------ F8, F9, E10

register("drawdown", f"""{BASE}
SELECT ticker, d, ath, {sel([('close / ath - 1 AS drawdown_pct', 12)])}
FROM (SELECT *, MAX(close) {O.over()} AS ath FROM b)""")(
    lambda spark, sf: rnd(I.drawdown(series_bars(spark, sf)).select("ticker", "d", "ath", "drawdown_pct"),
                          {"drawdown_pct": 12}))

register("extension", f"""{BASE}
SELECT ticker, d, {sel([('(close - s200) / s200 AS extension_pct', 10)])}
FROM (SELECT *, {O.roll('AVG', 'close', 200)} AS s200 FROM b)""")(
    lambda spark, sf: rnd(I.extension(series_bars(spark, sf), 200).select("ticker", "d", "extension_pct"),
                          {"extension_pct": 10}))

# ------------------------------------------------------------------ F21

PANEL_COLS = {"sma_50": 6, "sma_200": 6, "ema_200": 6, "rsi": 6, "macd": 6, "signal_line": 6,
              "drawdown_pct": 12, "extension_pct": 6}


@register("technical_panel", f"""{O.with_(O.BARS, O.macd_ctes(), O.gain_loss_cte('b'),
                                          O.ema_rec('e200', 'b', [('y', 'close', 2 / 201)], ['d']))},
p AS (
  SELECT gl.ticker, gl.d, gl.close,
         {O.roll('AVG', 'gl.close', 50, 'PARTITION BY gl.ticker ORDER BY gl.d')} AS s50,
         {O.roll('AVG', 'gl.close', 200, 'PARTITION BY gl.ticker ORDER BY gl.d')} AS s200,
         {O.roll('AVG', 'gain', 14, 'PARTITION BY gl.ticker ORDER BY gl.d')} AS ag,
         {O.roll('AVG', 'loss', 14, 'PARTITION BY gl.ticker ORDER BY gl.d')} AS al,
         MAX(gl.close) {O.over(None, 'PARTITION BY gl.ticker ORDER BY gl.d')} AS ath,
         e200.y AS ema_200, m.macd, m.sig
  FROM gl JOIN m ON m.ticker = gl.ticker AND m.i = gl.i
          JOIN e200 ON e200.ticker = gl.ticker AND e200.i = gl.i
),
x AS (SELECT *, COALESCE(s50 > s200 AND {O.lag('s50')} < {O.lag('s200')}, FALSE) AS golden_cross,
                COALESCE(s50 < s200 AND {O.lag('s50')} > {O.lag('s200')}, FALSE) AS death_cross FROM p)
SELECT ticker, d, close, ath, golden_cross, death_cross,
       {sel([('s50 AS sma_50', 6), ('s200 AS sma_200', 6), ('ema_200', 6),
             (O.rsi_expr('ag', 'al') + ' AS rsi', 6), ('macd', 6), ('sig AS signal_line', 6),
             ('close / ath - 1 AS drawdown_pct', 12), ('(close - s200) / s200 AS extension_pct', 6)])}
FROM x""")
def q_panel(spark, sf):
    out = I.technical_panel(series_bars(spark, sf)).select(
        "ticker", "d", "close", "ath", "golden_cross", "death_cross", *PANEL_COLS)
    return rnd(out, PANEL_COLS)


# ------------------------------------------------------------------ F10-F13

def _strategy_sql(sig: str, extra: list[tuple[str, int | None]], src_ctes: list[str]) -> str:
    return f"""{O.with_(O.BARS, *src_ctes)},
z AS (SELECT *, {sig} AS signal FROM y)
SELECT ticker, d, {sel(extra + [('signal', None), (O.lag('signal') + ' AS position', None)])} FROM z"""


register("strategy_sma", _strategy_sql(
    "CASE WHEN sma_short > sma_long THEN 1.0 ELSE 0.0 END",
    [("sma_short", 6), ("sma_long", 6)],
    [f"y AS (SELECT ticker, d, {O.roll('AVG', 'close', 50)} AS sma_short, "
     f"{O.roll('AVG', 'close', 200)} AS sma_long FROM b)"]))(
    lambda spark, sf: rnd(ST.strategy_sma_crossover(series_bars(spark, sf)).select(
        "ticker", "d", "sma_short", "sma_long", "signal", "position"), {"sma_short": 6, "sma_long": 6}))

register("strategy_macd", _strategy_sql(
    "CASE WHEN macd > signal_line THEN 1.0 ELSE 0.0 END",
    [("macd", 6), ("signal_line", 6)],
    [O.macd_ctes(), "y AS (SELECT ticker, d, macd, sig AS signal_line FROM m)"]))(
    lambda spark, sf: rnd(ST.strategy_macd(series_bars(spark, sf)).select(
        "ticker", "d", "macd", "signal_line", "signal", "position"), {"macd": 6, "signal_line": 6}))

register("strategy_rsi", _strategy_sql(
    "CASE WHEN rsi < 70 THEN 1.0 ELSE 0.0 END",
    [("rsi", 6)],
    [O.gain_loss_cte("b"),
     f"a AS (SELECT ticker, d, {O.roll('AVG', 'gain', 14)} AS ag, {O.roll('AVG', 'loss', 14)} AS al FROM gl)",
     f"y AS (SELECT ticker, d, {O.rsi_expr('ag', 'al')} AS rsi FROM a)"]))(
    lambda spark, sf: rnd(ST.strategy_rsi(series_bars(spark, sf)).select(
        "ticker", "d", "rsi", "signal", "position"), {"rsi": 6}))

register("strategy_bollinger", _strategy_sql(
    "CASE WHEN close < bb_middle THEN 1.0 ELSE 0.0 END",
    [("bb_middle", 6)],
    [f"y AS (SELECT ticker, d, close, {O.roll('AVG', 'close', 20)} AS bb_middle FROM b)"]))(
    lambda spark, sf: rnd(ST.strategy_bollinger(series_bars(spark, sf)).select(
        "ticker", "d", "bb_middle", "signal", "position"), {"bb_middle": 6}))

# ------------------------------------------------------------------ F14-F18, B14, G1

_SIG = O.with_(O.BARS, O.signals_ctes())

register("backtest_curves", f"""{_SIG}
SELECT ticker, strategy, d, {sel([
    ('strategy_return', 12),
    ('CASE WHEN strategy_return IS NOT NULL THEN PRODUCT(1 + strategy_return) '
     'OVER (PARTITION BY ticker, strategy ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) '
     '* 10000.0 END AS equity', 2),
    ('CASE WHEN ret IS NOT NULL THEN PRODUCT(1 + ret) '
     'OVER (PARTITION BY ticker, strategy ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) '
     '* 10000.0 END AS market', 2)])}
FROM lg""")(
    lambda spark, sf: rnd(BT.backtest_curves(series_bars(spark, sf)).select(
        "ticker", "strategy", "d", "strategy_return", "equity", "market"),
        {"strategy_return": 12, "equity": 2, "market": 2}))

_METRICS = {"final_equity": 4, "total_return": 6, "sharpe_ratio": 6}

register("backtest_metrics", f"""{_SIG}
SELECT ticker, strategy, {sel([('final_equity', 4), ('total_return', 6), ('sharpe_ratio', 6)])} FROM summary""")(
    lambda spark, sf: rnd(BT.run_all(series_bars(spark, sf)).select(
        "ticker", "strategy", "final_equity", "total_return", "sharpe_ratio"), _METRICS))

register("best_strategy", f"""{_SIG}
SELECT ticker, strategy, {sel([('final_equity', 4), ('total_return', 6), ('sharpe_ratio', 6)])}
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY final_equity DESC, strategy_ord) AS rk
      FROM summary) WHERE rk = 1""")(
    lambda spark, sf: rnd(BT.best_strategy(BT.run_all(series_bars(spark, sf))).select(
        "ticker", "strategy", "final_equity", "total_return", "sharpe_ratio"), _METRICS))

register("leaderboard", f"""{_SIG}
SELECT ticker, strategy, {sel([('final_equity', 4), ('total_return * 100 AS return_pct', 6),
                               ('sharpe_ratio AS sharpe', 6)])}
FROM summary ORDER BY return_pct DESC, ticker, strategy_ord""")(
    lambda spark, sf: rnd(BT.leaderboard(BT.run_all(series_bars(spark, sf))).drop("strategy_ord"),
                          {"final_equity": 4, "return_pct": 6, "sharpe": 6}))

register("sharpe_band", f"""{_SIG}
SELECT ticker, strategy, {sel([('sharpe_ratio', 6)])},
       CASE WHEN sharpe_ratio >= 1 THEN 'good' WHEN sharpe_ratio > 0 THEN 'fair' ELSE 'poor' END AS sharpe_band
FROM summary""")(
    lambda spark, sf: rnd(BT.sharpe_band(BT.run_all(series_bars(spark, sf))).select(
        "ticker", "strategy", "sharpe_ratio", "sharpe_band"), {"sharpe_ratio": 6}))


# ------------------------------------------------------------------ F14, F16 with other parameters, one strategy

_PARAMS = {"short": 10, "long": 30, "fast": 5, "slow": 15, "signal": 4, "rsi_n": 7, "rsi_threshold": 60.0, "bb_n": 12}
register("leaderboard_params", f"""{O.with_(O.BARS, O.signals_ctes(**_PARAMS))}
SELECT ticker, strategy, {sel([('final_equity', 4), ('total_return', 9), ('sharpe_ratio', 6)])} FROM summary""")(
    lambda spark, sf: rnd(BT.run_all(series_bars(spark, sf), **_PARAMS).select(
        "ticker", "strategy", "final_equity", "total_return", "sharpe_ratio"),
        {"final_equity": 4, "total_return": 9, "sharpe_ratio": 6}))

register("backtest_one", f"""{O.with_(O.BARS, O.signals_ctes(**_PARAMS))}
SELECT ticker, d, signal, position, {sel([
    ('strategy_return', 12),
    ('CASE WHEN strategy_return IS NOT NULL THEN PRODUCT(1 + strategy_return) '
     'OVER (PARTITION BY ticker ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 5000.0 END AS equity', 2)])}
FROM lg WHERE strategy = 'MACD Momentum'""")(
    lambda spark, sf: rnd(BT.backtest_signals(
        ST.strategy_macd(series_bars(spark, sf), 5, 15, 4), "MACD Momentum", 5000.0).select(
        "ticker", "d", "signal", "position", "strategy_return", "equity"), {"strategy_return": 12, "equity": 2}))

# ------------------------------------------------------------------ C1, C2, C6, B3, D5, D8, E8, E11
from tickwise.operators import correlation as CR  # noqa: E402

_RET_CTES = f"""{BASE},
cal AS (SELECT DISTINCT d FROM bars),
fst AS (SELECT ticker, MIN(d) AS first_d FROM bars GROUP BY ticker),
grid AS (SELECT fst.ticker, cal.d, fst.first_d FROM fst JOIN cal ON cal.d >= fst.first_d),
padded AS (SELECT grid.ticker, grid.d, LAST_VALUE(bars.close IGNORE NULLS) OVER (PARTITION BY grid.ticker ORDER BY grid.d) AS close
           FROM grid LEFT JOIN bars ON bars.ticker = grid.ticker AND bars.d = grid.d),
dr AS (SELECT ticker, d, close / NULLIF({O.lag('close')}, 0) - 1 AS ret FROM padded),
full_d AS (SELECT d FROM dr WHERE ret IS NOT NULL GROUP BY d
           HAVING COUNT(*) = (SELECT COUNT(DISTINCT ticker) FROM dr)),
cr AS (SELECT * FROM dr WHERE d IN (SELECT d FROM full_d))"""


def _complete(spark, sf):
    """The complete returns, written once: they feed both sides of a pair."""
    return materialize(CR.complete_returns(CR.daily_returns(written_bars(spark, sf))), "complete_returns")


register("padded_closes", f"""{_RET_CTES}
SELECT ticker, d, close FROM padded""")(
    lambda spark, sf: CR.padded_closes(written_bars(spark, sf)))

# RSI over the padded closes: a ticker stands still on every date without a bar of its own
_QUIET = _RET_CTES + f""",
quiet AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY d) - 1 AS i FROM padded),
{O.gain_loss_cte('quiet')},
{O.ema_rec('e', 'gl', [('ag', 'gain', 1 / 14), ('al', 'loss', 1 / 14)], ['d'])}"""


@register("rsi_quiet", f"""{_QUIET}
SELECT ticker, d, {sel([('CASE WHEN i >= 13 THEN ' + O.rsi_expr('ag', 'al') + ' END AS rsi', 6)])} FROM e""")
def q_rsi_quiet(spark, sf):
    padded = CR.padded_closes(written_bars(spark, sf), keep_index=True)
    return rnd(I.rsi_wilder(padded, 14).select("ticker", "d", "rsi"), {"rsi": 6})


register("daily_returns", f"""{_RET_CTES}
SELECT ticker, d, {sel([('ret', 12)])} FROM dr""")(
    lambda spark, sf: rnd(CR.daily_returns(written_bars(spark, sf)), {"ret": 12}))

register("complete_returns", f"""{_RET_CTES}
SELECT ticker, d, {sel([('ret', 12)])} FROM cr""")(
    lambda spark, sf: rnd(CR.complete_returns(CR.daily_returns(written_bars(spark, sf))).select("ticker", "d", "ret"), {"ret": 12}))

# the tickers of the fixture, named so that the wide table's columns are known without a job
TICKERS = ["AF", "AO", "NF", "NO", "RF", "RO"]

_WIDE = ", ".join(f"MAX(close) FILTER (WHERE ticker = '{t}') AS \"{t}\"" for t in TICKERS)
register("aligned_matrix", f"{BASE} SELECT d, {_WIDE} FROM bars GROUP BY d")(
    lambda spark, sf: CR.aligned_matrix(bars(spark, sf), TICKERS))

register("corr_matrix", f"""{_RET_CTES}
SELECT a.ticker AS ticker_a, b.ticker AS ticker_b,
       {sel([('COVAR_SAMP(a.ret, b.ret) / NULLIF(STDDEV_SAMP(a.ret) * STDDEV_SAMP(b.ret), 0) AS corr', 9)])}
FROM cr a JOIN cr b ON a.d = b.d GROUP BY a.ticker, b.ticker""")(
    lambda spark, sf: rnd(CR.corr_matrix(_complete(spark, sf)), {"corr": 9}))

_PAIRS_SQL = f"""{_RET_CTES},
pr AS (SELECT a.ticker AS ticker_a, b.ticker AS ticker_b, a.d, a.ret AS ret_a, b.ret AS ret_b
       FROM cr a JOIN cr b ON a.d = b.d AND a.ticker < b.ticker)"""


def _pairs(spark, sf):
    c = _complete(spark, sf)
    return CR.pairwise_returns(c, CR.ticker_pairs(spark, TICKERS))


register("pairwise_returns", f"""{_PAIRS_SQL}
SELECT ticker_a, ticker_b, d, {sel([('ret_a', 12), ('ret_b', 12)])} FROM pr""")(
    lambda spark, sf: rnd(_pairs(spark, sf), {"ret_a": 12, "ret_b": 12}))

_RW = "PARTITION BY ticker_a, ticker_b ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW"
register("rolling_corr_30", f"""{_PAIRS_SQL}
SELECT ticker_a, ticker_b, d, {sel([(
    f'CASE WHEN COUNT(ret_a) OVER ({_RW}) = 30 '
    f'AND STDDEV_SAMP(ret_a) OVER ({_RW}) * STDDEV_SAMP(ret_b) OVER ({_RW}) > 0 '
    f'THEN COVAR_SAMP(ret_a, ret_b) OVER ({_RW}) / '
    f'(STDDEV_SAMP(ret_a) OVER ({_RW}) * STDDEV_SAMP(ret_b) OVER ({_RW})) END AS corr', 9)])}
FROM pr""")(
    lambda spark, sf: rnd(CR.rolling_corr(_pairs(spark, sf), 30), {"corr": 9}))

register("return_density", f"""{_RET_CTES},
st AS (SELECT ticker, COUNT(ret) AS n, STDDEV_SAMP(ret) * POW(COUNT(ret), -0.2) AS h,
              MIN(ret) AS lo, MAX(ret) AS hi FROM cr WHERE ret IS NOT NULL GROUP BY ticker),
g AS (SELECT ticker, n, h, k, (lo - 3 * h) + k * ((hi - lo + h * 6) / 199) AS x
      FROM st, range(200) t(k))
SELECT g.ticker, CAST(g.k AS INTEGER) AS k, {sel([('g.x AS x', 8),
    ('SUM(EXP(-((g.x - cr.ret) / g.h) * ((g.x - cr.ret) / g.h) / 2)) / (g.n * g.h * SQRT(2 * PI())) AS density', 8)])}
FROM g JOIN cr ON cr.ticker = g.ticker AND cr.ret IS NOT NULL
GROUP BY g.ticker, g.k, g.x, g.n, g.h""")(
    lambda spark, sf: rnd(CR.return_density(_complete(spark, sf)), {"x": 8, "density": 8}))


# part 2 registers into the same dictionaries
import tickwise.catalog_app  # noqa: E402,F401
