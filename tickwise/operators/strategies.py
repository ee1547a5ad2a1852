"""Rule-based trading strategies (F10-F13) and all of them in one plan (F16).

A signal is 1.0 (long) or 0.0 (flat), never short; warm-up rows are 0.0,
not NULL.  The position is the signal of the previous bar (trade on the next
bar), NULL on a series' first row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.functions.columns import flag
from tickwise.operators import indicators as I
from tickwise.plans import series as S

# Fixed strategy names and their tie-break order (the order strategies are run).
STRATEGY_NAMES = ["SMA Crossover", "MACD Momentum", "RSI Filter", "Bollinger Bands"]


def _position(f, signal: str, out: str, keys=I.KEYS):
    return f.withColumn(out, F.lag(F.col(signal), 1).over(S.block_window(list(keys))))


def add_sma_crossover(f, short: int = 50, long: int = 200, keys=I.KEYS) -> DataFrame:
    """long while SMA_short > SMA_long."""
    f = S.add_rolling(f, keys, [S.Rolling("close", short, mean="sma_short"), S.Rolling("close", long, mean="sma_long")])
    f = f.withColumn("signal", flag(F.col("sma_short") > F.col("sma_long")))
    return _position(f, "signal", "position", keys)


def add_macd_strategy(f, fast: int = 12, slow: int = 26, signal: int = 9, keys=I.KEYS) -> DataFrame:
    """long while MACD > its signal line (EMAs without min_periods)."""
    f = I.macd_of(S.scan(f, list(keys), I.macd_specs(fast, slow), halo=0))
    f = I.add_signal_line(f, signal, keys=keys, halo=1)
    f = f.withColumn("signal", flag(F.col("macd") > F.col("signal_line")))
    return _position(f, "signal", "position", keys)


def add_rsi_strategy(f, window: int = 14, sell_threshold: float = 70.0, keys=I.KEYS) -> DataFrame:
    """long whenever the SMA-RSI is below the threshold."""
    f = I.add_rsi_sma(f, window, out="rsi", keys=keys)
    f = f.withColumn("signal", flag(F.col("rsi") < sell_threshold))
    return _position(f, "signal", "position", keys)


def add_bollinger_strategy(f, window: int = 20, num_std: float = 2.0, keys=I.KEYS) -> DataFrame:
    """long while close < the middle band.  ``num_std`` shapes the bands
    but, as in the original rule, does not enter the signal."""
    f = I.add_bollinger(f, window, num_std, keys=keys)
    f = f.withColumn("signal", flag(F.col("close") < F.col("bb_middle")))
    return _position(f, "signal", "position", keys)


def strategy_halo(short=50, long=200, fast=12, slow=26, signal=9, rsi_n=14, rsi_threshold=70.0, bb_n=20) -> int:
    """Rows of history that ``add_all_signals`` with these parameters sees."""
    return max(short, long, rsi_n + 1, bb_n) + 1


def _single(bars, fn, halo, block_rows=None):
    return I.finish(fn(I.prepare(bars, halo, block_rows=block_rows)))


def strategy_sma_crossover(bars, short=50, long=200, block_rows=None):
    return _single(bars, lambda f: add_sma_crossover(f, short, long), max(short, long) + 1, block_rows)


def strategy_macd(bars, fast=12, slow=26, signal=9, block_rows=None):
    return _single(bars, lambda f: add_macd_strategy(f, fast, slow, signal),
                   0, block_rows)


def strategy_rsi(bars, window=14, sell_threshold=70.0, block_rows=None):
    return _single(bars, lambda f: add_rsi_strategy(f, window, sell_threshold), window + 2, block_rows)


def strategy_bollinger(bars, window=20, num_std=2.0, block_rows=None):
    return _single(bars, lambda f: add_bollinger_strategy(f, window, num_std), window + 1, block_rows)


def add_all_signals(f, short=50, long=200, fast=12, slow=26, signal=9, rsi_n=14,
                    rsi_threshold=70.0, bb_n=20, keys=I.KEYS) -> DataFrame:
    """F16 step 1: the four signals and positions side by side, plus the
    bar return: one frame for all that looks back a fixed number of rows, a
    scan for the MACD and one for its signal line, a lag for the positions."""
    columns = [c for c in f.columns if c not in (S.IDX, S.BLK, S.HALO)]
    f = S.add_rolling(I._gain_loss(f, "close", keys, "ret"), keys, [
        *(S.Rolling("close", n, mean=c) for n, c in ((short, "_sma_s"), (long, "_sma_l"), (bb_n, "_bb_mid"))),
        S.Rolling("_gain", rsi_n, mean="_ag"), S.Rolling("_loss", rsi_n, mean="_al")])
    f = I._rsi_out(f, "_rsi")
    f = f.withColumns({"sig0": flag(F.col("_sma_s") > F.col("_sma_l")),
                       "sig2": flag(F.col("_rsi") < rsi_threshold),
                       "sig3": flag(F.col("close") < F.col("_bb_mid"))})
    f = f.select(*columns, S.IDX, S.BLK, S.HALO, "ret", "sig0", "sig2", "sig3")
    f = I.macd_of(S.scan(f, list(keys), I.macd_specs(fast, slow), halo=0))
    f = I.add_signal_line(f, signal, keys=keys, signal_out="_macd_sig", halo=1)
    f = f.withColumn("sig1", flag(F.col("macd") > F.col("_macd_sig")))
    w = S.block_window(list(keys))
    f = f.withColumns({f"pos{k}": F.lag(F.col(f"sig{k}"), 1).over(w) for k in range(4)})
    return f.drop("macd", "_macd_sig")


def stack_strategies(f: DataFrame) -> DataFrame:
    """F16 step 2 / H1: one row per (ticker, strategy, bar) via ``stack``;
    growth columns ``_eq0``.. go along as ``_eq``."""
    extra = ["_eq"] if "_eq0" in f.columns else []
    parts = ", ".join(f"'{n}', {k}, sig{k}, pos{k}" + "".join(f", {c}{k}" for c in extra) for k, n in enumerate(STRATEGY_NAMES))
    wide = {f"{c}{k}" for k in range(len(STRATEGY_NAMES)) for c in ("sig", "pos", *extra)}
    keep = [c for c in f.columns if c not in wide]
    return f.select(*keep, F.expr(
        f"stack({len(STRATEGY_NAMES)}, {parts}) AS ({', '.join(['strategy', 'strategy_ord', 'signal', 'position', *extra])})"))
