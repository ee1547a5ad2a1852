"""Technical indicators over long bars.

Two layers:

* ``add_*`` functions take a *prepared* series frame (``prepare``: position
  index + blocks + halo) and add one indicator column using windows
  ``PARTITION BY key, _blk ORDER BY _i``.  Several of them over one frame
  share a single exchange and sort.  Those that reach back to the start of a
  series (EMA, MACD, Wilder, cumulative max and product, forward fill) are
  scans: each writes the frame once (``series.scan``), so put what belongs
  together into one.
* plain functions (``sma``, ``macd``, ``technical_panel`` ...) wrap
  prepare -> add -> ``finish`` for a bars DataFrame.

pandas semantics kept: ``rolling(n)`` is NULL until n values; the first
``diff`` is NULL but gain/loss turn it into 0.0; RSI is 100 when the average
loss is 0 and the gain positive, NULL when both are 0; ``ewm(adjust=False)``
starts at the first value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.functions.columns import ratio
from tickwise.plans import series as S

KEYS = ("ticker",)


def prepare(df: DataFrame, halo: int, keys: Sequence[str] = KEYS, order: Sequence = ("d",),
            bucket=None, block_rows: int | None = None) -> DataFrame:
    """Index and block a long series table so every frame of up to ``halo``
    preceding rows is complete inside one (key, block) partition."""
    keys = list(keys)
    if bucket is None:
        bucket = S.date_bucket(order[0]) if isinstance(order[0], str) else F.lit(0)
    indexed = S.index_series(df, keys, list(order), bucket)
    return S.with_blocks(indexed, halo, S.block_rows_for(halo, block_rows))


def finish(df: DataFrame, keep_index: bool = False) -> DataFrame:
    out = S.drop_halo(df)
    return out if keep_index else out.drop(S.IDX)


def _w(keys):
    return S.block_window(list(keys))


# ------------------------------------------------------------ row frames

def add_sma(df, n: int, x: str = "close", out: str | None = None, keys=KEYS) -> DataFrame:
    """Mean of the trailing n rows, NULL until n values."""
    return S.add_rolling(df, keys, [S.Rolling(x, n, mean=out or f"sma_{n}")])


def add_rolling_std(df, n: int, x: str = "close", out: str | None = None, keys=KEYS) -> DataFrame:
    """Sample std (ddof 1) of the trailing n rows, NULL until n values."""
    return S.add_rolling(df, keys, [S.Rolling(x, n, std=out or f"std_{n}")])


def add_shift(df, x: str, out: str | None = None, k: int = 1, keys=KEYS) -> DataFrame:
    """Value k rows back."""
    return df.withColumn(out or f"{x}_prev", F.lag(F.col(x), k).over(_w(keys)))


def add_diff(df, x: str = "close", out: str = "delta", keys=KEYS) -> DataFrame:
    """Row minus previous row (NULL on the first row)."""
    return df.withColumn(out, F.col(x) - F.lag(F.col(x), 1).over(_w(keys)))


def add_pct_change(df, x: str = "close", out: str = "ret", keys=KEYS) -> DataFrame:
    """Row / previous - 1 (NULL on the first row or a zero previous).  A
    missing value counts as the last one before it (``fill_missing`` pads
    series with gaps first)."""
    return df.withColumn(out, ratio(F.col(x), F.lag(F.col(x), 1).over(_w(keys))) - F.lit(1.0))


def fill_missing(df, x: str = "close", keys=KEYS) -> DataFrame:
    """Each missing value becomes the last one before it in its series,
    however far back and across blocks; leading ones stay missing."""
    columns = df.columns
    filled = S.ffill_scan(df, list(keys), x, "_padded")
    return filled.select(*[F.col("_padded").alias(x) if c == x else F.col(c) for c in columns])


def add_cumprod(df, x: str, out: str, keys=KEYS) -> DataFrame:
    """Cumulative product, NULLs skipped and left NULL."""
    return S.carry_scan(df, list(keys), x, out, "product")


def add_cummax(df, x: str = "close", out: str = "ath", keys=KEYS) -> DataFrame:
    """Cumulative maximum."""
    return S.carry_scan(df, list(keys), x, out, "max")


def add_ema(df, span: float | None = None, x: str = "close", out: str | None = None,
            min_periods: int = 0, alpha: float | None = None, keys=KEYS) -> DataFrame:
    """``ewm(span|alpha, adjust=False, min_periods)``."""
    if alpha is None:
        alpha = 2.0 / (span + 1.0)
    return S.add_ema(df, list(keys), x, out or f"ema_{int(span) if span else alpha}", alpha, min_periods)


# ------------------------------------------------------------ composites

def add_bollinger(df, n: int = 20, k: float = 2.0, x: str = "close", keys=KEYS) -> DataFrame:
    """middle = SMA_n, upper/lower = middle +- k * std_n."""
    df = S.add_rolling(df, keys, [S.Rolling(x, n, mean="bb_middle", std="_sd")])
    mid, sd = F.col("bb_middle"), F.col("_sd")
    return df.withColumns({"bb_upper": mid + sd * k, "bb_lower": mid - sd * k}).drop("_sd")


def _gain_loss(df, x, keys, ret: str | None = None):
    """Gain / loss of each bar (the first bar's missing diff becomes 0.0), and
    its return if asked for."""
    before = f"LAG(`{x}`) {S._Over(keys, S.BLK).row}"
    df = S.with_sql(df, {"_before": before})
    more = {ret: f"try_divide(`{x}`, _before) - 1D"} if ret else {}
    return S.with_sql(df, {"_gain": f"CASE WHEN `{x}` > _before THEN `{x}` - _before ELSE 0D END",
                           "_loss": f"CASE WHEN `{x}` < _before THEN _before - `{x}` ELSE 0D END", **more}).drop("_before")


def rsi_from(avg_gain: str, avg_loss: str):
    """100 - 100/(1 + gain/loss); 100 when loss is 0 and gain > 0; NULL when
    both are 0 or either is NULL."""
    g, l = F.col(avg_gain), F.col(avg_loss)
    return (F.when(l == 0, F.when(g > 0, F.lit(100.0)))
             .otherwise(F.lit(100.0) - ratio(F.lit(100.0), F.lit(1.0) + ratio(g, l))))


def add_rsi_sma(df, n: int = 14, x: str = "close", out: str = "rsi", keys=KEYS) -> DataFrame:
    """RSI from n-row simple means of gain and loss."""
    df = _gain_loss(df, x, keys)
    df = S.add_rolling(df, keys, [S.Rolling("_gain", n, mean="_ag"), S.Rolling("_loss", n, mean="_al")])
    return _rsi_out(df, out)


def _rsi_out(df, out):
    keep = [c for c in df.columns if c not in ("_gain", "_loss", "_ag", "_al", out)]
    return df.select(*keep, rsi_from("_ag", "_al").alias(out))


def add_rsi_wilder(df, n: int = 14, x: str = "close", out: str = "rsi", keys=KEYS) -> DataFrame:
    """RSI with Wilder smoothing (alpha 1/n, min_periods n)."""
    df = _gain_loss(df, x, keys)
    df = S.add_emas(df, list(keys), [("_gain", "_ag", 1.0 / n, n), ("_loss", "_al", 1.0 / n, n)])
    return _rsi_out(df, out)


def add_macd(df, fast: int = 12, slow: int = 26, signal: int = 9, x: str = "close",
             strict: bool = False, keys=KEYS, signal_out: str = "signal_line") -> DataFrame:
    """F4 (strict=False): EMA_fast - EMA_slow and its EMA_signal, valid from
    the first row.  F5 (strict=True): each EMA with min_periods = span, plus
    the histogram ``macd_hist``."""
    df = S.scan(df, list(keys), macd_specs(fast, slow, x, strict))
    return add_signal_line(macd_of(df), signal, strict, keys, signal_out)


def macd_specs(fast: int, slow: int, x: str = "close", strict: bool = False) -> list[S.Ema]:
    """The two averages of a MACD, as gaps ``_fast`` and ``_slow``."""
    return [S.Ema(x, None, 2.0 / (n + 1), n if strict else 0, gap) for n, gap in ((fast, "_fast"), (slow, "_slow"))]


def macd_of(df: DataFrame) -> DataFrame:
    """EMA_fast - EMA_slow is the gap of the slow one less that of the fast:
    exactly 0 while the series hasn't moved, whatever its level."""
    keep = [c for c in df.columns if c not in ("_fast", "_slow", "macd")]
    return df.select(*keep, (F.col("_slow") - F.col("_fast")).alias("macd"))


def add_signal_line(df: DataFrame, signal: int = 9, strict: bool = False, keys=KEYS, signal_out: str = "signal_line",
                    halo: int | None = None) -> DataFrame:
    """EMA_signal of ``macd``; strict: with min_periods, and ``macd_hist``."""
    hist = "macd_hist" if strict else None
    return S.scan(df, list(keys), [S.Ema("macd", signal_out, 2.0 / (signal + 1), signal if strict else 0, hist)], halo)


def add_crosses(df, short: str = "sma_50", long: str = "sma_200", keys=KEYS) -> DataFrame:
    """golden cross = short > long now and short < long on the prior
    bar; death cross the reverse.  Equality on either bar is no event."""
    w = _w(keys)
    s, l = F.col(short), F.col(long)
    ps, pl = F.lag(s, 1).over(w), F.lag(l, 1).over(w)
    return df.withColumns({"golden_cross": F.coalesce((s > l) & (ps < pl), F.lit(False)),
                           "death_cross": F.coalesce((s < l) & (ps > pl), F.lit(False))})


def add_drawdown(df, x: str = "close", keys=KEYS) -> DataFrame:
    """F8: all-time high (cummax) and close / ATH - 1."""
    df = add_cummax(df, x, "ath", keys)
    return df.withColumn("drawdown_pct", ratio(F.col(x), F.col("ath")) - F.lit(1.0))


def add_extension(df, n: int = 200, x: str = "close", sma_col: str | None = None, keys=KEYS) -> DataFrame:
    """(close - SMA_n) / SMA_n."""
    sma_col = sma_col or f"sma_{n}"
    if sma_col not in df.columns:
        df = add_sma(df, n, x, sma_col, keys)
    return df.withColumn("extension_pct", ratio(F.col(x) - F.col(sma_col), F.col(sma_col)))


# ------------------------------------------------------------ wrappers

EMA_HALO = S.ema_halo


def _run(bars, halo, fn, keys=KEYS, block_rows=None):
    return finish(fn(prepare(bars, halo, keys, block_rows=block_rows)))


def sma(bars, n: int, x: str = "close", block_rows=None) -> DataFrame:
    return _run(bars, n, lambda f: add_sma(f, n, x), block_rows=block_rows)


def rolling_std(bars, n: int, x: str = "close", block_rows=None) -> DataFrame:
    return _run(bars, n, lambda f: add_rolling_std(f, n, x), block_rows=block_rows)


def ema(bars, span: float, x: str = "close", min_periods: int = 0, block_rows=None) -> DataFrame:
    return _run(bars, 0, lambda f: add_ema(f, span, x, None, min_periods), block_rows=block_rows)


def wilder(bars, n: int = 14, x: str = "close", block_rows=None) -> DataFrame:
    return _run(bars, 0, lambda f: add_ema(f, x=x, out=f"wilder_{n}", alpha=1.0 / n, min_periods=n),
                block_rows=block_rows)


def bollinger(bars, n: int = 20, k: float = 2.0, block_rows=None) -> DataFrame:
    return _run(bars, n, lambda f: add_bollinger(f, n, k), block_rows=block_rows)


def rsi_sma(bars, n: int = 14, block_rows=None) -> DataFrame:
    return _run(bars, n + 1, lambda f: add_rsi_sma(f, n), block_rows=block_rows)


def rsi_wilder(bars, n: int = 14, block_rows=None) -> DataFrame:
    return _run(bars, 1, lambda f: add_rsi_wilder(f, n), block_rows=block_rows)


def macd_halo(fast=12, slow=26, signal=9, extra_window: int = 0) -> int:
    """Rows before a block that a MACD looks at: none but those of other frames."""
    return extra_window


def macd(bars, fast=12, slow=26, signal=9, strict=False, block_rows=None) -> DataFrame:
    return _run(bars, 0, lambda f: add_macd(f, fast, slow, signal, strict=strict), block_rows=block_rows)


def crosses(bars, short: int = 50, long: int = 200, block_rows=None) -> DataFrame:
    def fn(f):
        f = S.add_rolling(f, KEYS, [S.Rolling("close", n, mean=f"sma_{n}") for n in (short, long)])
        return add_crosses(f, f"sma_{short}", f"sma_{long}")
    return _run(bars, long + 1, fn, block_rows=block_rows)


def drawdown(bars, block_rows=None) -> DataFrame:
    return _run(bars, 0, add_drawdown, block_rows=block_rows)


def extension(bars, n: int = 200, block_rows=None) -> DataFrame:
    return _run(bars, n, lambda f: add_extension(f, n), block_rows=block_rows)


def panel_halo() -> int:
    """200 rows of the long average, one more for the bar before."""
    return 201


def add_technical_panel(f: DataFrame, keys=KEYS) -> DataFrame:
    """every indicator of the signal dashboard: one frame for all that
    looks back a fixed number of rows, one scan for the averages and the high,
    one for the MACD's signal line."""
    f = S.add_rolling(_gain_loss(f, "close", keys), keys, [
        S.Rolling("close", 50, mean="sma_50"), S.Rolling("close", 200, mean="sma_200"),
        S.Rolling("_gain", 14, mean="_ag"), S.Rolling("_loss", 14, mean="_al")])
    f = add_crosses(_rsi_out(f, "rsi"), "sma_50", "sma_200", keys=keys)
    f = S.scan(f, list(keys), [S.Ema("close", "ema_200", 2 / 201), *macd_specs(12, 26), S.Run("max", "close", "ath")], halo=0)
    f = add_signal_line(macd_of(f), 9, keys=keys)
    f = f.withColumn("drawdown_pct", ratio(F.col("close"), F.col("ath")) - F.lit(1.0))
    return add_extension(f, 200, sma_col="sma_200", keys=keys)


def technical_panel(bars, block_rows=None) -> DataFrame:
    return _run(bars, panel_halo(), add_technical_panel, block_rows=block_rows)


def chart_halo() -> int:
    return 20


def add_chart_indicators(f: DataFrame, keys=KEYS) -> DataFrame:
    """The single-ticker chart set: SMA/EMA 20, Bollinger 20x2, Wilder RSI 14,
    strict MACD 12/26/9 with histogram."""
    f = _gain_loss(add_bollinger(f, 20, 2.0, keys=keys).withColumnRenamed("bb_middle", "sma_20"), "close", keys)
    f = S.scan(f, list(keys), [S.Ema("close", "ema_20", 2 / 21), *macd_specs(12, 26, strict=True),
                               S.Ema("_gain", "_ag", 1 / 14, 14), S.Ema("_loss", "_al", 1 / 14, 14)], halo=0)
    return add_signal_line(macd_of(_rsi_out(f, "rsi")), 9, True, keys, "macd_signal")


def chart_indicators(bars, block_rows=None) -> DataFrame:
    return _run(bars, chart_halo(), add_chart_indicators, block_rows=block_rows)
