"""Zones, flags and row predicates.

Chart masks of the dashboards become boolean / label columns or filters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rsi_zones(df: DataFrame, low: float = 30.0, high: float = 70.0, rsi: str = "rsi") -> DataFrame:
    """Oversold (RSI < low) and overbought (RSI > high) flags."""
    r = F.col(rsi)
    return df.withColumns({"oversold": F.coalesce(r < low, F.lit(False)),
                           "overbought": F.coalesce(r > high, F.lit(False))})


def macd_regime(df: DataFrame, macd: str = "macd", signal: str = "signal_line") -> DataFrame:
    """B7: 'bullish' when MACD > signal, 'bearish' when below, else NULL."""
    m, s = F.col(macd), F.col(signal)
    return df.withColumn("regime", F.when(m > s, "bullish").when(m < s, "bearish"))


def drawdown_zone(df: DataFrame, threshold: float = -0.15, col: str = "drawdown_pct") -> DataFrame:
    """Discount zone, drawdown below the threshold."""
    return df.withColumn("discount", F.coalesce(F.col(col) < threshold, F.lit(False)))


def extension_zone(df: DataFrame, threshold: float = 0.30, col: str = "extension_pct") -> DataFrame:
    """Euphoria zone, extension above the threshold."""
    return df.withColumn("euphoria", F.coalesce(F.col(col) > threshold, F.lit(False)))


def signal_events(df: DataFrame, mode: str = "Entry", level: str = "sma_200",
                  short: str = "sma_50") -> DataFrame:
    """Only the rows where a cross fires.  'Entry' = golden crosses,
    'Exit' = death crosses, 'Both' = the two tagged sets in one pass."""
    kinds = {"Entry": ["entry"], "Exit": ["exit"], "Both": ["entry", "exit"]}
    if mode not in kinds:
        raise ValueError(f"mode must be Entry, Exit or Both, not {mode!r}")
    flags = {"entry": F.col("golden_cross"), "exit": F.col("death_cross")}
    events = F.filter(F.array(*[F.when(flags[k], F.lit(k)) for k in kinds[mode]]), lambda e: e.isNotNull())
    return df.select("ticker", "d", F.explode(events).alias("event"), short, level)


def trading_days(df: DataFrame, d: str = "d") -> DataFrame:
    """Drop Saturday and Sunday bars (dayofweek 1 = Sunday, 7 = Saturday)."""
    return df.filter(F.dayofweek(F.col(d)).between(2, 6))


def bar_direction(df: DataFrame) -> DataFrame:
    """B12: 'up' when open - close <= 0, else 'down'."""
    return df.withColumn("direction", F.when(F.col("open") - F.col("close") <= 0, "up").otherwise("down"))


def hist_sign(df: DataFrame, col: str = "macd_hist") -> DataFrame:
    """B13: 'neg' when the histogram is < 0, else 'pos' (missing -> 'pos')."""
    return df.withColumn("hist_sign", F.when(F.col(col) < 0, "neg").otherwise("pos"))


def min_history(df: DataFrame, n: int = 2, key: str = "ticker") -> DataFrame:
    """Keep series with at least ``n`` rows.  Counted by a partial
    aggregate and applied with a semi join (no whole-series window)."""
    enough = df.groupBy(key).count().filter(F.col("count") >= n).select(key)
    return df.join(enough, key, "left_semi")



def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """B2: drop rows with NULL or NaN in ``subset``.  The explicit
    ``isNotNull`` reaches the Parquet scan as a pushed filter; ``na.drop``
    also removes NaN."""
    cond = None
    for c in subset:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond).na.drop(subset=list(subset))


def filter_tickers(df: DataFrame, tickers: Sequence[str] | DataFrame, key: str = "ticker") -> DataFrame:
    """Keep requested symbols (a list -> ``isin``, a table -> semi join)."""
    if isinstance(tickers, DataFrame):
        return df.join(tickers.select(F.col(tickers.columns[0]).alias(key)), key, "left_semi")
    return df.filter(F.col(key).isin(list(tickers)))


def tickers(df: DataFrame, key: str = "ticker") -> DataFrame:
    """Distinct symbols."""
    return df.select(key).distinct()


#: Months of the lookback codes.
LOOKBACKS = {"1mo": 1, "3mo": 3, "6mo": 6, "1y": 12, "2y": 24, "5y": 60, "10y": 120}


def lookback(df: DataFrame, period: str, d: str = "d", anchor=None, key: str | None = None) -> DataFrame:
    """Rows within the last 1mo/3mo/6mo/1y/2y/5y (or 'max') before the
    anchor date.  The anchor is the table's last date (a one-row aggregate
    scalar subquery) or a given date; per-series anchors with ``key``."""
    if period == "max":
        return df
    if period not in LOOKBACKS:
        raise ValueError(f"unknown period {period!r}")
    k = LOOKBACKS[period]
    if anchor is not None:
        return df.filter(F.col(d) >= F.add_months(F.lit(anchor).cast("date"), -k))
    if key:
        last = df.groupBy(key).agg(F.max(d).alias("_anchor"))
        return (df.join(last, key).filter(F.col(d) >= F.add_months(F.col("_anchor"), -k))
                .drop("_anchor"))
    last = df.select(F.max(d)).scalar()  # scalar subquery, planned once
    return df.filter(F.col(d) >= F.add_months(last, -k))
