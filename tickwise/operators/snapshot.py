"""Per-ticker snapshots.

Latest values come from ``max_by`` partial aggregates; "last k rows" uses
``row_number() <= k``, which Spark plans as a WindowGroupLimit (top-k
applied before the shuffle), never a whole-series sort in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.functions.columns import int_text, pct_text, ratio


def latest(df: DataFrame, key: str = "ticker", order: str = "d") -> DataFrame:
    """The last row of every series (all columns).  One ``max_by`` per
    column: numbers and dates then stay in a hash aggregate."""
    rest = [c for c in df.columns if c not in (key, order)]
    last = [F.max_by(c, order).alias(c) for c in rest]
    return df.groupBy(key).agg(F.max(order).alias(order), *last).select(*df.columns)


def last_k(df: DataFrame, k: int, key: str = "ticker", order: str = "d") -> DataFrame:
    """E12 (k=2) / G2 (k=10): the last k rows of every series, with
    ``pos`` = 1 for the latest."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= k)


def price_delta(bars: DataFrame, x: str = "close") -> DataFrame:
    """F19 + B15: latest and previous close per ticker, change and change %
    (only tickers with at least two bars)."""
    two = last_k(bars.select("ticker", "d", x), 2)
    agg = two.groupBy("ticker").agg(
        F.max_by(x, "d").alias("current"), F.min_by(x, "d").alias("previous"),
        F.max("d").alias("d"), F.count(F.lit(1)).alias("_n"))
    delta = F.col("current") - F.col("previous")
    return agg.filter(F.col("_n") == 2).select(
        "ticker", "d", "current", "previous", delta.alias("delta"),
        (ratio(delta, F.col("previous")) * 100).alias("delta_pct"))


def quote(bars: DataFrame) -> DataFrame:
    """latest bar as a quote: price (2 dp), change vs the bar's open as
    text '%.2f%%', volume as integer."""
    last = latest(bars.select("ticker", "d", "open", "close", "volume"))
    change = ratio(F.col("close") - F.col("open"), F.col("open")) * 100
    return last.select(
        F.upper("ticker").alias("ticker"), "d",
        F.round("close", 2).alias("price"),
        pct_text(change).alias("change_percent"),
        F.col("volume").cast("long").alias("volume"),
        int_text("volume").alias("volume_text"),
    )


def preview(df: DataFrame, n: int = 1000, order: Sequence[str] = ("ticker", "window_start")) -> DataFrame:
    """A bounded, ordered preview (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def return_stats(frame: DataFrame, keys: Sequence[str] = ("ticker", "strategy"),
                 x: str = "strategy_return") -> DataFrame:
    """Mean and sample std of returns per group (partial aggregates)."""
    return frame.groupBy(*keys).agg(F.avg(x).alias("mean_return"), F.stddev_samp(x).alias("std_return"),
                                    F.count(x).alias("n_returns"))
