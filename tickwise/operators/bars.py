"""Bar resampling (D9) and bar-level helpers.

Coarser bars are always built from daily bars (weekly-then-monthly would
differ from daily-then-monthly): open = first open, high = max, low = min,
close = last close, volume = sum, labelled by the period start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNITS = {"1d": "day", "1wk": "week", "1mo": "month"}


def resample(bars: DataFrame, interval: str = "1wk") -> DataFrame:
    """(ticker, period) aggregate with partial aggregation; the period
    label is ``date_trunc`` of the bar date (weeks start on Monday)."""
    unit = UNITS.get(interval, interval)
    period = F.date_trunc(unit, F.col("d").cast("timestamp")).cast("date")
    return bars.groupBy("ticker", period.alias("d")).agg(
        F.min_by("open", "d").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "d").alias("close"),
        F.sum("volume").cast("long").alias("volume"),
    )
