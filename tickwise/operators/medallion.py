"""Bronze -> silver -> gold tick features.

The same functions serve batch and Structured Streaming where Spark allows
it (``windowed_features``, ``gold_features``); row-count frames
(``tick_features``) are batch only, as streaming rejects non-time windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.operators import indicators as I
from tickwise.operators.zones import drop_missing
from tickwise.plans import series as S


def with_event_time(ticks: DataFrame, seconds: str = "timestamp", out: str = "ts") -> DataFrame:
    """Epoch seconds -> TIMESTAMP event time (watermarks need TIMESTAMP)."""
    return ticks.withColumn(out, F.timestamp_seconds(F.col(seconds)))


def dedup_ticks(ticks: DataFrame, keys: Sequence[str] = ("ticker", "timestamp")) -> DataFrame:
    """D1 (batch): one tick per key.  The survivor is deterministic: the
    smallest (price, source).  A partial aggregate, so a hot key collapses
    map-side before the shuffle."""
    keys = list(keys)
    rest = [c for c in ticks.columns if c not in keys]
    best = F.min(F.struct(*[F.col(c) for c in rest])).alias("_best")
    return ticks.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest]) \
        .select(*ticks.columns)


#: Seconds of an indexing bucket: after ``dedup_ticks`` a ticker has one tick a
#: second at most, so a bucket holds no more rows than this.
BUCKET_SECONDS = 1 << 16


def tick_features(ticks: DataFrame, n: int = 5, bucket_seconds: int = BUCKET_SECONDS,
                  block_rows: int | None = None) -> DataFrame:
    """E1 (batch silver): per ticker, average and sample std of the price over
    the trailing n ticks (partial frames at the start, std NULL on one tick);
    window_start = window_end = the tick time.  The indexing buckets are
    ``bucket_seconds`` wide; for ticks that repeat a second often choose it by
    ``series.adaptive_width``."""
    t = ticks.select("ticker", "price", "timestamp")
    f = I.prepare(t, n, order=("timestamp",),
                  bucket=S.seconds_bucket("timestamp", bucket_seconds), block_rows=block_rows)
    frame = S.block_window(["ticker"]).rowsBetween(-(n - 1), 0)
    f = f.withColumns({"SMA": F.avg("price").over(frame), "volatility": F.stddev_samp("price").over(frame)})
    t = F.timestamp_seconds(F.col("timestamp"))
    return I.finish(f).select("ticker", "SMA", "volatility", t.alias("window_start"), t.alias("window_end"))


def windowed_features(ticks: DataFrame, size: str = "1 minute", slide: str = "30 seconds",
                      ts: str = "ts") -> DataFrame:
    """D3: sliding event-time windows per ticker: average and sample std of
    the price.  Works on batch and streaming frames."""
    if ts not in ticks.columns:
        ticks = with_event_time(ticks, out=ts)
    agg = ticks.groupBy("ticker", F.window(F.col(ts), size, slide)).agg(
        F.avg("price").alias("SMA"), F.stddev_samp("price").alias("volatility"))
    return agg.select("ticker", "SMA", "volatility",
                      F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"))


def gold_features(silver: DataFrame) -> DataFrame:
    """Per ticker, unweighted mean of the window SMAs and volatilities,
    over rows where both are present (NULL and NaN dropped, B2)."""
    clean = drop_missing(silver, ["SMA", "volatility"])
    return clean.groupBy("ticker").agg(F.avg("SMA").alias("avg_SMA"),
                                       F.avg("volatility").alias("avg_volatility"))


def volatility_band(silver: DataFrame) -> DataFrame:
    """SMA -/+ volatility per silver row (rows with both present)."""
    clean = drop_missing(silver, ["SMA", "volatility"])
    return clean.select("ticker", "window_start", "SMA", "volatility",
                        (F.col("SMA") - F.col("volatility")).alias("band_low"),
                        (F.col("SMA") + F.col("volatility")).alias("band_high"))
