"""Declared schemas at every table boundary."""

from pyspark.sql import types as T

# Bronze tick: one price observation, epoch-second timestamp.
TICK = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("source", T.StringType()),
])
TICK_DDL = "ticker STRING, price DOUBLE, timestamp LONG, source STRING"

# Kafka-style record: UTF-8 JSON bytes of a tick.
KAFKA_RECORD = T.StructType([T.StructField("value", T.BinaryType())])

# Silver: features per ticker and window (batch rows use start == end).
SILVER = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("SMA", T.DoubleType()),
    T.StructField("volatility", T.DoubleType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
])

GOLD = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("avg_SMA", T.DoubleType()),
    T.StructField("avg_volatility", T.DoubleType()),
])

# Long OHLCV bars: one row per ticker and bar date.
BARS = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("d", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

COMPANY_INFO = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("longName", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("industry", T.StringType()),
])
