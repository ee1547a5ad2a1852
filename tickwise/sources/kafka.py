"""Tick records as Kafka-style frames.

``decode_ticks`` / ``encode_ticks`` work on any DataFrame with a ``value``
BINARY column, so they run on Kafka frames and on files alike.  The Kafka
connector itself is a separate package; ``read_ticks_kafka`` /
``write_ticks_kafka`` need it on the classpath (not bundled here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.schemas import TICK


def read_ticks_kafka(spark: SparkSession, servers: str, topic: str,
                     starting_offsets: str = "earliest", stream: bool = True) -> DataFrame:
    """A1: subscribe to a topic (streaming by default); returns Kafka frames."""
    reader = spark.readStream if stream else spark.read
    return (reader.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .load())


def decode_ticks(frames: DataFrame, schema=TICK, keep_raw: bool = False) -> DataFrame:
    """Binary -> UTF-8 string -> ``from_json`` -> flat tick columns.
    Malformed JSON gives an all-NULL row (PERMISSIVE); a field of the wrong
    type is NULL alone.  ``keep_raw`` keeps the text for quarantine."""
    text = F.col("value").cast("string")
    parsed = frames.select(text.alias("_raw"), F.from_json(text, schema).alias("data"))
    cols = [F.col(f"data.{f.name}").alias(f.name) for f in schema.fields]
    return parsed.select(*cols, *([F.col("_raw")] if keep_raw else []))


def quarantine(decoded: DataFrame) -> DataFrame:
    """Rows that are no ticks: JSON that did not parse, or without ticker or
    time (needs ``keep_raw=True``)."""
    return decoded.filter(F.col("ticker").isNull() | F.col("timestamp").isNull())


def tick_json():
    """The JSON text of a tick row (Column)."""
    return F.to_json(F.struct(*[F.col(f.name) for f in TICK.fields]))


def encode_ticks(ticks: DataFrame, key: str | None = "ticker") -> DataFrame:
    """Tick -> JSON bytes in ``value`` (and the ticker as ``key``)."""
    value = tick_json().cast("binary")
    cols = [value.alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("binary").alias("key"))
    return ticks.select(*cols)


def write_ticks_kafka(frames: DataFrame, servers: str, topic: str) -> None:
    """A9 sink (batch): publish encoded frames to a topic."""
    (frames.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())
