"""Structured Streaming medallion: bronze -> silver -> gold.

* bronze: Kafka-style frames (any ``value`` BINARY source) decoded and
  appended to Parquet with a checkpoint (A1-A3); frames that don't parse go to
  a quarantine table of their own;
* silver: event-time watermark *first*, then de-duplication as an aggregate
  per tick time (the same survivor as in batch, whatever the arrival order;
  its state expires with the watermark), then sliding windows in append mode: a window
  is written once the watermark passes its end; rows later than the
  watermark are dropped (J1-J4) and counted (``SilverCounts``);
* gold: its own query over the silver table: a stateful per-ticker
  aggregate in update mode; each trigger's changed tickers are merged into a
  new version of the gold table, and readers see whole versions (J6, J7).

Each query has its own checkpoint and output path (J5).  ``run_available``
drives a query with ``availableNow`` (process what is there, then stop);
``Medallion`` runs the three at the same time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.operators.medallion import gold_features, windowed_features, with_event_time
from tickwise.sources import lake
from tickwise.sources.kafka import decode_ticks, quarantine

DEFAULT_LATENESS = "2 minutes"


def bronze_stream(frames: DataFrame) -> DataFrame:
    """A2 on a streaming frame source: decoded ticks."""
    return decode_ticks(frames)


def quarantine_stream(frames: DataFrame) -> DataFrame:
    """The raw text of the frames that are no ticks."""
    return quarantine(decode_ticks(frames, keep_raw=True)).select("_raw")


def silver_stream(bronze: DataFrame, size: str = "1 minute", slide: str = "30 seconds",
                  lateness: str = DEFAULT_LATENESS, counted: bool = False) -> DataFrame:
    """J1-J4 + D3: watermark, dedup inside the watermark, windowed features.

    ``counted`` accounts for every row (``SilverCounts``): rows without ticker
    or time are left out by a filter that counts them, and a de-duplication of
    equal rows comes first, whose operator counts late and repeated rows one
    by one (the aggregates see rows that are already combined).  It keeps the
    same times in its state as the aggregate after it."""
    ticks = bronze
    if counted:
        bad = F.col("ticker").isNull() | F.col("timestamp").isNull()
        ticks = ticks.observe("bronze", F.count(F.lit(1)).alias("rows"), F.count(F.when(bad, 1)).alias("malformed")).filter(~bad)
    ts = with_event_time(ticks).withWatermark("ts", lateness)
    if counted:
        ts = ts.dropDuplicates(["ticker", "ts", "price", "source"])
    # the tick's own time is the key: it carries the watermark to the windows, whatever their slide
    best = ts.groupBy("ticker", "timestamp", "ts").agg(F.min(F.struct("price", "source")).alias("best"))
    deduped = best.select("ticker", "timestamp", "best.price", "best.source", "ts")
    return windowed_features(deduped, size, slide, ts="ts")


@dataclass(frozen=True)
class SilverCounts:
    """What became of the rows that a counted silver query has read so far:
    ``rows = malformed + late + repeated + kept``."""
    rows: int
    malformed: int
    late: int
    repeated: int

    @property
    def kept(self) -> int:
        return self.rows - self.malformed - self.late - self.repeated

    @classmethod
    def of(cls, progress: list) -> "SilverCounts":
        """From the query's progress reports (``query.recentProgress``)."""
        seen = {p["batchId"]: p for p in progress if p["observedMetrics"].get("bronze") is not None}
        metrics = [p["observedMetrics"]["bronze"] for p in seen.values()]
        first = [o for p in seen.values() for o in p["stateOperators"] if o["operatorName"] == "dedupe"]
        return cls(rows=sum(m["rows"] for m in metrics), malformed=sum(m["malformed"] for m in metrics),
                   late=sum(o["numRowsDroppedByWatermark"] for o in first),
                   repeated=sum(o["customMetrics"]["numDroppedDuplicateRows"] for o in first))


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a streaming query to the end of the available input."""
    q = lake.write_stream(df, path, checkpoint, mode=mode, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def gold_query(spark: SparkSession, silver_path: str, gold_path: str, checkpoint: str,
               available_now: bool = True, processing_time: str = "10 seconds"):
    """Gold as its own stream over the silver table, started.

    The per-ticker means are a streaming aggregate: Spark keeps each ticker's
    running sums and counts in the checkpointed state store, so a trigger
    costs in proportion to the new silver rows, not the whole table, and the
    result equals a full recompute (silver windows are final once appended).
    ``update`` output hands on the tickers that changed; they are merged into
    the version before, and the trigger's number names the new version, so a
    replayed trigger writes the same version again."""
    source = lake.read_silver(spark, silver_path, stream=True)
    table = lake.VersionedTable(spark, gold_path)

    def publish(batch: DataFrame, epoch: int) -> None:
        table.upsert(batch, epoch, "ticker")

    w = (gold_features(source).writeStream.outputMode("update").foreachBatch(publish)
         .option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start()


def run_gold(spark: SparkSession, silver_path: str, gold_path: str, checkpoint: str,
             available_now: bool = True, processing_time: str = "10 seconds"):
    """Gold over what is there (``available_now``), or on an interval."""
    q = gold_query(spark, silver_path, gold_path, checkpoint, available_now, processing_time)
    if available_now:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return q


class Medallion:
    """The three stages (and the quarantine) as live queries at the same
    time, chained through their tables under ``root``."""

    def __init__(self, frames: DataFrame, root: str, size: str = "1 minute", slide: str = "30 seconds",
                 lateness: str = DEFAULT_LATENESS, interval: str = "10 seconds", counted: bool = True):
        self.spark, self.root = frames.sparkSession, root.rstrip("/")
        fs = lake.VersionedTable(self.spark, self.root).fs
        for name in ("bronze", "silver"):  # a stream's source folder must be there before the stream
            fs.mkdirs(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}"))
        put = lambda df, name: lake.write_stream(df, f"{self.root}/{name}", f"{self.root}/ck-{name}", processing_time=interval)
        self.queries = {
            "quarantine": put(quarantine_stream(frames), "quarantine"),
            "bronze": put(bronze_stream(frames), "bronze"),
            "silver": put(silver_stream(lake.read_bronze(self.spark, f"{self.root}/bronze", stream=True), size, slide, lateness, counted), "silver"),
            "gold": gold_query(self.spark, f"{self.root}/silver", f"{self.root}/gold", f"{self.root}/ck-gold", False, interval)}

    def drain(self) -> None:
        """Wait until each stage has worked off what the one before has written."""
        for q in self.queries.values():
            q.processAllAvailable()

    def stop(self) -> None:
        """Stop all stages; raises what ended one of them."""
        for q in self.queries.values():
            q.stop()
        for q in self.queries.values():
            if q.exception() is not None:
                raise q.exception()

    def counts(self) -> SilverCounts:
        return SilverCounts.of(self.queries["silver"].recentProgress)

    def gold(self) -> DataFrame | None:
        """The newest whole gold table."""
        return lake.read_gold(self.spark, f"{self.root}/gold")
