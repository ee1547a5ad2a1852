"""Driver tables mapped onto the market data model (A10, A11, D9 ticks -> bars).

``lineitem`` is read as a tick stream: ticker = returnflag||linestatus, one
tick per line in (shipdate, orderkey, linenumber, partkey, suppkey, quantity,
extendedprice) order, price = an integer-cent walk whose step comes from the
discount.  ``events`` is read as the bronze tick table of the medallion
pipeline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwise.plans import series as S

# Fixed values of the price-walk fixture (must match the SQL oracle):
# start at 5000.00 (500000 cents); each tick moves by
# round(discount * 100) * 50 - 250 cents.
WALK_START_CENTS = 500000
WALK_STEP_PER_DISCOUNT_POINT = 50
WALK_STEP_OFFSET = 250

TICK_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ticks(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("ticker"),
        F.col("l_shipdate").alias("ship_ts"),
        F.col("l_shipdate").cast("date").alias("d"),
        *TICK_ORDER,
        (F.round(F.col("l_discount") * 100).cast("int") * WALK_STEP_PER_DISCOUNT_POINT
         - WALK_STEP_OFFSET).cast("long").alias("step"),
    )


#: Order keys of a tick chunk: an order has seven lines at most, so a chunk of
#: one (ticker, ship time) holds no more than seven times as many ticks.
CHUNK_KEYS = 1 << 16


def chunk_width(lineitem: DataFrame, target_rows: int = 1 << 16):
    """Orderkey width of a tick chunk so that a chunk holds about
    ``target_rows`` ticks of one (ticker, ship time) group, from the data (a
    scalar-subquery Column): for ticks whose keys repeat without a bound."""
    keyed = lineitem.select(F.concat("l_returnflag", "l_linestatus").alias("ticker"),
                            "l_shipdate", "l_orderkey")
    return S.adaptive_width(keyed, "l_orderkey", ["ticker", "l_shipdate"], target_rows)


def bars_from_lineitem(lineitem: DataFrame, chunk_keys=CHUNK_KEYS, positions: bool = False) -> DataFrame:
    """Daily OHLCV bars of the lineitem price walk (D9: ticks -> bars).

    The walk is a running sum over all ticks of a ticker, so the direct plan
    is one sort per ticker.  Instead ticks are cut into chunks of (ticker,
    ship time, orderkey range), contiguous in tick order, and levels are
    carried in two small scans:
      1. inside a chunk: running sum of steps; per chunk its total, highest
         and lowest running sum, first step and volume (one small sort each);
      2. per (ticker, day), over that day's chunks: each chunk's offset from
         the day's opening level, giving the day's open/high/low relative to
         it and the day's total move;
      3. per ticker, over the day table (bounded by the calendar, not by the
         tick count): each day's opening level = start + earlier days' moves.
    No task ever holds more than one chunk of ticks, one day of chunks, or
    one ticker's calendar of days.
    """
    width = F.lit(chunk_keys) if isinstance(chunk_keys, int) else chunk_keys
    unb = Window.unboundedPreceding
    t = _ticks(lineitem).withColumn("c", F.floor(F.col("l_orderkey") / width))
    chunk = ["ticker", "ship_ts", "c"]
    w = Window.partitionBy(*chunk).orderBy(*TICK_ORDER)
    local = (t.withColumn("run", F.sum("step").over(w.rowsBetween(unb, 0)))
             .withColumn("rn", F.row_number().over(w)))
    chunks = local.groupBy(*chunk, "d").agg(
        F.sum("step").alias("tot"),
        F.max("run").alias("hi_run"),
        F.min("run").alias("lo_run"),
        F.min_by("run", "rn").alias("first_run"),
        F.sum("l_quantity").alias("qty"),
    )
    in_day = Window.partitionBy("ticker", "d").orderBy("ship_ts", "c")
    off = F.coalesce(F.sum("tot").over(in_day.rowsBetween(unb, -1)), F.lit(0))
    # the chunk's number in its day keeps the first price in a hash aggregate
    days = chunks.withColumns({"off": off, "cn": F.row_number().over(in_day)}).groupBy("ticker", "d").agg(
        F.min_by(F.col("off") + F.col("first_run"), "cn").alias("o"),
        F.max(F.col("off") + F.col("hi_run")).alias("h"),
        F.min(F.col("off") + F.col("lo_run")).alias("l"),
        F.sum("tot").alias("move"),
        F.sum("qty").alias("vol"),
    )
    by_day = Window.partitionBy("ticker").orderBy("d")
    start = F.coalesce(F.sum("move").over(by_day.rowsBetween(unb, -1)), F.lit(0)) + F.lit(WALK_START_CENTS)
    at = {S.IDX: (F.row_number().over(by_day) - 1).cast("long")} if positions else {}
    cents = days.withColumns({"start": start, **at})
    return cents.select(
        "ticker", "d",
        ((F.col("start") + F.col("o")) / F.lit(100.0)).alias("open"),
        ((F.col("start") + F.col("h")) / F.lit(100.0)).alias("high"),
        ((F.col("start") + F.col("l")) / F.lit(100.0)).alias("low"),
        ((F.col("start") + F.col("move")) / F.lit(100.0)).alias("close"),
        F.col("vol").cast("long").alias("volume"),
        *at,
    )


def load_bars(spark: SparkSession, sf_dir: str, chunk_keys=CHUNK_KEYS, positions: bool = False) -> DataFrame:
    return bars_from_lineitem(table(spark, sf_dir, "lineitem"), chunk_keys, positions)


def ticks_from_events(events: DataFrame, keep: tuple = ()) -> DataFrame:
    """Bronze ticks from ``events``: ticker = event_type, price = value,
    timestamp = whole epoch seconds of ts (read as UTC), source = 'events';
    ``keep`` carries extra event columns along (e.g. event_id)."""
    secs = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
                  "CAST(ts AS TIMESTAMP_NTZ))")
    return events.select(
        *keep,
        F.col("event_type").alias("ticker"),
        F.col("value").cast("double").alias("price"),
        secs.cast("long").alias("timestamp"),
        F.lit("events").alias("source"),
    )


def load_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from_events(table(spark, sf_dir, "events"))
