"""Bronze / silver / gold tables on Parquet.

Each table has its own path and each stream its own checkpoint, so batch and
streaming writers never mix schemas in one folder and readers need no glob
around ``_spark_metadata``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.schemas import BARS, GOLD, SILVER, TICK


def read_bronze(spark: SparkSession, path: str, stream: bool = False,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A4 (stream) / A5 (batch): Parquet ticks with the declared schema."""
    if stream:
        r = spark.readStream.schema(TICK)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.parquet(path)
    return spark.read.schema(TICK).parquet(path)


def read_silver(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Silver table with its declared schema."""
    return (spark.readStream if stream else spark.read).schema(SILVER).parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None) -> None:
    """Batch Parquet write (optionally partitioned for pruning)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_stream(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                 fmt: str = "parquet", available_now: bool = False, processing_time: str | None = None):
    """Append file sink with its own checkpoint (exactly-once
    through the sink log).  Returns the started query."""
    w = (df.writeStream.format(fmt).outputMode(mode)
         .option("path", path).option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def load_bars_range(bars: DataFrame, tickers: Sequence[str] | DataFrame | None = None,
                    start: str | None = None, end: str | None = None) -> DataFrame:
    """A10: bars of a ticker set in [start, end); unknown tickers simply
    return no rows (see ``missing_tickers``).  Over a ``BarStore`` use its
    ``load_range``, which also prunes folders."""
    from tickwise.operators.zones import filter_tickers
    out = bars if tickers is None else filter_tickers(bars, tickers)
    if start:
        out = out.filter(F.col("d") >= F.lit(start).cast("date"))
    if end:
        out = out.filter(F.col("d") < F.lit(end).cast("date"))
    return out


def load_bars_period(bars: DataFrame, ticker: str | None = None, period: str = "1y",
                     interval: str = "1d") -> DataFrame:
    """Bars by lookback (1mo..max, B5) and bar size (1d/1wk/1mo, D9)."""
    from tickwise.operators.bars import resample
    from tickwise.operators.zones import lookback
    out = bars if ticker is None else bars.filter(F.col("ticker") == ticker)
    out = lookback(out, period)
    return out if interval == "1d" else resample(out, interval)


# ---------------------------------------------------------------- stored bars

@dataclass(frozen=True)
class BarStore:
    """Daily bars in folders by month (``yyyymm``) and ticker bucket, rows by
    ticker and date inside a file.  A date range, a lookback and a ticker set
    (names, or a table of names) reach the scan as partition filters; inside
    the folders that are left, ``d`` and ``ticker`` are pushed filters on
    sorted files."""
    path: str
    buckets: int = 16

    def bucket(self, ticker: Column) -> Column:
        return F.pmod(F.xxhash64(ticker), F.lit(self.buckets)).cast("int")

    @staticmethod
    def month(d: Column) -> Column:
        return (F.year(d) * 100 + F.month(d)).cast("int")

    def write(self, bars: DataFrame, mode: str = "overwrite") -> "BarStore":
        """One task a folder: a ticker with a third of all rows is spread over
        its months."""
        parts = bars.select(*BARS.names).withColumns({"month": self.month(F.col("d")), "bucket": self.bucket(F.col("ticker"))})
        (parts.repartition("month", "bucket").sortWithinPartitions("month", "bucket", "ticker", "d")
         .write.mode(mode).partitionBy("month", "bucket").parquet(self.path))
        return self

    def read(self, spark: SparkSession) -> DataFrame:
        """All bars, with their ``month`` and ``bucket``."""
        schema = T.StructType(BARS.fields + [T.StructField("month", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
        return spark.read.schema(schema).parquet(self.path)

    def since(self, bars: DataFrame, start: Column) -> DataFrame:
        return bars.filter((F.col("month") >= self.month(start)) & (F.col("d") >= start))

    def of_tickers(self, bars: DataFrame, tickers: Sequence[str] | DataFrame) -> DataFrame:
        """The requested symbols.  Names become a list of buckets.  A table
        is joined on (bucket, ticker); empty names are left out first, which
        also tells the planner that the table prunes: the buckets of the
        requested names are found at run time, before the scan lists folders."""
        if not isinstance(tickers, DataFrame):
            names = list(dict.fromkeys(tickers))
            return bars.filter(F.col("ticker").isin(names) & F.col("bucket").isin([self.bucket(F.lit(t)) for t in names]))
        name = F.col(tickers.columns[0])
        asked = tickers.filter(name > "").select(self.bucket(name).alias("bucket"), name.alias("ticker")).distinct()
        return bars.join(asked, ["bucket", "ticker"], "left_semi")

    def load_range(self, spark: SparkSession, tickers: Sequence[str] | DataFrame | None = None,
                   start: str | None = None, end: str | None = None) -> DataFrame:
        """A10 over the stored table: bars of a ticker set in [start, end)."""
        out = self.read(spark)
        if start:
            out = self.since(out, F.lit(start).cast("date"))
        if end:
            before = F.lit(end).cast("date")
            out = out.filter((F.col("month") <= self.month(F.date_sub(before, 1))) & (F.col("d") < before))
        if tickers is not None:
            out = self.of_tickers(out, tickers)
        return out.select(*BARS.names)

    def load_period(self, spark: SparkSession, ticker: str | None = None, period: str = "1y", interval: str = "1d") -> DataFrame:
        """A11 / B5 over the stored table.  The last date is a scalar subquery
        that the partition filter waits for."""
        from tickwise.operators.bars import resample
        from tickwise.operators.zones import LOOKBACKS
        out = self.read(spark)
        if ticker is not None:
            out = self.of_tickers(out, [ticker])
        if period != "max":
            if period not in LOOKBACKS:
                raise ValueError(f"unknown period {period!r}")
            out = self.since(out, F.add_months(out.select(F.max("d")).scalar(), -LOOKBACKS[period]))
        out = out.select(*BARS.names)
        return out if interval == "1d" else resample(out, interval)


# ---------------------------------------------------------------- versioned tables

class VersionedTable:
    """A small table whose readers always see one whole version.

    A version is a folder ``v-<number>``, there once it holds ``_SUCCESS``,
    which the writer's commit leaves last.  Writing a number again replaces
    it.  All but the last ``keep`` versions are removed, so a reader has the
    time of that many refreshes."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 10):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep
        self.folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self.fs = self.folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, version: int) -> str:
        return f"{self.path}/v-{version:012d}"

    def versions(self) -> list[int]:
        """Whole versions, oldest first."""
        if not self.fs.exists(self.folder):
            return []
        names = [x.getPath().getName() for x in self.fs.listStatus(self.folder)]
        whole = [int(n[2:]) for n in names if n.startswith("v-") and self.fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/_SUCCESS"))]
        return sorted(whole)

    def read(self, before: int | None = None, schema=None) -> DataFrame | None:
        """The newest version (below ``before``), None if there is none."""
        found = [v for v in self.versions() if before is None or v < before]
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.parquet(self._at(found[-1])) if found else None

    def write(self, df: DataFrame, version: int) -> None:
        df.write.mode("overwrite").parquet(self._at(version))
        for old in self.versions()[:-self.keep]:
            self.fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self._at(old)), True)

    def upsert(self, changed: DataFrame, version: int, key: str) -> None:
        """The version before with the rows of ``changed`` in place of those
        with their key."""
        old = self.read(before=version, schema=changed.schema)
        if old is not None:
            changed = old.join(changed, key, "left_anti").unionByName(changed)
        self.write(changed.coalesce(1), version)


def read_gold(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest whole gold table, None before the first."""
    return VersionedTable(spark, path).read(schema=GOLD)
