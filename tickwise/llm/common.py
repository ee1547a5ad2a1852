"""Shared helpers of the llm operators: tables, intermediate tables, bounds."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a text, as every operator here counts them: runs of anything but
#: blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named input table, cut to ``columns`` when given."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.  Only a local
    master may go without one: there it is a scratch folder of this machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def stash(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back:
    cuts the lineage, survives lost executors, and is computed only once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    schema = df.select(*[c for c in df.columns if c not in partition_by], *partition_by).schema
    written = spark.read.schema(schema).parquet(path)
    written.stashed_at = path
    return written


def release(*frames: DataFrame) -> None:
    """Delete what ``stash`` has written for these frames (the very frames that
    it returned); nothing may read them any more."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stashed_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def sweep(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs removed now: executors keep them
    until the driver's garbage collector finds that nothing refers to them."""
    spark._jvm.System.gc()


def unit_interval(*columns, seed: int):
    """A repeatable draw in [0, 1) from the columns, by md5 so that any SQL
    engine agrees: the first 13 hexadecimal digits over 16^13."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def power_of_two(n: int) -> int:
    """Next power of two at or above ``n`` (1 at least)."""
    return 1 << max(0, int(n) - 1).bit_length()
