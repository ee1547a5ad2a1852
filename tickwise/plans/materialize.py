"""Cut lineage at a reused intermediate.

A DataFrame referenced several times in one plan is recomputed per reference
(only identical exchanges are reused, and column pruning makes the references
differ).  Where a pipeline genuinely re-reads an intermediate (bars used for
index, block carries and calendar; returns used for both pair sides), the
caller writes it once, whatever its size, as a Parquet table under the shared
folder named by ``spark.checkpoint.dir``, and reads it back.  Compared with ``Dataset.checkpoint``
this computes the plan once (an RDD checkpoint re-runs it to write the
files), and the re-read gets column pruning and filter pushdown.  Lost
executors re-read files instead of recomputing the lineage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tickwise.session import checkpoint_dir

_WRITTEN: list[str] = []


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and return the scan."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the tables that ``materialize`` has written in this process; to
    be called when the frames over them have been consumed."""
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
