"""Spark session defaults used by tests, the bench and the examples.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it.  ``build_session`` is for local runs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every tickwise job relies on: UTC session time (epoch-second ticks
# and window boundaries), AQE for runtime join selection / skew splitting /
# partition coalescing, ANSI kept on (ratios use try_divide).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings that a running session can't change.  A series plan has many small
# window functions; with the default of 100 classes their generated code is
# compiled anew in every query.
STATIC_CONF = {"spark.sql.codegen.cache.maxEntries": "2000"}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tickwise", extra: dict | None = None) -> SparkSession:
    """Local/test session.  Keeps the UI off and sets a scratch checkpoint dir
    only when none is configured (tests); a cluster provides its own."""
    master = master or os.environ.get("TICKWISE_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("TICKWISE_SHUFFLE_PARTITIONS", "8"))
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(parts))
               .config("spark.driver.memory", os.environ.get("TICKWISE_DRIVER_MEMORY", "16g")))
    for k, v in {**CORE_CONF, **STATIC_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Read from the session.  Only a local master may go without: there one
    scratch folder per session is created and registered.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tickwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def apply_core_conf(spark: SparkSession) -> None:
    """Apply the session-level settings tickwise needs to an existing session."""
    for k, v in CORE_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
