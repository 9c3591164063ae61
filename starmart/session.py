"""SparkSession construction with settings suited to the star-schema jobs."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults applied only when a key is not already set on the builder / cluster.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE turns a planned sort-merge join into a broadcast join once the
    # materialised side is measured below this size.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    # checkpoint files of garbage-collected DataFrames are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(
    app: str = "starmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) a session.

    On a cluster ``master`` stays ``None`` and the submit settings win; for
    local runs pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    for k, v in merged.items():
        builder = builder.config(k, v)
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", os.environ.get("STARMART_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate data, which the cluster names in ``spark.checkpoint.dir``.

    A session on one machine (``local[...]``), as in tests, gets a folder of
    its own where the setting is missing.  On a cluster a machine-local folder
    is never a valid fallback, so a missing setting is an error there.
    """
    context = spark.sparkContext
    found = context.getCheckpointDir()
    if found:
        return found
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder")
        named = tempfile.mkdtemp(prefix="starmart-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df):
    """Write an intermediate as Parquet into the shared folder and read it back.

    This cuts the lineage, survives lost executors and is columnar: readers
    load only the columns they use, and filters reach the scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
