"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the time zone in which source dates are written.
SOURCE_ZONE = "Asia/Shanghai"


def get_spark(app_name: str = "listingflow", master: str | None = None, **conf) -> SparkSession:
    """Build (or reuse) a session with adaptive execution and the sources' time zone.

    Shuffle width is left to the cluster's own setting and to adaptive
    coalescing; tests pass ``spark_sql_shuffle_partitions=8``.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": SOURCE_ZONE,
    }
    settings.update({k.replace("_", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    master = master or os.environ.get("SPARK_MASTER")
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage: the session's own, else (local runs only) a fresh one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    fresh = tempfile.mkdtemp(prefix="listingflow-checkpoint-")
    spark.sparkContext.setCheckpointDir(fresh)
    return fresh


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
