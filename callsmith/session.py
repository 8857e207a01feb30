"""Spark session helpers.

Cluster jobs get their settings from the cluster; ``get_spark`` only fills in
what is unset, so the same code runs under ``spark-submit`` and in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "callsmith",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session or build one with safe defaults.

    A running session keeps its settings: only SQL settings that it lacks, or
    that the caller passes here, are set.
    """
    asked = dict(extra or {})
    if shuffle_partitions:
        asked["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    running = SparkSession.getActiveSession()
    if running is not None:
        for k, v in {**_DEFAULTS, **asked}.items():
            if k.startswith("spark.sql.") and (k in asked or running.conf.get(k, None) is None):
                running.conf.set(k, v)
        return running
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**_DEFAULTS, **asked}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only if unset.

    On a cluster the setting names a shared folder.  Only a local session
    (tests, bench) without the setting gets a fresh directory under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="callsmith-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def default_parallelism(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


SPLIT_BYTES = 128 << 20


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin split an input that is stored in too few files to be read in parallel.

    Regex- and fold-heavy work is CPU bound per row; a source stored as one
    row group scans as one task.  Only file names and the planner's size
    estimate are looked at: no job runs, and an input large enough to arrive
    in many splits is not shuffled.
    """
    want = min_partitions or default_parallelism(df.sparkSession)
    if df.isStreaming:
        return df
    files = len(df.inputFiles())
    if min_partitions is None and (files == 0 or files >= want):
        return df
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(size)) >= want * SPLIT_BYTES:
        return df
    return df.repartition(want)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
