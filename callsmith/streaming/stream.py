"""The call pipeline on a stream.

Validation, selection, binding and typing keep no state per request, so the
batch functions apply unchanged to a streaming DataFrame: the catalogue side
is a static broadcast row (a stream-static join), and each micro-batch is
narrow.  No watermark or state store is needed.  Output goes through a file
sink with a checkpoint under the session's ``spark.checkpoint.dir`` (a shared
folder on a cluster), so a restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from callsmith.operators.validate import validate_requests
from callsmith.plans.job import calls_wide, propose_calls, run_job
from callsmith.session import ensure_checkpoint_dir


def stream_calls(requests: DataFrame, catalog: DataFrame, text_col: str = "prompt") -> DataFrame:
    """Streaming (or batch) requests → calls with ``picks``; see ``stream_rejects`` for the others."""
    valid, _ = validate_requests(requests, text_col)
    return propose_calls(valid, catalog, text_col=text_col)


def stream_rejects(requests: DataFrame, text_col: str = "prompt") -> DataFrame:
    """Streaming (or batch) requests that fail validation, for a side output."""
    _, rejects = validate_requests(requests, text_col)
    return rejects


def stream_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, the same for every session."""
    return spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)


def run_stream_to_parquet(spark: SparkSession, calls: DataFrame, name: str,
                          available_now: bool = True) -> tuple[StreamingQuery, str]:
    """Start a parquet sink for ``calls``; returns the query and the output path.

    Both paths follow from ``name`` alone, so a stream started again under its name resumes."""
    base = os.path.join(stream_root(spark), f"stream-{name}")
    out, ckpt = os.path.join(base, "out"), os.path.join(base, "checkpoint")
    writer = (calls.writeStream.format("parquet").option("path", out)
              .option("checkpointLocation", ckpt).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(), out


def run_stream_job(spark: SparkSession, requests: DataFrame, catalog: DataFrame, name: str, text_col: str = "prompt",
                   available_now: bool = True, **options) -> tuple[StreamingQuery, str]:
    """K7 on a stream, exactly once: calls (with JSON arguments), rejects and a summary row of every micro-batch.

    Each batch writes ``<base>/calls/batch=<id>``, ``rejects/batch=<id>`` and ``summary/batch=<id>``, replacing
    what a broken run of the same batch has left.  A batch counts as done only when the query's
    checkpoint has it, so a restart repeats at most the unfinished batch and no row is lost or doubled.
    ``options`` go to ``run_job``.  Returns the query and the base path (see ``read_stream_job``)."""
    base = os.path.join(stream_root(spark), f"stream-job-{name}")

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()  # three outputs, one read of the source
        try:
            job = run_job(held, catalog, text_col=text_col, **options)
            keep = [c for c in held.columns if c != text_col]
            outputs = (("calls", calls_wide(job.calls, keep, text_col)), ("rejects", job.rejects), ("summary", job.summary()))
            for kind, rows in outputs:
                rows.write.mode("overwrite").parquet(os.path.join(base, kind, f"batch={batch_id}"))
        finally:
            held.unpersist()

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(base, "checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(), base


def read_stream_job(spark: SparkSession, base: str, kind: str) -> DataFrame:
    """The finished batches' ``calls``, ``rejects`` or ``summary`` rows, with their ``batch``."""
    commits = os.path.join(base, "checkpoint", "commits")
    # A batch is finished when the query has committed it.
    done = spark.read.format("binaryFile").option("pathGlobFilter", "[0-9]*").load(commits).select(
        F.regexp_extract("path", r"([0-9]+)$", 1).cast("int").alias("batch"))
    rows = spark.read.parquet(os.path.join(base, kind))
    return rows.join(F.broadcast(done), rows["batch"] == done["batch"], "left_semi")
