"""The call pipeline on a file stream equals the batch result."""

import os
import tempfile

from pyspark.sql import functions as F

from callsmith.plans.job import propose_calls, summarize_requests
from callsmith.sources.requests import lineitem_sum_requests, mixed_requests
from callsmith.streaming.stream import run_stream_to_parquet, stream_calls
from conftest import SMALL


def _flat(df):
    return df.select("l_orderkey", "l_linenumber", "fn_name",
                     F.get(F.col("picks"), 0)["c"]["v_float"].alias("a"),
                     F.get(F.col("picks"), 1)["c"]["v_float"].alias("b"))


def test_stream_equals_batch(spark, catalog):
    path = os.path.join(SMALL, "lineitem.parquet")
    schema = spark.read.parquet(path).schema
    src = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(SMALL)
    q, out = run_stream_to_parquet(spark, _flat(stream_calls(lineitem_sum_requests(src), catalog)), "t")
    q.awaitTermination()
    streamed = spark.read.parquet(out)
    batch = _flat(propose_calls(lineitem_sum_requests(spark.read.parquet(path)), catalog))
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_stream_restart_resumes_from_checkpoint(spark, catalog):
    d = tempfile.mkdtemp(prefix="callsmith-test-", dir="/tmp")
    inp = os.path.join(d, "in")
    spark.createDataFrame([(1, "What is the sum of 1 and 2?")], "k int, prompt string") \
        .write.mode("overwrite").parquet(os.path.join(inp, "a"))
    schema = "k int, prompt string"

    def run():
        src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(inp)
        calls = stream_calls(src, catalog).select("k", "fn_name")
        w = (calls.writeStream.format("parquet").option("path", os.path.join(d, "out"))
             .option("checkpointLocation", os.path.join(d, "ckpt")).trigger(availableNow=True).start())
        w.awaitTermination()

    run()
    spark.createDataFrame([(2, "Greet shrek")], schema).write.parquet(os.path.join(inp, "b"))
    run()
    got = sorted((r.k, r.fn_name) for r in spark.read.parquet(os.path.join(d, "out")).collect())
    assert got == [(1, "fn_add_numbers"), (2, "fn_greet")]


def test_single_pass_summary(spark, catalog):
    r = summarize_requests(mixed_requests(spark, SMALL), catalog).first()
    assert r.n_calls > 0 and r.n_fallback == 0 and r.n_rejected >= 0
