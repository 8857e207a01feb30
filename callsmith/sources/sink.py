"""Result sink.

Calls are written as Spark part files (parquet by default, or JSON Lines)
with ``{prompt, fn_name, args}``; ``args`` is a VARIANT built from the typed
values in declared argument order.  Spark's commit protocol makes the output
all-or-nothing, and a failing write raises (the reference swallows sink
errors; we do not).  The written row count comes back from an
``Observation`` on the same pass, not from a second scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from callsmith.operators.decode import json_scalar, pack_arguments


def calls_for_output(calls: DataFrame, text_col: str = "prompt",
                     order_col: str | None = None) -> DataFrame:
    """``prompt, fn_name, args`` (args as VARIANT), optionally in request order."""
    out = calls.select(*([order_col] if order_col else []), F.col(text_col).alias("prompt"), "fn_name",
                       F.parse_json(pack_arguments(F.col("picks"))).alias("args"))
    if order_col:
        out = out.orderBy(order_col).drop(order_col)
    return out


def write_calls(calls: DataFrame, path: str, fmt: str = "parquet", text_col: str = "prompt",
                order_col: str | None = None) -> int:
    """Write the calls; return the number of rows written."""
    obs = Observation("write_calls")
    if fmt == "json":
        # JSON Lines written as text: the args object keeps its declared key
        # order and float values keep their decimal point.
        line = F.concat(F.lit('{"prompt":'), json_scalar(F.col(text_col)), F.lit(',"fn_name":'),
                        json_scalar(F.col("fn_name")), F.lit(',"args":'),
                        pack_arguments(F.col("picks")), F.lit("}"))
        out = calls.select(*([order_col] if order_col else []), line.alias("value"))
        if order_col:
            out = out.orderBy(order_col).drop(order_col)
        out.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").text(path)
    elif fmt == "parquet":
        out = calls_for_output(calls, text_col, order_col).observe(obs, F.count(F.lit(1)).alias("n"))
        out.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return int(obs.get["n"])


def joined_lines(lines: DataFrame) -> DataFrame:
    """One text column's rows as fewer and longer ones, in their order: the lines of an Arrow batch with newlines
    between them, so the text writer writes the same file from megabytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                _, offsets, text = b.column(0).buffers()
                wide = np.int64 if pa.types.is_large_binary(b.column(0).type) else np.int32
                ends = np.frombuffer(offsets, wide)[b.column(0).offset:b.column(0).offset + b.num_rows + 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([memoryview(text)[ends[0]:ends[-1] - 1].tobytes()], pa.binary())], ["value"])

    each = F.concat(F.coalesce(F.col(lines.columns[0]), F.lit("")), F.lit("\n")).cast("binary")
    return lines.select(each.alias("value")).mapInArrow(run, "value binary").select(F.col("value").cast("string"))
