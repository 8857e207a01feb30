"""One JSON array of any size, read in parallel (S1/S10): the same records and rejects as
``load_json_records``, whose files are read by one task each.

Spark's text reader cuts a file at commas, so a split of the file is a run of whole stretches
between commas, whatever its size and wherever it lies.  Each task joins its stretches to chunks of about
``CHUNK`` bytes; no chunk knows whether it starts inside a string, or how deep.

1. ``chunk_summaries``: for both cases (outside and inside a string) a chunk's end state, change
   of depth, and number of commas outside strings at each relative depth.
2. ``_states``: a running pass over the summaries of a file (one row a chunk) fixes each
   chunk's state, depth and the number of elements before it.
3. ``_pieces``: with these every chunk cuts its own text at the commas of depth 1.  Elements within a chunk
   are ready and parsed; the first and last piece of a chunk are put together with their neighbours by
   element number, so only they are shuffled.  The pieces are written once as a table in the shared folder: the
   verdict on each file and its records both read it, so the text is cut and parsed once.

A file with a byte that is no UTF-8, an element that is no JSON, text before or after the array, or an
end that is missing is one reject, and gives no records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsmith.operators.catalog import bounded_count
from callsmith.session import ensure_checkpoint_dir, shared_path

CHUNK = 1 << 20
# Chunk states that are shipped to every task (one row a chunk, under 100 bytes); more are joined.
MAX_SHIPPED_CHUNKS = 200_000

_CASE = "struct<end:boolean,change:bigint,high:bigint,low:bigint,commas:map<bigint,bigint>>"
SUMMARIES = ("file bigint, start bigint, no bigint, bytes bigint, valid boolean, first string, "
             f"outside {_CASE}, inside {_CASE}")
STATES = ("file bigint, start bigint, no bigint, quoted boolean, depth bigint, opened boolean, before bigint, "
          "n_elements bigint, issue string, is_array boolean")
PIECES = "file bigint, ord bigint, start bigint, no bigint, whole boolean, bad boolean, text binary"
HELD = ("file bigint, ord bigint, start bigint, no bigint, whole boolean, bad boolean, blank boolean, v variant, "
        "text string, sound boolean")

_QUOTE, _SLASH, _COMMA = ord('"'), ord("\\"), ord(",")
_STEP = np.zeros(256, np.int64)
_STEP[[ord("["), ord("{")]] = 1
_STEP[[ord("]"), ord("}")]] = -1
_BLANK = np.zeros(256, bool)
_BLANK[[ord(c) for c in " \t\r\n"]] = True


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(file, start of the split, number in the split, bytes) from rows of (file, start, stretch)
    in file order.  Every stretch has a comma before it, which a file's first gets from the query only."""
    key, no, held, held_bytes = None, 0, [], 0
    for b in batches:
        if not b.num_rows:
            continue
        files, starts = (c.to_numpy() for c in b.columns[:2])
        ends, text = _bytes(b.column(2))
        turns = np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1
        for lo, hi in zip([0, *turns.tolist()], [*turns.tolist(), len(files)]):
            begin = int(ends[lo])
            if key != (of := (int(files[lo]), int(starts[lo]))):
                if held:
                    yield (*key, no, b"".join(held))
                key, no, held, held_bytes = of, 0, [], 0
                begin += key[1] == 0
            while lo < hi:  # up to the stretch that fills the chunk
                full = int(np.searchsorted(ends[lo + 1:hi + 1], int(ends[lo]) + size - held_bytes)) + lo + 1
                upto = min(full, hi)
                held.append(text[begin:ends[upto]])
                held_bytes += int(ends[upto] - ends[lo])
                lo, begin = upto, int(ends[upto])
                if full <= hi:
                    yield (*key, no, b"".join(held))
                    no, held, held_bytes = no + 1, [], 0
    if held:
        yield (*key, no, b"".join(held))


def _bytes(column: pa.Array) -> tuple[np.ndarray, memoryview]:
    """Where each value of a binary column begins, and its last ends, in the bytes of all."""
    _, offsets, text = column.buffers()
    wide = np.int64 if pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type) else np.int32
    return (np.frombuffer(offsets, wide)[column.offset:column.offset + len(column) + 1].astype(np.int64),
            memoryview(text or b""))


def _inside(raw: np.ndarray) -> np.ndarray:
    """Whether each byte follows an odd number of quotes that open or close a string (itself included)."""
    quotes = np.flatnonzero(raw == _QUOTE)
    if len(quotes) and (raw == _SLASH).any():
        place = np.arange(len(raw))
        other = np.maximum.accumulate(np.where(raw != _SLASH, place, -1))
        before = np.where(quotes > 0, quotes - 1 - other[quotes - 1], 0)
        quotes = quotes[before % 2 == 0]
    turns = np.zeros(len(raw), np.int8)
    turns[quotes] = 1
    return np.cumsum(turns, dtype=np.int64) % 2 == 1


def _summary(raw: np.ndarray, outside: np.ndarray, ends: bool) -> dict:
    depth = np.cumsum(np.where(outside, _STEP[raw], 0))
    found, times = np.unique(depth[outside & (raw == _COMMA)], return_counts=True)
    return {"end": ends, "change": int(depth[-1]) if len(depth) else 0,
            "high": int(depth.max(initial=0)), "low": int(depth.min(initial=0)),
            "commas": list(zip(found.tolist(), times.tolist()))}


def _summarised(batches: Iterator[pa.RecordBatch], size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for file, start, no, text in _chunks(batches, size):
        raw = np.frombuffer(text, np.uint8)
        inside = _inside(raw)
        solid = np.flatnonzero(~_BLANK[raw])
        try:
            text.decode()
            valid = True
        except UnicodeDecodeError:
            valid = False
        last = bool(len(inside) and inside[-1])
        yield pa.RecordBatch.from_pylist([{
            "file": file, "start": start, "no": no, "bytes": len(text), "valid": valid,
            "first": chr(raw[solid[0]]) if len(solid) else None,
            "outside": _summary(raw, ~inside, last), "inside": _summary(raw, inside, not last)}], schema)


def _states(pdf: pd.DataFrame) -> pd.DataFrame:
    """The running pass over one file's chunks, and what is wrong with the file as a whole."""
    pdf = pdf.sort_values(["start", "no"])
    quoted, depth, opened, before, rows = False, 0, False, 0, []
    first, low, total = None, 0, 0
    for r in pdf.itertuples(index=False):
        case = r.inside if quoted else r.outside
        rows.append((r.file, r.start, r.no, quoted, depth, opened, before))
        first = first or r.first
        before += dict(case["commas"]).get(1 - depth, 0)
        low = min(low, depth + case["low"])
        opened = opened or depth + case["high"] > 0
        depth, quoted, total = depth + case["change"], case["end"], total + r.bytes
    issue = None
    if not pdf["valid"].all():
        issue = "bad_utf8"
    elif first == "[" and (quoted or depth or low < 0 or total != pdf["length"].iloc[0]):
        issue = "bad_json"
    out = pd.DataFrame(rows, columns=["file", "start", "no", "quoted", "depth", "opened", "before"])
    return out.assign(n_elements=before + 1, issue=issue, is_array=first == "[")


def _cut(text: bytes, quoted: bool, depth: int, opened: bool, before: int) -> tuple[np.ndarray, np.ndarray, bool, pa.Array]:
    """(element number, whole, bad, text) of a chunk's pieces; ``bad`` holds for all of them."""
    raw = np.frombuffer(text, np.uint8)
    outside = _inside(raw) == quoted
    after = depth + np.cumsum(np.where(outside, _STEP[raw], 0))
    level = np.concatenate([[depth], after[:-1]])
    opens, closes = np.flatnonzero((level == 0) & (after == 1)), np.flatnonzero((level == 1) & (after == 0))
    wrong = (not _BLANK[raw[(level == 0) & (after == 0)]].all() or len(opens) + opened > 1
             or (raw[opens] != ord("[")).any() or (raw[closes] != ord("]")).any() or after.min(initial=0) < 0)
    if wrong:
        return np.array([before]), np.array([True]), True, pa.array([b""])
    begin = int(opens[0]) + 1 if len(opens) else 0
    end = int(closes[0]) if len(closes) else len(text)
    if depth == 0 and not len(opens):  # white space around the array
        return np.zeros(0, np.int64), np.zeros(0, bool), False, pa.array([], pa.binary())
    cuts = np.flatnonzero(outside & (raw == _COMMA) & (after == 1))
    cuts = cuts[(cuts >= begin) & (cuts < end)] - begin
    whole = np.ones(len(cuts) + 1, bool)
    whole[0] &= bool(len(opens))
    whole[-1] &= bool(len(closes))
    # The pieces follow each other without the commas between them.
    pieces = np.delete(raw[begin:end], cuts)
    ends = np.concatenate([[0], cuts - np.arange(len(cuts)), [len(pieces)]]).astype(np.int32)
    return before + np.arange(len(whole)), whole, False, pa.Array.from_buffers(
        pa.binary(), len(whole), [None, pa.py_buffer(ends), pa.py_buffer(pieces)])


def _pieces(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(b.num_rows):
            r = b.slice(at, 1).to_pylist()[0]
            if r["is_array"]:
                ords, whole, bad, texts = _cut(r["text"], r["quoted"], r["depth"], r["opened"], r["before"])
            else:
                ords, whole, bad, texts = np.array([-1]), np.array([False]), False, pa.array([r["text"]], pa.binary())
            n = len(ords)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, r["file"])), pa.array(ords.astype(np.int64)), pa.array(np.full(n, r["start"])),
                 pa.array(np.full(n, r["no"])), pa.array(whole), pa.array(np.full(n, bad)), texts], schema=schema)


def load_json_splits(spark: SparkSession, path: str, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """``(records(source, ord, v), rejects(source, ord, issue))`` of files that hold one JSON array
    each, in as many tasks as Spark makes splits.  The pieces are cut and written when this is called."""
    from callsmith.sources.json_records import RECORDS_SCHEMA, REJECTS_SCHEMA, _as_records, json_pair, once, sole_json
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    try:
        files = spark.read.format("binaryFile").load(path).select(
            F.col("_metadata.file_path").alias("source"), F.xxhash64("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("length"))
        files.schema  # resolve the path now
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return (spark.createDataFrame([], RECORDS_SCHEMA),
                spark.createDataFrame([(path, None, "missing_path")], REJECTS_SCHEMA))
    ensure_checkpoint_dir(spark)

    def schema(ddl: str) -> pa.Schema:
        return to_arrow_schema(StructType.fromDDL(ddl))

    stretches = spark.read.text(path, lineSep=",").select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.concat(F.lit(b","), F.col("value").cast("binary")).alias("text"))
    summaries_as, texts_as, pieces_as = schema(SUMMARIES), schema(
        "file bigint, start bigint, no bigint, text binary"), schema(PIECES)
    summaries = stretches.mapInArrow(lambda b: _summarised(b, chunk, summaries_as), SUMMARIES)
    states = summaries.join(files.select(F.col("file").alias("of"), "length"), F.col("file") == F.col("of")).drop(
        "of").groupBy("file").applyInPandas(_states, STATES).checkpoint()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _chunks(batches, chunk):
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(row, texts_as)], schema=texts_as)

    shipped = bounded_count(states, MAX_SHIPPED_CHUNKS) <= MAX_SHIPPED_CHUNKS
    known = states.filter("issue is null").drop("issue", "n_elements")
    pieces = stretches.mapInArrow(texts, "file bigint, start bigint, no bigint, text binary").join(
        F.broadcast(known) if shipped else known, ["file", "start", "no"]).mapInArrow(
        lambda b: _pieces(b, pieces_as), PIECES)
    blank = F.trim(F.translate("text", "\t\r\n", "   ")) == ""
    path = shared_path(spark, "json_pieces")
    texts_of = pieces.select("file", "ord", "start", "no", "whole", "bad", F.col("text").cast("string").alias("text"))
    once(texts_of, "pair", json_pair(F.when(F.col("whole"), F.col("text")))).select(
        "file", "ord", "start", "no", "whole", "bad", blank.alias("blank"), sole_json(F.col("pair")).alias("v"),
        F.when(~F.col("whole"), F.col("text")).alias("text"), sole_json(F.col("pair")).isNotNull().alias("sound")).write.parquet(path)
    held = spark.read.schema(HELD).parquet(path)
    # Pieces at the edges of chunks, put together by element.
    edges = held.filter(~F.col("whole")).groupBy("file", "ord").agg(
        F.array_sort(F.collect_list(F.struct("start", "no", F.col("text").alias("t")))).alias("parts")).select(
        "file", "ord", F.lit(False).alias("bad"), F.array_join("parts.t", "").alias("text"))
    edges = once(edges, "pair", json_pair(F.col("text"))).select("file", "ord", "bad", blank.alias("blank"), sole_json(
        F.col("pair")).alias("v"), sole_json(F.col("pair")).isNotNull().alias("sound"))
    parsed = held.filter("whole").select("file", "ord", "bad", "blank", "v", "sound").unionByName(edges)
    totals = states.groupBy("file").agg(F.max("n_elements").alias("n_elements"), F.max("issue").alias("issue"))
    # A blank first element is an empty array where it is the only one.
    failed = "ord >= 0 and (bad or not sound and not (blank and ord = 0) or blank and ord > 0)"
    found = parsed.groupBy("file").agg(
        F.max(F.when(F.expr(failed) | (F.col("ord") < 0) & ~F.col("sound"), F.lit("bad_json")).when(
            F.col("ord") < 0, F.lit("not_array"))).alias("found"),
        F.max(F.expr("blank and ord = 0")).alias("hollow"))
    verdicts = files.join(totals, "file", "left").join(found, "file", "left").select(
        "file", "source", F.when(F.col("n_elements").isNull(), F.lit("bad_json")).otherwise(
            F.coalesce("issue", "found", F.when(F.col("hollow") & (F.col("n_elements") > 1), F.lit("bad_json")))).alias("issue"))
    sound_files = verdicts.filter("issue is null").select("file", "source")
    # A file's elements stay where they are, unless there are very many files.
    records, skipped = _as_records(parsed.filter("ord >= 0 and not blank").join(
        F.broadcast(sound_files) if shipped else sound_files, "file").select("source", "ord", "v"))
    return records, skipped.unionByName(verdicts.filter("issue is not null").select(
        "source", F.lit(None).cast("bigint").alias("ord"), "issue"))
