"""Operator 10: token ids of whole documents in Simple-8b files.

Documents are range-partitioned and sorted by doc_id (and a hash of the text, so a hot id is split), tokenised, and written
as a Parquet table of coded blocks, one file per range, so Spark's committer
makes the output whole or absent and a lost task is simply run again.

A row holds whole documents (about ``row_ids`` ids): their ids and token counts, the
Simple-8b words of all their ids, and for each coding block of ``BLOCK`` ids
where its words and its escapes begin, so blocks decode on their own.  The top
four bits of a 64-bit word select how many values it holds at how many bits
(``SELECTORS``); the last selector is an escape, whose payload is an index into
the row's table of values that need more than 60 bits.  Decoding is vectorised:
the selectors give every word's first position by one cumulative sum, and the
words of one selector are unpacked together.

Defined cases: null text is empty (the end id alone); rows with a null doc_id
come first; repeated ids follow each other, ordered by a hash of the text; an empty table gives an empty
file set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from callsmith.llm.common import shuffle_partitions, text_hash
from callsmith.llm.tokenizing import encoder

# Values per word and bits per value, by selector; then the escape.
SELECTORS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10),
             (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ESCAPE = 15
BLOCK = 65_536
SLICE_BYTES = 1 << 25  # of text encoded at once
_COUNTS = np.array([c for c, _ in SELECTORS] + [1], np.int64)  # an escape holds one value
# Maxima over a and then b positions give those over a + b; by the count that needs them first.
_SUMS = {2: [(1, 1)], 3: [(2, 1)], 4: [(2, 2)], 5: [(4, 1)], 6: [(4, 2)], 7: [(4, 3)], 8: [(4, 4)], 10: [(8, 2)],
         12: [(8, 4)], 15: [(8, 7)], 20: [(10, 10)], 30: [(15, 15)], 60: [(30, 30)]}

_BITS16 = np.array([int(i).bit_length() for i in range(1 << 16)], dtype=np.uint8)


def bit_lengths(values: np.ndarray) -> np.ndarray:
    if not len(values) or int(values.max()) < 1 << 16:
        return _BITS16[values.astype(np.uint16)]
    out = np.zeros(len(values), np.uint8)
    rest = values
    for step in range(0, 64, 16):
        low = _BITS16[rest & np.uint64(0xFFFF)]
        out = np.where(low > 0, low + np.uint8(step), out)
        rest = rest >> np.uint64(16)
        if not rest.any():
            break
    return out


def _selectors(bits: np.ndarray) -> np.ndarray:
    """The first selector, by position, whose count of values from there on fits its width; positions after
    the end count as 0 bits.  Counts fall as widths rise, so where one fits all later ones do: it is the number
    of those that do not, and none has to be looked at before one that fits nowhere."""
    maxima, selector = {1: bits}, np.zeros(len(bits), np.uint8)
    for s in range(len(SELECTORS) - 1, -1, -1):
        count, width = SELECTORS[s]
        for a, b in _SUMS.get(count, ()):
            both = maxima[a].copy()
            if a < len(bits):
                np.maximum(both[:-a], maxima[b][a:], out=both[:-a])
            maxima[a + b] = both
        unfit = maxima[count] > width
        if unfit.all():
            return selector + np.uint8(s + 1)
        selector += unfit
    return selector


def encode_block(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Simple-8b words and escaped values of one block of unsigned 64-bit values."""
    n = len(values)
    selector = _selectors(bit_lengths(values))
    at, steps, begins = 0, _COUNTS.astype(np.uint8)[selector].tobytes(), bytearray(n)
    while at < n:
        begins[at] = 1
        at += steps[at]
    first = np.flatnonzero(np.frombuffer(begins, np.bool_))
    chosen = selector[first]
    chosen[chosen == len(SELECTORS)] = ESCAPE
    words = chosen.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([values, np.zeros(60, np.uint64)])
    for s in np.flatnonzero(np.bincount(chosen)).tolist():
        mine = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            words[mine] |= np.arange(len(mine), dtype=np.uint64)
            continue
        count, width = SELECTORS[s]
        at, packed = first[mine], words[mine]
        for j in range(count):
            packed |= padded[at + j] << np.uint64(j * width)
        words[mine] = packed
    return words, values[first[chosen == ESCAPE]]


def decode_block(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of one block."""
    counts = np.array([c for c, _ in SELECTORS] + [0] + [1], np.int64)
    chosen = (words >> np.uint64(60)).astype(np.int64)
    first = np.cumsum(counts[chosen]) - counts[chosen]
    out = np.zeros(n + 60, np.uint64)
    for s in np.unique(chosen):
        mine = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            out[first[mine]] = escapes[(words[mine] & np.uint64((1 << 60) - 1)).astype(np.int64)]
            continue
        count, width = SELECTORS[s]
        at, packed = first[mine], words[mine]
        for j in range(count):
            out[at + j] = (packed >> np.uint64(j * width)) & np.uint64((1 << width) - 1)
    return out[:n]


ROWS = ("file_no int, first bigint, doc_ids array<bigint>, doc_tokens array<bigint>, "
        "words binary, word_offsets array<bigint>, escapes binary, escape_offsets array<bigint>")


def encode_row(values: np.ndarray) -> tuple[bytes, list[int], bytes, list[int]]:
    """Words, where each block's words begin, escapes, where each block's escapes begin."""
    words, word_at, escapes, escape_at = [], [0], [], [0]
    for at in range(0, len(values), BLOCK):
        w, e = encode_block(values[at:at + BLOCK])
        words.append(w.astype("<u8").tobytes())
        escapes.append(e.astype("<u8").tobytes())
        word_at.append(word_at[-1] + len(w))
        escape_at.append(escape_at[-1] + len(e))
    return b"".join(words), word_at, b"".join(escapes), escape_at


def decode_row(words: bytes, word_at, escapes: bytes, escape_at, n: int) -> np.ndarray:
    w, e = np.frombuffer(words, "<u8"), np.frombuffer(escapes, "<u8")
    blocks = [decode_block(w[word_at[k]:word_at[k + 1]], e[escape_at[k]:escape_at[k + 1]],
                           min(BLOCK, n - k * BLOCK)) for k in range(len(word_at) - 1)]
    return np.concatenate(blocks) if blocks else np.zeros(0, np.uint64)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list[int | None], list[str | None]]]:
    """doc_ids and texts of a batch, in slices of about ``SLICE_BYTES`` of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for lo, hi in zip(cuts, cuts[1:]):
        if lo < hi:
            doc_ids, texts = (c.slice(lo, hi - lo).to_pylist() for c in batch.columns)
            yield doc_ids, texts


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2,
                      row_ids: int = 2 * BLOCK) -> None:
    """Tokenise all documents and write them in ascending doc_id order."""
    spark = docs.sparkSession

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, False)
        file_no = TaskContext.get().partitionId()
        doc_ids, counts, held, size, first = [], [], [], 0, 0

        def row() -> pa.RecordBatch:
            values = np.concatenate(held).astype(np.uint64)
            words, word_at, escapes, escape_at = encode_row(values)
            longs = pa.list_(pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([file_no], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([doc_ids], longs), pa.array([counts], longs),
                 pa.array([words], pa.binary()), pa.array([word_at], longs),
                 pa.array([escapes], pa.binary()), pa.array([escape_at], longs)],
                ["file_no", "first", "doc_ids", "doc_tokens", "words", "word_offsets", "escapes",
                 "escape_offsets"])

        for b in batches:
            for docs_in, texts in _slices(b):
                ids, sizes = enc.batch(texts)
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                at = 0
                for doc, n in zip(docs_in, (sizes + 1).tolist()):
                    doc_ids.append(doc)
                    counts.append(n)
                    held.append(ids[at:at + n])
                    at += n
                    size += n
                    if size >= row_ids:
                        yield row()
                        first += size
                        doc_ids, counts, held, size = [], [], [], 0
        if doc_ids:
            yield row()

    (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                 F.col("text").cast("string").alias("text"))
     .withColumn("text_hash", text_hash(F.col("text")))  # splits the rows of one hot id
     .repartitionByRange(shuffle_partitions(spark), "doc_id", "text_hash")
     .sortWithinPartitions("doc_id", "text_hash", "text").drop("text_hash")
     .mapInArrow(code, ROWS).write.parquet(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start (ids before it in the whole file set),
    n_tokens, ids (little-endian unsigned 32-bit)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                counts = np.array(r["doc_tokens"], np.int64)
                ends = np.cumsum(counts)
                ids = decode_row(r["words"], r["word_offsets"], r["escapes"],
                                 r["escape_offsets"], int(ends[-1])).astype("<u4").tobytes()
                begins = (ends - counts).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["file_no"]] * len(counts), pa.int32()),
                     pa.array(r["doc_ids"], pa.int64()),
                     pa.array([r["first"] + x for x in begins], pa.int64()),
                     pa.array(counts, pa.int64()),
                     pa.array([ids[4 * x:4 * (x + n)] for x, n in zip(begins, counts.tolist())],
                              pa.binary())],
                    ["file_no", "doc_id", "begin", "n_tokens", "ids"])

    rows = spark.read.schema(ROWS).parquet(path)
    # One row per file: the ids of all files before it.
    sizes = rows.groupBy("file_no").agg(F.sum(F.aggregate(
        "doc_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("file_tokens"))
    before = sizes.select(F.col("file_no").alias("file"), F.coalesce(F.sum("file_tokens").over(
        Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("before"))
    docs = rows.mapInArrow(decode, "file_no int, doc_id bigint, begin bigint, n_tokens bigint, "
                                   "ids binary")
    return docs.join(F.broadcast(before), docs.file_no == before.file).select(
        "doc_id", (F.col("before") + F.col("begin")).alias("start"), "n_tokens", "ids")
