"""Operator 3: packing documents into near-equal windows by Karmarkar-Karp.

A partition's documents are tokenised in a stream.  Whole windows of a long
document are sequences of their own; the rest is cut into parts of at most
``part`` ids.  Each time the parts fill a group of ``group`` windows, multiway
differencing deals them out: every part starts as a partial partition, and the
two partial partitions with the largest imbalance are merged, the fullest
window of one with the emptiest of the other, until one is left.  If its
fullest window exceeds the capacity, the window count rises by one and the
group is dealt again.  Memory is bounded by one group and one document, and
there is no shuffle.

Padding: a group of ``group`` windows is closed ``slack`` ids a window below
its capacity (the last part is cut there); a partition ends with at most one
unfilled window more.

Defined cases: null text is empty, so the document is its end id alone; null
ids and repeated rows are packed like any other; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from callsmith.llm.tokenizing import encoder

PIECES = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Deal the indexes of ``sizes`` into ``windows`` lists of near-equal sums."""
    # A partial partition: its non-empty windows as (sum, indexes), fullest first.
    def entry(order: int, parts: list[tuple[int, list[int]]]):
        low = parts[-1][0] if len(parts) == windows else 0
        return (low - parts[0][0], order, parts)

    heap = [entry(i, [(size, [i])]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    order = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        alone = windows - len(b)  # windows of a that meet an empty one of b
        merged = a[:alone] + [(x + y, p + q) for (x, p), (y, q) in zip(a[alone:], reversed(b))]
        merged += b[:max(0, windows - len(a))]
        merged.sort(key=lambda w: -w[0])
        heapq.heappush(heap, entry(order, merged))
        order += 1
    return [p for _, p in heap[0][2]] if heap else []


def deal(sizes: list[int], capacity: int) -> list[list[int]]:
    """The fewest windows from ceil(total / capacity) on whose fullest fits."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        dealt = differencing(sizes, windows)
        if max((sum(sizes[i] for i in w) for w in dealt), default=0) <= capacity:
            return dealt
        windows += 1


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048,
                   group: int = 256, part: int = 512, slack: int = 2) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset (gapless from 0 within a sequence)."""
    target = group * (capacity - slack)
    end = np.array([end_id], dtype="<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, True)
        sequence = TaskContext.get().partitionId() << 36
        out: list[tuple] = []
        parts: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        held = 0

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(),
                     pa.int64()]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)], names)

        def close() -> None:
            nonlocal sequence, held
            for window in deal([len(p[2]) // 4 for p in parts], capacity):
                offset = 0
                for i in window:
                    doc, start, ids, n = parts[i]
                    out.append((doc, start, len(ids) // 4, ids, n, sequence, offset))
                    offset += len(ids) // 4
                sequence += 1
            parts.clear()
            held = 0

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = enc.packed(text.as_py()) + end
                n = len(ids) // 4
                whole = n // capacity
                for k in range(whole):
                    out.append((doc, k * capacity, capacity,
                                ids[4 * k * capacity:4 * (k + 1) * capacity], n, sequence, 0))
                    sequence += 1
                    if len(out) >= 512:
                        yield batch()
                at = whole * capacity
                while at < n:
                    take = min(part, n - at, target - held)
                    parts.append((doc, at, ids[4 * at:4 * (at + take)], n))
                    at, held = at + take, held + take
                    if held == target:
                        close()
                        yield batch()
        if parts:
            close()
        if out:
            yield batch()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(pack, PIECES)
