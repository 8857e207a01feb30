"""Operator 2: SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two 32-bit segments.  Of two fingerprints at
most three bits apart, one segment differs in at most one bit, so both have a
variant of that segment with the same bit deleted.  The 2 x 32 variants of each
distinct fingerprint are the index; equal variants meet by grouping (an
equality self-join without its pairs), are verified by the whole bit distance,
and give links.

Skew: exact copies share a fingerprint and count once.  Variants in which no
two fingerprints differ at the deleted bit are needed only once a segment and are dropped
for the other 31 bits.  Within a group no pairs are emitted: a breadth-first search
links each found fingerprint to the least of its local component, so k members
give at most k - 1 links.  A variant that may hold more than ``HOT`` fingerprints
is split by the four bytes of the other segment (at most three bits differ, so one
byte is equal), which loses no link.

Defined cases: a null or empty text has fingerprint zero and is linked like any
other; fewer words than a shingle form one shingle; rows with a null doc_id get
their component's id, null if no member has one; repeated rows repeat; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from callsmith.llm.common import reliable, shuffle_partitions, text_hash
from callsmith.llm.components import connected_components

HOT = 4096
_STEP = 65_536

# 256 x 8: the bits of a byte, lowest first.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_LANES = np.arange(8, dtype=np.int64) * 256


def _bit_counts(hashes: list[int]) -> np.ndarray:
    lanes = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    table = np.bincount((lanes + _LANES).ravel(), minlength=2048).reshape(8, 256)
    return (table @ _BYTE_BITS.astype(np.int64)).ravel()


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash of the word shingles of one text."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begin = [0, *ends[:n - 1].tolist()]
    end = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _STEP):  # bounded memory on very long texts
        counts += _bit_counts([xxh64_intdigest(joined[a:b], seed)
                               for a, b in zip(begin[at:at + _STEP], end[at:at + _STEP])])
    bits = np.packbits((2 * counts > n).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp, text_hash): one row per row of ``docs``."""

    @F.pandas_udf("bigint")
    def of_texts(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       of_texts(F.col("text").cast("string")).alias("fp"),
                       text_hash(F.col("text")).alias("text_hash"))


def _forest(fps: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Links (fingerprint, least of its component) among fingerprints of one group."""
    if len(fps) == 2:
        a, b = int(fps[0]), int(fps[1])
        if 0 < ((a ^ b) & ((1 << 64) - 1)).bit_count() <= distance:
            yield max(a, b), min(a, b)
        return
    left = np.unique(fps)
    while len(left) > 1:
        root, queue, left = int(left[0]), [left[0]], left[1:]
        while queue and len(left):
            near = np.bitwise_count((left ^ queue.pop()).view(np.uint64)) <= distance
            if near.any():
                yield from ((int(m), root) for m in left[near])
                queue.extend(left[near])
                left = left[~near]


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """(u, v) links that connect all fingerprints (column fp, distinct) at most
    ``distance`` (up to 3) bits apart."""
    spark = fps.sparkSession
    if distance > 3:
        raise ValueError("two segments with one deleted bit reach 3 bits at most")
    low32 = F.lit(0xFFFFFFFF).cast("bigint")

    def segment(which: int):
        return F.shiftrightunsigned("fp", 32 * which).bitwiseAND(low32)

    # Segments that many fingerprints share: their variants are split.
    shared = fps.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("s"), segment(s).alias("value")) for s in (0, 1)])).alias("x"))
    bit = F.col("slot") % 32
    mask = F.expr("shiftleft(1L, cast(slot % 32 as int))")
    hot = (shared.groupBy("x.s", "x.value").count().filter(F.col("count") > HOT // 2)
           .select("s", "value", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("b"))
           .select((F.col("s") * 32 + F.col("b")).alias("slot"), "value")
           .select(_key(mask)).distinct().withColumn("hot", F.lit(True)))
    # 64 rows a fingerprint follow, so the small input is spread first.
    slots = fps.repartition(shuffle_partitions(spark)).select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("slot"))
    value = F.when(F.col("slot") < 32, segment(0)).otherwise(segment(1))
    other = F.when(F.col("slot") < 32, segment(1)).otherwise(segment(0))
    index = slots.select("fp", "slot", value.alias("value"), other.alias("other")).select(
        "fp", _key(mask), (bit == 0).alias("first"), (F.col("value").bitwiseAND(mask) != 0).alias("bit"),
        F.col("other"))
    if hot.isEmpty():
        index = index.withColumn("sub", F.lit(-1))
    else:
        parts = F.array(*[F.lit(k * 256).cast("bigint") + F.shiftrightunsigned("other", 8 * k)
                          .bitwiseAND(F.lit(255).cast("bigint")) for k in range(4)])
        index = index.join(hot, "key", "left").select(
            "fp", "key", "first", "bit",
            F.explode(F.when(F.col("hot"), parts.cast("array<int>"))
                      .otherwise(F.array(F.lit(-1)))).alias("sub"))
    groups = (index.groupBy("key", "sub")
              .agg(F.collect_list("fp").alias("fps"), F.max("first").alias("first"),
                   F.min("bit").alias("lo"), F.max("bit").alias("hi"))
              .filter((F.size("fps") > 1) & (F.col("first") | (F.col("lo") != F.col("hi"))))
              .select("fps"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u, v = [], []
            lists = b.column(0)
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            for k in range(len(lists)):
                for x, y in _forest(flat[at[k]:at[k + 1]], distance):
                    u.append(x)
                    v.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())],
                                             ["u", "v"])

    return groups.mapInArrow(search, "u bigint, v bigint")


def _key(mask):
    return F.expr("shiftleft(cast(slot as bigint), 32)").bitwiseOR(
        F.col("value").bitwiseAND(F.bitwise_not(mask))).alias("key")


def _grouped(docs: DataFrame, shingle: int, distance: int) -> DataFrame:
    """(doc_id, fp, text_hash, root, component_id): ``root`` is the component's least fingerprint."""
    prints = reliable(fingerprints(docs, shingle))
    fps = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    found = connected_components(links(fps.select("fp"), distance))
    rooted = fps.join(found, fps.fp == found.node, "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = rooted.select("fp", "root").join(ids, "root")
    return prints.join(classes, "fp").select("doc_id", "fp", "text_hash", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the least doc_id reachable over
    links of at most ``distance`` bits, the document itself included."""
    return _grouped(docs, shingle, distance).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One document of each near-duplicate group: the one with the least doc_id, or a
    row without one where no member has one.

    Rows are told apart by doc_id and text, so rows of different groups that share an
    id each stay for their group; of rows equal in both one stays."""
    rows = _grouped(docs, shingle, distance).groupBy("root", "doc_id", "text_hash").count()
    kept = reliable(rows.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "count")).alias("k")).select(
        F.col("k.doc_id").alias("_simhash_id"), F.col("k.text_hash").alias("_simhash_hash"),
        F.col("k.count").alias("_simhash_count")))
    out = docs.join(kept, docs["doc_id"].cast("bigint").eqNullSafe(F.col("_simhash_id"))
                    & (text_hash(docs["text"]) == F.col("_simhash_hash")), "left_semi")
    if not kept.filter("_simhash_count > 1").isEmpty():  # rows that repeat id and text
        key = out.withColumn("_simhash_text", text_hash(out["text"]))
        out = key.dropDuplicates(["doc_id", "_simhash_text"]).drop("_simhash_text")
    return out
