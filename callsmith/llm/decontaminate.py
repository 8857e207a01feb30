"""Operator 1 [native]: benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``window`` consecutive words (a shorter item
is one window).  A window's elements are its ``SHINGLE``-word shingles (all its words for
a shorter window), ordered by rarity over the whole corpus.  Exact containment
asks for every element, so the necessary prefix is one element long
(|w| - |w| + 1): the rarest.  Only that element is joined with the shingles of
the documents; a window whose rarest element occurs nowhere is out.  A match
at window position p and document position q gives the one place q - p the
window can start; the length and positional bounds (it starts at 0 or later
and ends inside the document) and the exact comparison of all its words are
conditions of the join.

Both passes over the corpus are narrow: documents are exploded, probed
against a broadcast table of checked size, and pre-aggregated in the same
stage.  A benchmark beyond that size is worked off in blocks, each
broadcast in its turn, and the blocks' hits are added up.

Defined cases: null text has no words; an item without words has no window; an
item with a null id marks words but is not listed; items that repeat an id
count once; every row of ``docs`` gives one row, also with repeated or null
ids; an empty benchmark marks nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.column import Column

from callsmith.llm.common import ascii_lower, reliable, text_hash

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 3
BLOCK_ROWS = 200_000        # windows broadcast at a time
BLOCK_SHINGLES = 2_000_000  # shingle hashes broadcast at a time


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))),
                                  SEPARATORS), "")


def _shingle(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(words, at + F.lit(j)) for j in range(size)])


def _keys_at(words: Column, at: Column, sizes: list[int]) -> Column:
    return F.array(*[_shingle(words, at, k) for k in sizes])


def benchmark_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """Distinct windows: win (words), win_n, size (words a shingle), items (ids as strings)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"),
                             words_of(F.col("text")).alias("ws"))
    items = items.withColumn("n", F.size("ws")).filter("n > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.col("n") - window, F.lit(0)))
    return (items.select("item", F.explode(F.transform(
                starts, lambda s: F.slice(F.col("ws"), s + 1, window))).alias("win"))
            .groupBy("win").agg(F.collect_set("item").alias("items"))
            .select("win", "items", F.size("win").alias("win_n"),
                    F.least(F.size("win"), F.lit(SHINGLE)).alias("size")))


def _elements(windows: DataFrame, sizes: list[int]) -> DataFrame:
    """One row per window and shingle position: win, key, p."""
    key = F.lit(None).cast("bigint")
    at = F.col("p")
    out = windows.select("*", F.explode(F.sequence(F.lit(0), F.col("win_n") - F.col("size")))
                         .alias("p"))
    for k in sizes:
        key = F.when(F.col("size") == k, _shingle(F.col("win"), at, k)).otherwise(key)
    return out.withColumn("key", key)


def _exploded(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """One row per document word (one for a document without words) and shingle size."""
    base = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col("doc_id").alias("doc_id"), text_hash(F.col("text")).alias("text_hash"),
                       words_of(F.col("text")).alias("ws"))
    base = base.select("*", F.size("ws").alias("n"))
    out = base.select("*", F.posexplode_outer("ws").alias("q", "w"))
    if len(sizes) == 1:
        return out.withColumn("key", _shingle(F.col("ws"), F.col("q"), sizes[0]))
    return out.withColumn("key", F.explode(_keys_at(F.col("ws"), F.col("q"), sizes)))


def _blocks(rows: int, most: int) -> int:
    return max(1, -(-rows // most))


def prefix_index(docs: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """key, p, win, win_n, items: each window under its rarest element in the corpus."""
    elements = _elements(windows, sizes)
    keys = reliable(elements.select("key").distinct())
    blocks = _blocks(keys.count(), BLOCK_SHINGLES)
    corpus = _exploded(docs, sizes).select("key")
    counts = reduce(DataFrame.union, [
        corpus.join(F.broadcast(keys.filter(F.pmod("key", F.lit(blocks)) == b)), "key")
        .groupBy("key").count() for b in range(blocks)])
    rarest = (elements.join(counts, "key")  # inner: an element that occurs nowhere rules out...
              .groupBy("win").agg(F.min(F.struct("count", "key", "p")).alias("r"),
                                  F.count("*").alias("found")))
    whole = rarest.filter(F.col("found") > 0).join(windows, "win")
    # ... the window: all its elements must have been found.
    return whole.filter(F.col("found") == F.col("win_n") - F.col("size") + 1).select(
        F.col("r.key").alias("key"), F.col("r.p").alias("p"), "win", "win_n", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per row of ``docs``: row, doc_id, text_hash, n_words, n_hit, n_items, items (sorted strings)."""
    windows = reliable(benchmark_windows(benchmark, window))
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect()) or [SHINGLE]
    index = reliable(prefix_index(docs, windows, sizes).withColumn(
        "block", F.abs(F.xxhash64("win"))))
    blocks = _blocks(index.count(), BLOCK_ROWS)
    start = F.col("q") - F.col("p")
    parts = []
    for b in range(blocks):
        d = _exploded(docs, sizes).alias("d")
        i = F.broadcast(index.filter(F.pmod("block", F.lit(blocks)) == b).drop("block")).alias("i")
        verified = ((F.col("d.key") == F.col("i.key")) & (start >= 0)
                    & (start + F.col("win_n") <= F.col("n"))
                    & (F.slice(F.col("ws"), F.greatest(start, F.lit(0)) + 1, F.col("win_n"))
                       == F.col("win")))
        hits = d.join(i, verified, "left")
        carrier = F.coalesce(F.col("q"), F.lit(0)) == 0 if b == 0 else F.lit(False)
        parts.append(hits.filter(F.col("win_n").isNotNull() | carrier).select(
            "row", "doc_id", "text_hash", "n", F.when(F.col("win_n").isNotNull(), F.struct(
                start.alias("a"), (start + F.col("win_n")).alias("z"))).alias("span"), "items"))
    rows = reduce(DataFrame.union, parts).groupBy("row", "doc_id", "text_hash", "n").agg(
        F.collect_set("span").alias("spans"), F.collect_set("items").alias("lists"))
    covered = F.aggregate(
        F.sort_array("spans"), F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["z"]).alias("end"),
            (acc["n"] + F.greatest(s["z"] - F.greatest(s["a"], acc["end"]), F.lit(0))).alias("n")),
        lambda acc: acc["n"])
    return rows.select("row", "doc_id", "text_hash", F.col("n").cast("bigint").alias("n_words"),
                       covered.alias("n_hit"),
                       F.array_sort(F.array_distinct(F.flatten("lists"))).alias("items")).select(
        "*", F.size("items").cast("bigint").alias("n_items"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window.

    Rows are matched by doc_id and text, so a clean row that repeats the id of a
    contaminated one stays, and a contaminated row without an id goes."""
    bad = contamination(docs, benchmark, window).filter("n_hit > 0").select(
        F.col("doc_id").alias("_benchmark_id"), F.col("text_hash").alias("_benchmark_hash")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("_benchmark_id"))
                     & (text_hash(docs["text"]) == F.col("_benchmark_hash")), "left_anti")
