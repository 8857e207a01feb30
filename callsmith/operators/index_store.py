"""A stored prefix index that grows by batches of sequences.

The index holds a trie by cuts (``cut_edges``): an edge from one place of 0, 1, 2, 4, … tokens to the next carries the
whole run of tokens between them.  Such edges combine: the counts of an edge add up and its name is the least of its
names.  So the index of several batches of sequences needs no rebuild.  A batch is written as the
edges of its own sequences alone, under its name, and the batches are combined by aggregates over the edges' keys
when they are read (nodes are named then, as another batch may hold a lesser id); runs of tokens are joined to
them by the name.  Written again after a failure, a batch replaces itself.  ``compact`` rewrites all batches as one
in a new folder.

Sequence ids must differ between batches.  Null and empty sequences have no edges.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsmith.operators.prefix import CUT, _cut_start, cut_edges, cut_key, id_key, token_edges, with_shared


def append_batch(seqs: DataFrame, path: str, batch: str, id_col: str = "seq_id", tokens_col="tokens") -> None:
    """Add the sequences to the index at ``path`` as ``batch`` (letters, digits, - and _)."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
        raise ValueError(f"not a batch name: {batch!r}")
    cut_edges(seqs, id_col, tokens_col).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(f"{path}/batch=*").drop("batch")


def stored_edges(spark: SparkSession, path: str) -> DataFrame:
    """The combined edges, with ``shared``: whether another edge leaves the same node."""
    stored = _stored(spark, path)
    keys = with_shared(stored.groupBy(*CUT).agg(F.sum("n_seqs").alias("n_seqs"), F.min("child_seq").alias("child_seq")))
    runs = stored.select(id_key(F.col("child_seq")).alias("id_key"), *CUT, "run")
    return runs.join(keys.withColumn("id_key", id_key(F.col("child_seq"))), ["id_key", *CUT]).select(
        "child_seq", "id_key", *CUT, "n_seqs", "shared", "run")


def stored_allowed_next(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``allowed_next`` over the sequences of all batches."""
    return token_edges(stored_edges(spark, path))


def stored_allowed_next_for(prefixes: DataFrame, path: str, key: str = "req_id", prefix_col: str = "prefix") -> DataFrame:
    """``(key, next_token)``, the tokens permitted after each generated prefix; the prefixes' keys are joined to
    the batches' edges, which are not combined first."""
    prefix = F.col(prefix_col)
    size = F.size(prefix)
    start = _cut_start(size)
    h1, h2 = cut_key(prefix, start)
    wanted = prefixes.filter(prefix.isNotNull()).select(
        F.col(key), start.alias("at"), h1.alias("at1"), h2.alias("at2"), (size - start).alias("past"),
        F.slice(prefix, start + 1, size - start).alias("rest"))
    met = wanted.join(_stored(prefixes.sparkSession, path), (F.col("at") == F.col("n")) & (F.col("at1") == F.col("h1"))
                      & (F.col("at2") == F.col("h2")))
    return met.filter(F.slice("run", F.lit(1), F.col("past")) == F.col("rest")).select(
        key, F.get("run", F.col("past")).alias("next_token")).filter(F.col("next_token").isNotNull()).distinct()


def compact(spark: SparkSession, path: str, to: str) -> None:
    """Write all batches of ``path`` as the one batch ``all`` of a new index."""
    stored_edges(spark, path).drop("shared", "id_key").write.parquet(f"{to}/batch=all")
