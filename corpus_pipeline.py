"""Corpus pipeline over ``documents``: language ID, near-duplicates, benchmark
decontamination, personal data, packing.

Each stage takes all that its predecessor kept; the first four return the columns of
``documents``, packing returns its pieces.  Stages are run by ``run`` (or
by the caller) through Parquet: a stage's output is written to the shared folder
and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from callsmith.llm import decontaminate, langid, packing, pii, simhash
from callsmith.llm.common import shared_path
from callsmith.llm.queries import tokenizer_file
from callsmith.session import table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the language ID rejects go."""
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))
    return langid.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one document of each group stays."""
    return simhash.keep_one(docs, shingle=3, distance=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents with a benchmark window go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"), window=10)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: found spans are replaced by their kind; all documents stay."""
    return pii.redact(docs, pii.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: the pieces of all documents in windows of at most 2048 ids."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("personal_data", personal_data), ("packed", packed)]

# SQL has neither the classifiers nor the tokenizer: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
