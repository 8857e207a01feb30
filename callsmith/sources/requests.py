"""Request sources (S9, P16): any DataFrame with a text column is a request table.

The builders here turn the driver's tables into request tables with the same
``concat`` templates the DuckDB oracle uses, so both sides see equal text.
Doubles are cast to int (or a fixed decimal) before formatting so the text
does not depend on an engine's float printing.  ``key % n`` only picks which
template a row gets; every row of every table is used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callsmith.session import ensure_parallelism, table


def s(x) -> Column:
    return (x if isinstance(x, Column) else F.col(x)).cast("string")


def lit(text: str) -> Column:
    return F.lit(text)


def int_text(x) -> Column:
    return (x if isinstance(x, Column) else F.col(x)).cast("int").cast("string")


def dec_text(x) -> Column:
    return (x if isinstance(x, Column) else F.col(x)).cast("decimal(12,2)").cast("string")


def sum_prompt(a, b) -> Column:
    return F.concat(lit("What is the sum of "), int_text(a), lit(" and "), s(b), lit("?"))


def lineitem_sum_requests(lineitem: DataFrame) -> DataFrame:
    return lineitem.select("l_orderkey", "l_linenumber",
                           sum_prompt("l_quantity", "l_linenumber").alias("prompt"))


def part_prompt() -> Column:
    """Five string templates over part, chosen by ``p_partkey % 5``."""
    first_word = F.split_part(F.col("p_name"), lit(" "), lit(1))
    k = F.col("p_partkey") % 5
    return (F.when(k == 0, F.concat(lit("Reverse the string '"), s("p_name"), lit("'")))
            .when(k == 1, F.concat(lit("Replace all vowels in '"), s("p_name"), lit("' with asterisks")))
            .when(k == 2, F.concat(lit("Concatenate '"), s("p_name"), lit("' and '"), s("p_brand"),
                                   lit("'")))
            .when(k == 3, F.concat(lit("Is "), s("p_size"), lit(" an even number?")))
            .otherwise(F.concat(lit("Substitute the word '"), first_word, lit("' with '"),
                                s("p_type"), lit("' in '"), s("p_name"), lit("'"))))


def substitute_prompt() -> Column:
    """Five substitution phrasings over part, chosen by ``p_partkey % 5``."""
    first_word = F.split_part(F.col("p_name"), lit(" "), lit(1))
    k = F.col("p_partkey") % 5
    return (F.when(k == 0, F.concat(lit("Replace all vowels in '"), s("p_name"),
                                    lit("' with asterisks")))
            .when(k == 1, F.concat(lit("Substitute the word '"), first_word, lit("' with '"),
                                   s("p_brand"), lit("' in '"), s("p_name"), lit("'")))
            .when(k == 2, F.concat(lit("Replace consonants in '"), s("p_name"),
                                   lit("' with underscores")))
            .when(k == 3, F.concat(lit("Substitute spaces in '"), s("p_name"), lit("' with nothing")))
            .otherwise(F.concat(lit("Substitute the digits in the string '"), s("p_type"), lit(" "),
                                s("p_size"), lit("' with '"), s("p_brand"), lit("'"))))


def pair_prompt() -> Column:
    """Verb form, bare pair form and fallback form, chosen by ``p_partkey % 3``."""
    k = F.col("p_partkey") % 3
    return (F.when(k == 0, F.concat(lit("Concatenate '"), s("p_name"), lit("' and '"), s("p_brand"),
                                    lit("'")))
            .when(k == 1, F.concat(lit("Please put '"), s("p_name"), lit("' with '"), s("p_type"),
                                   lit("' together")))
            .otherwise(F.concat(lit("Glue '"), s("p_brand"), lit("' onto '"), s("p_name"), lit("'"))))


def row_identity() -> list[Column]:
    """Exact, recomputation-stable identity of a scanned parquet row: (file id, row index)."""
    return [F.xxhash64(F.col("_metadata.file_path")).alias("file_id"),
            F.col("_metadata.row_index").alias("row_index")]


def mixed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, key, prompt, file_id, row_index)`` over seven tables.

    ``key`` is the table's key (lineitem's ``(orderkey, linenumber)`` repeats in
    the test data); ``(src, file_id, row_index)`` identifies a row exactly.
    """
    def t(name):
        # Each source is checked for parallelism on its own: a union of
        # enough partitions can still hold one huge single-split source.
        df = table(spark, sf_dir, name)
        return ensure_parallelism(df.select("*", *row_identity()))
    parts = [
        t("lineitem").select(lit("lineitem").alias("src"),
                             (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("key"),
                             sum_prompt("l_quantity", "l_linenumber").alias("prompt"), "file_id", "row_index"),
        t("orders").select(lit("orders").alias("src"), F.col("o_orderkey").cast("bigint").alias("key"),
                           F.concat(lit("Find the max of "), s(F.col("o_custkey") % 10), lit(" and "),
                                    s(F.col("o_orderkey") % 10)).alias("prompt"), "file_id", "row_index"),
        t("part").select(lit("part").alias("src"), F.col("p_partkey").cast("bigint").alias("key"),
                         part_prompt().alias("prompt"), "file_id", "row_index"),
        t("nation").select(lit("nation").alias("src"), F.col("n_nationkey").cast("bigint").alias("key"),
                           F.concat(lit("Greet "), s("n_name")).alias("prompt"), "file_id", "row_index"),
        t("customer").select(lit("customer").alias("src"), F.col("c_custkey").cast("bigint").alias("key"),
                             F.concat(lit("Greet "), s("c_name")).alias("prompt"), "file_id", "row_index"),
        t("supplier").select(lit("supplier").alias("src"), F.col("s_suppkey").cast("bigint").alias("key"),
                             F.concat(lit("What is the absolute value of "),
                                      dec_text("s_acctbal")).alias("prompt"), "file_id", "row_index"),
        t("conversations").select(lit("conversations").alias("src"),
                                  (F.col("conv_id") * 1000 + F.col("turn")).cast("bigint").alias("key"),
                                  F.col("text").alias("prompt"), "file_id", "row_index"),
    ]
    return reduce(DataFrame.unionByName, parts)
