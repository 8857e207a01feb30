"""Token tables (S10, F18, F19, A11-A14, X3): normalise, invert, encode, decode.

A token table is ``(ord, token, token_id)``; ``ord`` is the entry's position
in its source (later entries win on key collisions, as a dict built in
order would).  Encoding is word-level: a text's tokens are equi-joined to the
table and re-assembled in position order per text.  Sub-word BPE is not built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsmith import fixed
from callsmith.operators.prefix import word_tokens


class EmptyTokenTable(ValueError):
    pass


def normalize_token(token: Column) -> Column:
    """the replacement chain, applied in its fixed order (an earlier
    replacement can create a later key)."""
    out = token
    for special, repl in fixed.TOKEN_REPLACEMENTS:
        out = F.replace(out, F.lit(special), F.lit(repl))
    return out


def normalize_token_table(tokens: DataFrame, check_empty: bool = False) -> DataFrame:
    """``(token, token_id, n_raw, ord)`` keyed by normalised token, last entry wins."""
    if check_empty and tokens.limit(1).count() == 0:
        raise EmptyTokenTable("the token table has no entries")
    return (tokens.select(normalize_token(F.col("token")).alias("token"), "token_id", "ord")
            .groupBy("token")
            .agg(F.max_by("token_id", "ord").alias("token_id"), F.count(F.lit(1)).alias("n_raw"),
                 F.max("ord").alias("ord")))


def invert_token_table(pairs: DataFrame, key_col: str = "key", value_col: str = "value",
                       ord_col: str = "ord") -> DataFrame:
    """Id-keyed entries → ``(token_id, token)``; keys that are not integers are
    skipped, the last entry per id wins."""
    k = F.trim(F.col(key_col)).try_cast("bigint")
    return (pairs.select(k.alias("token_id"), F.col(value_col).cast("string").alias("token"),
                         F.col(ord_col).alias("ord"))
            .filter(F.col("token_id").isNotNull())
            .groupBy("token_id").agg(F.max_by("token", "ord").alias("token")))


def token_table_report(table: DataFrame) -> DataFrame:
    """Number of distinct tokens."""
    return table.agg(F.count_distinct("token").alias("n_tokens"))


def load_token_table(spark, path: str) -> DataFrame:
    """A JSON object file ``{token: id}`` (or ``{id: token}``) → ``(ord, token, token_id)``.

    The orientation is sniffed from the first key, as the reference does.
    Each file is one object, so one file is read by one task.  A file that
    holds no entry (or no JSON object) raises ``EmptyTokenTable``.
    """
    raw = spark.read.text(path, wholetext=True)
    entries = raw.select(F.posexplode(F.map_entries(
        F.from_json("value", "map<string,string>"))).alias("ord", "e"))
    first = entries.filter(F.col("ord") == 0).select(
        F.col("e.key").try_cast("bigint").isNotNull().alias("by_id")).first()
    if first is None:
        raise EmptyTokenTable(f"no token entries in {path}")
    by_id = bool(first["by_id"])
    if by_id:
        return entries.select("ord", F.col("e.value").alias("token"),
                              F.col("e.key").try_cast("bigint").alias("token_id")) \
                      .filter(F.col("token_id").isNotNull())
    return entries.select("ord", F.col("e.key").alias("token"),
                          F.col("e.value").try_cast("bigint").alias("token_id")) \
                  .filter(F.col("token_id").isNotNull())


def encode_with_table(texts: DataFrame, table: DataFrame, id_col: str, text_col: str = "text",
                      lead_space: bool = True, unknown_id: int = -1) -> DataFrame:
    """X3 encode: ``(id, n_tokens, n_unknown, ids ARRAY<BIGINT>)`` in text order.

    With ``lead_space`` every token after the first is looked up with a
    leading space (the convention of space-marker vocabularies).  The lookup
    is an inner join, so AQE can broadcast whichever side is small (usually
    the texts, not the vocabulary); unknown positions are filled afterwards.
    """
    sized = texts.select(F.col(id_col).alias("_id"), F.size(word_tokens(F.col(text_col))).alias("n"))
    toks = (texts.select(F.col(id_col).alias("_id"), F.posexplode_outer(word_tokens(F.col(text_col)))
                         .alias("pos", "w"))
            .filter(F.col("w").isNotNull()))
    key = F.when((F.col("pos") > 0) & F.lit(lead_space), F.concat(F.lit(" "), "w")).otherwise(F.col("w"))
    known = (toks.select("_id", "pos", key.alias("token"))
             .join(table.select("token", F.col("token_id").cast("bigint").alias("token_id")), "token")
             .groupBy("_id").agg(F.map_from_entries(F.collect_list(F.struct("pos", "token_id"))).alias("m"),
                                 F.count(F.lit(1)).alias("n_known")))
    joined = sized.join(known, "_id", "left")
    positions = F.when(F.col("n") > 0, F.sequence(F.lit(0), F.col("n") - 1)).otherwise(
        F.array().cast("array<int>"))
    ids = F.transform(positions, lambda p: F.coalesce(F.element_at(F.col("m"), p),
                                                       F.lit(unknown_id)).cast("bigint"))
    return joined.select(F.col("_id").alias(id_col), F.col("n").cast("bigint").alias("n_tokens"),
                         (F.col("n") - F.coalesce("n_known", F.lit(0))).cast("bigint").alias("n_unknown"),
                         ids.alias("ids"))


def decode_with_table(seqs: DataFrame, inverse: DataFrame, id_col: str, ids_col: str = "ids") -> DataFrame:
    """X3 decode: ids → text, tokens joined in order; unknown ids decode to ''."""
    toks = (seqs.select(F.col(id_col).alias("_id"), F.posexplode_outer(ids_col).alias("pos", "token_id"))
            .filter(F.col("token_id").isNotNull()))
    looked = toks.join(inverse.select("token_id", "token"), "token_id", "left")
    return (looked.groupBy("_id")
            .agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("token", F.lit(""))
                                                      .alias("t")))).alias("seq"))
            .select(F.col("_id").alias(id_col), F.array_join(F.col("seq.t"), "").alias("text")))
