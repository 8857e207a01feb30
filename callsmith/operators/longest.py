"""Longest-match encoding (X3): a text is cut from left to right, each time into the longest vocabulary
entry that starts there, so tokens need not be white-space words and any text can be encoded.

A code point that no entry begins is its own token with the id ``-1 - code point``; vocabulary ids are 0 or
more, so decoding gives back the text exactly.  A repeated entry has its lowest id; null and empty entries take no part.

A vocabulary of up to ``MAX_VOCABULARY_CHARS`` characters is shipped to every task and the texts are
encoded in one Arrow pass, without a shuffle.  A larger one stays a table: the pieces of each text that are as long as an
entry with the same first character are joined to it, and the text is then cut with the entries found for it
alone.  Results are the same.  What the driver sees there is one list of lengths a first character.

Defined cases: a null text is null again when decoded and has no tokens, as an empty one; repeated rows repeat, and
rows of one id with different texts are encoded each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_VOCABULARY_CHARS = 1 << 24
_PIECE_ROWS = 50_000
_IDS = pa.list_(pa.int64())


def _entries(table: DataFrame) -> DataFrame:
    return (table.select(F.col("token").cast("string").alias("token"), F.col("token_id").cast("bigint").alias("token_id"))
            .filter("length(token) > 0 and token_id >= 0").groupBy("token").agg(F.min("token_id").alias("token_id")))


def _lengths(tokens) -> dict[str, list[int]]:
    """The lengths of the tokens by first character, longest first."""
    found: dict[str, set[int]] = {}
    for token in tokens:
        found.setdefault(token[0], set()).add(len(token))
    return {c: sorted(sizes, reverse=True) for c, sizes in found.items()}


def longest_ids(text: str, vocabulary: dict[str, int], lengths: dict[str, list[int]]) -> list[int]:
    ids, at = [], 0
    while at < len(text):
        for size in lengths.get(text[at], ()):
            piece = text[at:at + size]
            if piece in vocabulary:
                ids.append(vocabulary[piece])
                at += len(piece)
                break
        else:
            ids.append(-1 - ord(text[at]))
            at += 1
    return ids


def _small(entries: DataFrame) -> dict[str, int] | None:
    """The vocabulary as a dictionary, or None beyond the bound."""
    size = entries.agg(F.sum(F.length("token"))).first()[0] or 0
    if size > MAX_VOCABULARY_CHARS:
        return None
    return {r["token"]: r["token_id"] for r in entries.collect()}


def _counts(df: DataFrame, id_col: str) -> DataFrame:
    return df.select(id_col, F.size("ids").cast("bigint").alias("n_tokens"),
                     F.size(F.filter("ids", lambda i: i < 0)).cast("bigint").alias("n_unknown"), "ids")


def encode_longest(texts: DataFrame, table: DataFrame, id_col: str, text_col: str = "text",
                   form: str = "auto") -> DataFrame:
    """X3 encode: ``(id, n_tokens, n_unknown, ids ARRAY<BIGINT>)``, one row a row of ``texts``; ``table`` has
    ``token, token_id``.  ``form="join"`` joins whatever the vocabulary's size."""
    entries = _entries(table)
    rows = texts.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema[id_col], T.StructField("ids", T.ArrayType(T.LongType()))])
    vocabulary = None if form == "join" else _small(entries)
    if vocabulary is not None:
        lengths = _lengths(vocabulary)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids = [None if t is None else longest_ids(t, vocabulary, lengths) for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, _IDS)], schema.names)

        return _counts(rows.mapInArrow(run, schema), id_col)
    return _counts(_encode_by_join(rows, entries, id_col, schema), id_col)


def _encode_by_join(rows: DataFrame, entries: DataFrame, id_col: str, schema: T.StructType) -> DataFrame:
    sizes = {r["c"]: sorted(r["sizes"], reverse=True) for r in entries.groupBy(
        F.substring("token", 1, 1).alias("c")).agg(F.collect_set(F.length("token")).alias("sizes")).collect()}
    piece_schema = T.StructType([T.StructField("of", rows.schema[id_col].dataType), T.StructField("piece", T.StringType())])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The distinct pieces of each text that may be entries, a bounded number a batch."""
        for b in batches:
            for i, text in enumerate(b.column(1).to_pylist()):
                own = {text[at:at + size] for at, c in enumerate(text or "") for size in sizes.get(c, ())
                       if at + size <= len(text)}
                listed = list(own)
                for k in range(0, len(listed), _PIECE_ROWS):
                    part = listed[k:k + _PIECE_ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.concat_arrays([b.column(0).slice(i, 1)] * len(part)), pa.array(part, pa.string())], ["of", "piece"])

    known = (rows.mapInArrow(pieces, piece_schema).join(entries, F.col("piece") == F.col("token"))
             .groupBy("of").agg(F.collect_set(F.struct("token", "token_id")).alias("own")))
    own = rows.join(known, rows[id_col].eqNullSafe(F.col("of")), "left").select(
        id_col, "text", F.col("own.token").alias("tokens"), F.col("own.token_id").alias("numbers"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = []
            for i in range(b.num_rows):
                text, tokens, numbers = (b.column(k)[i].as_py() for k in (1, 2, 3))
                ids.append(None if text is None else longest_ids(
                    text, dict(zip(tokens or (), numbers or ())), _lengths(tokens or ())))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, _IDS)], schema.names)

    return own.mapInArrow(cut, schema)


def _code_point(number: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def decode_longest(seqs: DataFrame, table: DataFrame, id_col: str, ids_col: str = "ids", form: str = "auto") -> DataFrame:
    """X3 decode: ``(id, text)``, one row a row of ``seqs``.  An id that the table lacks gives nothing; an id with
    several tokens the first in binary order."""
    inverse = _entries(table).groupBy("token_id").agg(F.min("token").alias("token"))
    rows = seqs.select(F.col(id_col), F.col(ids_col).cast("array<bigint>").alias("ids"))
    vocabulary = None if form == "join" else _small(inverse)
    if vocabulary is not None:
        tokens = {number: token for token, number in vocabulary.items()}
        schema = T.StructType([rows.schema[id_col], T.StructField("text", T.StringType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts = [None if ids is None else "".join(
                    tokens.get(i, "") if i >= 0 else chr(-1 - i) for i in ids if i is not None) for ids in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], schema.names)

        return rows.mapInArrow(run, schema)
    # Equal id lists have equal texts, so a list is its own key: its distinct ids are looked up, each once.
    wanted = rows.filter("ids is not null").select("ids").distinct()
    numbers = wanted.select("ids", F.explode(F.array_distinct(F.filter("ids", lambda i: i >= 0))).alias("number"))
    found = numbers.join(inverse, F.col("number") == F.col("token_id")).groupBy(F.col("ids").alias("of")).agg(
        F.map_from_entries(F.collect_list(F.struct("token_id", "token"))).alias("own"))
    text = F.array_join(F.transform("ids", lambda i: F.when(i < 0, _code_point(-1 - i)).otherwise(
        F.coalesce(F.element_at("own", i), F.lit("")))), "")
    return rows.join(found, F.col("ids") == F.col("of"), "left").select(id_col, text.alias("text"))
