"""Operator 13: token counts of whole texts, huge ones by overlap resynchronisation.

Texts of up to ``CHUNK`` characters go to the tokenizer library whole, many at a time.  A longer
one is encoded as overlapping chunks with offsets.  Two neighbouring chunks are spliced at a boundary that
both have and that is proven to be one of the whole text's, so the count is the library's for the whole text
while memory holds a few chunks.  Where an overlap holds no such boundary (a run of one
word over many pages), the chunk is encoded again from its last splice on with twice the overlap, until
one is found or the text ends.

Which boundaries are proven:

* ``.json`` files whose only pre-tokenizer is the byte-level one with its pattern and that have no normalizer: the
  start of a pre-token.  The pattern scans from left to right and never looks back, so from a common start
  on both chunks cut alike.  It looks at most two characters past a match, and a chunk's end may cut
  a special token, so the last ``look`` characters of a chunk prove nothing.
* ``.model`` files of sentencepiece that leave the text as it is, where no entry has a space after another character and none
  is matched before the others: a space after another character.  No merge crosses it, whatever stands around it.

Any other file is asked for the whole text at once.

Defined cases: null text is empty and has no tokens; special strings inside texts count as the library
counts them by default; every row of ``docs`` gives one row, also with null or repeated ids; an empty
table gives no rows.  A document is one task's work.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

CHUNK = 1 << 16         # characters between the starts of two chunks
OVERLAP = 1 << 10       # characters that two chunks share, before any widening
WAVE = 4                # chunks encoded together
BATCH_CHARS = 1 << 19   # of short texts encoded together

# A chunk's proven boundaries (characters from the text's start), the index of the token that begins
# at each, and the number of its tokens.
Chunk = tuple[np.ndarray, np.ndarray, int]


class JsonCounter:
    """Counts of a ``tokenizers`` file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        pre = spec["pre_tokenizer"] or {}
        added = spec["added_tokens"]
        self.proven = (spec["normalizer"] is None and pre.get("type") == "ByteLevel" and bool(pre.get("use_regex"))
                       and not pre.get("add_prefix_space")
                       and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added))
        self.look = max((len(t["content"]) for t in added), default=0) + 3

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def chunks(self, text: str, places: list[tuple[int, int]]) -> list[Chunk]:
        out = []
        encoded = self.tokenizer.encode_batch([text[s:e] for s, e in places], add_special_tokens=False)
        for (s, e), found in zip(places, encoded):
            words = np.array([-1 if w is None else w for w in found.word_ids], np.int64)
            starts = np.array([o[0] for o in found.offsets], np.int64) + s
            # A token without a word number (a special one) is a word of its own.
            first = np.flatnonzero((np.diff(words, prepend=-2) != 0) | (words < 0))
            if e < len(text):
                first = first[starts[first] <= e - self.look]
            out.append((starts[first], first, len(words)))
        return out


class PieceCounter:
    """Counts of a ``sentencepiece`` file."""

    _WORD = re.compile("(?<=[^ ▁])(?=[ ▁])")

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        self.pieces = SentencePieceProcessor(model_file=path)
        model = ModelProto()
        model.ParseFromString(self.pieces.serialized_model_proto())
        norm, kinds = model.normalizer_spec, ModelProto.SentencePiece
        self.proven = (norm.name == "identity" and not norm.precompiled_charsmap and norm.add_dummy_prefix
                       and not norm.remove_extra_whitespaces and norm.escape_whitespaces
                       and not model.trainer_spec.treat_whitespace_as_suffix
                       and model.trainer_spec.model_type == model.trainer_spec.BPE
                       and not any(p.type == kinds.USER_DEFINED or "▁" in p.piece.lstrip("▁") for p in model.pieces))
        self.sizes = np.array([1 if p.type == kinds.BYTE else len(p.piece.replace("▁", " ").encode())
                               for p in model.pieces], np.int64)

    def whole(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.pieces.encode(texts, num_threads=1)]

    def chunks(self, text: str, places: list[tuple[int, int]]) -> list[Chunk]:
        out = []
        parts = [text[s:e] for s, e in places]
        for (s, e), part, ids in zip(places, parts, self.pieces.encode(parts, num_threads=1)):
            ends = np.cumsum(self.sizes[np.array(ids, np.int64)])
            at = [m.start() for m in self._WORD.finditer(part)]
            ahead = part.replace("▁", " ")
            # The added space is the first byte of every chunk.
            if len(ids) and ends[-1] == 1 + len(ahead.encode()):
                places_of, last, size = [], 0, 1
                for p in at:
                    size += len(ahead[last:p].encode())
                    places_of.append(size)
                    last = p
                token = np.searchsorted(ends, places_of, "left") + 1
            else:  # bytes that do not add up prove nothing
                at, token = [], np.zeros(0, np.int64)
            first = s == 0  # the text's own start is a boundary too
            out.append((np.array([0] * first + [s + p for p in at], np.int64),
                        np.array([0] * first + list(token), np.int64), len(ids)))
        return out


def count_long(counter: JsonCounter | PieceCounter, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The tokens of ``text``, spliced from overlapping chunks."""
    total, at, wide = 0, 0, overlap  # ``at`` is where the next splice begins, proven
    carry = None                     # the start of the chunk to encode again, and how it begins
    while True:
        begin = at if carry is None else carry
        places = []
        for i in range(WAVE):
            s = begin + i * chunk
            e = min(len(text), s + chunk + wide)
            places.append((s, e))
            if e == len(text):
                break
        found = counter.chunks(text, places)
        for i, (starts, first, n) in enumerate(found):
            here = int(np.searchsorted(starts, at))
            if here == len(starts):  # a chunk shorter than what its end may change
                carry, wide = places[i][0], 2 * wide
                break
            here = int(first[here])
            if places[i][1] == len(text):
                return total + n - here
            if i + 1 == len(found):
                carry, wide = places[i][0], overlap  # the next wave begins with this chunk
                break
            common = np.intersect1d(starts, found[i + 1][0], assume_unique=True)
            common = common[common > at]
            if not len(common):
                carry, wide = places[i][0], 2 * wide
                break
            total += int(first[np.searchsorted(starts, common[0])]) - here
            at = int(common[0])


_COUNTERS: dict[str, JsonCounter | PieceCounter] = {}


def counter_of(path: str) -> JsonCounter | PieceCounter:
    """One counter per worker process and tokenizer file."""
    if path not in _COUNTERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _COUNTERS[path] = PieceCounter(path) if path.endswith(".model") else JsonCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, tokenizer: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens: one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(tokenizer)
        for batch in batches:
            texts = batch.column(2)
            counts = np.zeros(batch.num_rows, np.int64)
            held: list[tuple[int, str]] = []
            chars = 0
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                if len(text) > chunk and counter.proven:
                    counts[i] = count_long(counter, text, chunk, overlap)
                elif text:
                    held.append((i, text))
                    chars += len(text)
                if held and (chars >= BATCH_CHARS or i + 1 == batch.num_rows):
                    counts[[k for k, _ in held]] = counter.whole([t for _, t in held])
                    held, chars = [], 0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts)],
                                             ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.octet_length(text).cast("bigint").alias("n_bytes"),
                       text.alias("text")).mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
