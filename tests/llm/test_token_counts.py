"""Operator 13 against the libraries on whole texts."""

import random

import pytest

from callsmith.llm import token_counts
from callsmith.llm.queries import op13_token_counts, tokenizer_file
from conftest import SMALL

JSON, MODEL, WORDS = (tokenizer_file(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))


def library(path, text):
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor
        return len(SentencePieceProcessor(model_file=path).encode(text))
    from tokenizers import Tokenizer
    return len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)


def odd_texts():
    rng = random.Random(13)
    bits = ["the ", "word", " ", "  ", "\n", "\n \n", "\t", "12", "3", "'", "'ll", "'re", "don't", "!?", "...", "é", "中文", "😀",
            "<|endoftext|>", "<|endof", "text|>", "　", "x" * 40, " " * 30, "▁", "\x00", "\x1c", "ﬁ", "Ä"]
    texts = ["".join(rng.choices(bits, k=k)) for k in (50, 80, 120, 200, 300) for _ in range(30)]
    return texts + ["a" * 700, " " * 500, "ab " * 300, "<|endoftext|>" * 60, "'ll" * 200, " <|endoftext|> " * 50,
                    "word " * 5 + "z" * 400 + " word" * 60, "中" * 300, "\n" * 200 + "x", " " * 64 + "<|endoftext|>" * 9]


@pytest.mark.parametrize("path", [JSON, MODEL])
def test_spliced_counts_equal_the_library(path):
    counter = token_counts.counter_of(path)
    assert counter.proven
    for text in odd_texts():
        want = library_counts(counter, text)
        for chunk, overlap in ((32, 4), (37, 1), (64, 32), (7, 3)):
            if len(text) > chunk:
                assert token_counts.count_long(counter, text, chunk, overlap) == want, (text, chunk, overlap)


def library_counts(counter, text):
    return counter.whole([text])[0]


def test_overlap_is_widened_until_chunks_align():
    counter = token_counts.counter_of(JSON)
    text = "start " + "q" * 5000 + " end of it " * 20
    seen = []
    chunks = counter.chunks
    counter.chunks = lambda t, places: seen.extend(places) or chunks(t, places)
    try:
        assert token_counts.count_long(counter, text, 100, 10) == library(JSON, text)
    finally:
        del counter.chunks
    sizes = {e - s for s, e in seen}
    assert max(sizes) > 5000 > min(sizes) and len(sizes) > 3


def test_other_files_are_asked_for_the_whole_text(spark):
    assert not token_counts.counter_of(WORDS).proven
    text = "Some Words é and more " * 50
    frame = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert token_counts.count_tokens(frame, WORDS, 100, 10).first().n_tokens == library(WORDS, text)


def test_counts_of_odd_rows(spark):
    long = " ".join(f"word{i % 991}," for i in range(60_000))
    rows = [(1, None), (2, ""), (3, "one"), (3, "one"), (None, "two three"), (4, long), (5, "<|endoftext|>x"),
            (6, "y" * 200_000)]
    frame = spark.createDataFrame([(*r, 7, "b") for r in rows], "doc_id bigint, text string, n_tokens int, n_bytes string")
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(frame, JSON).collect())
    want = sorted((str(i), len((t or "").encode()), library(JSON, t or "")) for i, t in rows)
    assert got == want
    assert token_counts.count_tokens(frame.limit(0), JSON).count() == 0
    pieces = token_counts.count_tokens(frame.filter("doc_id = 4"), MODEL).first()
    assert pieces.n_tokens == library(MODEL, long)


def test_counts_of_the_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(JSON)
    for r in op13_token_counts(spark, SMALL).collect():
        want = len(lib.encode(docs[r.doc_id] or "", add_special_tokens=False).ids)
        assert (r.n_tokens, r.over_limit) == (want, want > 512)
