"""Longest-match encoding and the stored prefix index, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from callsmith.operators import index_store, longest
from callsmith.operators.prefix import allowed_next, allowed_next_for


def brute(text, vocabulary):
    ids = []
    while text:
        best = max((t for t in vocabulary if text.startswith(t)), key=len, default=None)
        ids.append(-1 - ord(text[0]) if best is None else vocabulary[best])
        text = text[len(best or " "):]
    return ids


VOCABULARY = {"a": 0, "ab": 1, "abcd": 2, "bc": 3, " ": 4, " the": 5, "é": 6, "éa": 7, "\U0001F600x": 8, "d": 2 ** 40}


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    texts = [None, "", "abcabcd", " the then", "\U0001F600", "\U0001F600x\U0001F600", "q" * 3000, "abcd" * 5000]
    texts += ["".join(rng.choice(["a", "b", "c", "d", " ", " the", "é", "\U0001F600", "x", "\n"]) for _ in range(rng.randint(1, 40)))
              for _ in range(120)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(2, "abcabcd", "again"), (2, "other text", ""), (None, "abc", "")]
    vocab = [(t, i) for t, i in VOCABULARY.items()] + [("", 99), (None, 98), ("ab", 50), ("zz", -5)]
    return (spark.createDataFrame(rows, "id bigint, text string, ids string").repartition(3),
            spark.createDataFrame(vocab, "token string, token_id bigint"), rows)


@pytest.mark.parametrize("form", ["auto", "join"])
def test_longest_match(tables, form):
    texts, vocab, rows = tables
    enc = longest.encode_longest(texts.drop("ids"), vocab, "id", form=form)
    got = sorted(((r.id is None, r.id or 0, r.ids) for r in enc.collect()), key=repr)
    want = sorted(((i is None, i or 0, None if t is None else brute(t, VOCABULARY)) for i, t, _ in rows), key=repr)
    assert got == want
    dec = longest.decode_longest(enc, vocab, "id", form=form)
    assert sorted(((r.id, r.text) for r in dec.collect()), key=repr) == sorted(((i, t) for i, t, _ in rows), key=repr)


@pytest.mark.parametrize("form", ["auto", "join"])
def test_longest_match_empty(tables, form):
    texts, vocab, _ = tables
    assert longest.encode_longest(texts.limit(0), vocab, "id", form=form).count() == 0
    one = longest.encode_longest(texts.filter("id = 3"), vocab.limit(0), "id", form=form).first()
    assert one.ids == [-1 - ord(c) for c in " the then"] and one.n_unknown == one.n_tokens == 9


def test_large_vocabulary_joins(tables, monkeypatch):
    texts, vocab, _ = tables
    want = sorted(longest.encode_longest(texts, vocab, "id").collect(), key=repr)
    monkeypatch.setattr(longest, "MAX_VOCABULARY_CHARS", 5)
    assert sorted(longest.encode_longest(texts, vocab, "id").collect(), key=repr) == want


def test_stored_index_equals_rebuild(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, [rng.choice("abc") for _ in range(rng.randint(0, 6))]) for i in range(200)] + [(200, None)]
    seqs = spark.createDataFrame(rows, "seq_id bigint, tokens array<string>")
    path = str(tmp_path / "index")
    for k in (2, 0, 1, 0):  # one batch written twice replaces itself
        index_store.append_batch(seqs.filter(F.col("seq_id") % 3 == k), path, f"b{k}")
    want = sorted(map(tuple, allowed_next(seqs).collect()))
    assert sorted(map(tuple, index_store.stored_allowed_next(spark, path).collect())) == want
    index_store.compact(spark, path, str(tmp_path / "one"))
    assert sorted(map(tuple, index_store.stored_allowed_next(spark, str(tmp_path / "one")).collect())) == want
    prefixes = spark.createDataFrame([(1, []), (2, ["a"]), (3, ["a", "b", "c"]), (4, ["z"])], "req_id int, prefix array<string>")
    assert sorted(index_store.stored_allowed_next_for(prefixes, path).collect()) == sorted(
        allowed_next_for(prefixes, seqs).collect())
    with pytest.raises(ValueError):
        index_store.append_batch(seqs, path, "a/b")
