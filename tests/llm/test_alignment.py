"""Operator 12 against both libraries and plain loops over bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from callsmith.llm import alignment
from callsmith.llm.queries import op12_alignment, tokenizer_file
from conftest import SMALL

A_FILE, B_FILE = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer, pre_tokenizers

    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=B_FILE)
    return a, b, pre_tokenizers.ByteLevel.alphabet()


def spans(parts):
    out, at = [], 0
    for i, raw in parts:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain(libraries, rows):
    """The contract by loops: byte ranges, groups where both end, overlapping pairs."""
    a_lib, b_lib, _ = libraries
    byte_of = {letter: b for b, letter in alignment.byte_letters().items()}
    docs, counts = [], Counter()
    for doc_id, text in rows:
        found = (doc_id, 0, 0, 0, [], "")
        if text:
            raw = (" " + text).encode()
            a = [(i, bytes(byte_of[c] for c in a_lib.id_to_token(i)))
                 for i in a_lib.encode(" " + text, add_special_tokens=False).ids]
            b = []
            for i in b_lib.encode(text):
                p = b_lib.id_to_piece(i)
                b.append((i, bytes([int(p[3:-1], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()))
            if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b):
                a, b = spans(a), spans(b)
                cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
                said, at = [], 0
                for cut in cuts:
                    said.append(",".join(str(i) for i, s, e in a if at <= s and e <= cut) + "|"
                                + ",".join(str(i) for i, s, e in b if at <= s and e <= cut))
                    at = cut
                links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
                found = (doc_id, len(a), len(b), len(cuts), links,
                         hashlib.sha256(";".join(said).encode()).hexdigest())
                counts.update(links)
        docs.append(found)
    highest = {}
    for (_, j), n in counts.items():
        highest[j] = max(n, highest.get(j, 0))
    return [(d, na, nb, ng, len(links), sum(counts[p] == highest[p[1]] for p in links),
             sum(counts[p] for p in links), sha) for d, na, nb, ng, links, sha in docs]


ODD = [None, "", " ", "\n", "  two  spaces\n\n", "a▁b", "<s> </s> <unk> <0x0A>", "<|endoftext|>", "Zürich 中文 \U0001f600",
       "\x00\x01\x1c", "don't I'll", "x" * 500, "é ﬁ 　  ", "the the the the"]


def test_alignment_against_plain_loops(spark, libraries):
    rng = random.Random(12)
    words = ["the", "of", "and", "straße", "naïve", "12,345", "foo_bar", "(x)", "tokenizers", "\n", "😀", "Ünï"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(60)]
    rows += [(100 + i, t) for i, t in enumerate(ODD)] + [(3, rows[3][1]), (3, "other"), (None, rows[4][1])]
    frame = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows],
                                  "doc_id bigint, text string, block int, pairs string, n_links int").repartition(3)
    got = [tuple(r) for r in alignment.align_documents(frame, A_FILE, B_FILE).collect()]
    assert sorted(got, key=str) == sorted(plain(libraries, rows), key=str)


def test_small_blocks_and_batches_give_the_same(spark, libraries, monkeypatch):
    rows = [(i, f"some text number {i % 7} of many, {'word ' * (i % 5)}") for i in range(50)]
    aligner = alignment.Aligner(A_FILE, B_FILE)
    counts, digests, pairs = aligner.align([t for _, t in rows])
    parts = [aligner.align([t]) for _, t in rows]
    assert (counts == np.concatenate([p[0] for p in parts], axis=1)).all()
    assert digests == [p[1][0] for p in parts] and pairs.tolist() == np.concatenate([p[2] for p in parts]).tolist()
    places = np.array([0, 70_000, 3])
    for some in (places, places[:1], places[:0]):
        assert alignment._wide(alignment._narrow(some)).tolist() == some.tolist()


def test_ids_of_many_texts_are_looked_up_together(libraries, monkeypatch):
    texts = [f"some text, number {i % 7}\nof many. {'word ' * (i % 5)}end" for i in range(40)] + [None, "", "a▁b", "end"]
    aligner = alignment.Aligner(A_FILE, B_FILE)
    want = [libraries[0].encode(" " + (t or ""), add_special_tokens=False).ids for t in texts]
    alone = aligner.align(texts)
    monkeypatch.setattr(aligner.encoder, "packed", lambda text: pytest.fail(text) if text.strip() else b"")
    ids = aligner.ids_a(texts[:40] + texts[42:])
    assert [a.tolist() for a in ids] == want[:40] + want[42:]
    monkeypatch.undo()
    at, parts, ids = 0, [], aligner.ids_a(texts)
    while at < len(texts):
        some = alignment._first(texts, at, 100)
        assert 0 < len(some) < 10
        parts.append(aligner.align(some, ids[at:at + len(some)]))
        at += len(some)
    assert (alone[0] == np.concatenate([p[0] for p in parts], axis=1)).all()
    assert alone[1] == [d for p in parts for d in p[1]]
    assert alone[2].tolist() == np.concatenate([p[2] for p in parts]).tolist()
    for links in (alone[2], alone[2][:0]):
        for got, plain_one in zip(alignment._distinct(links), np.unique(links, return_inverse=True, return_counts=True)):
            assert got.tolist() == plain_one.tolist()


def test_long_text_and_empty_table(spark, libraries):
    text = " ".join(f"w{i % 977}" for i in range(60_000))
    schema = "doc_id bigint, text string"
    got = alignment.align_documents(spark.createDataFrame([(1, text), (2, None)], schema), A_FILE, B_FILE).collect()
    long = {r.doc_id: r for r in got}[1]
    assert long.n_a == len(libraries[0].encode(" " + text, add_special_tokens=False).ids)
    assert long.n_b == len(libraries[1].encode(text)) and long.n_links >= max(long.n_a, long.n_b)
    assert alignment.align_documents(spark.createDataFrame([], schema), A_FILE, B_FILE).count() == 0


def test_alignment_of_the_table(spark, libraries):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    short = [(r.doc_id, r.text) for r in docs]
    got = {r.doc_id: r for r in op12_alignment(spark, SMALL).collect()}
    assert sorted(got) == sorted(d for d, _ in short)
    a_lib, b_lib, _ = libraries
    for doc_id, text in short:
        if got[doc_id].n_a:
            assert got[doc_id].n_a == len(a_lib.encode(" " + text, add_special_tokens=False).ids)
            assert got[doc_id].n_b == len(b_lib.encode(text))
    assert sum(r.n_a > 0 for r in got.values()) > 0.95 * len(got)


def test_known_runs_take_few_bytes_and_equal_hashes_are_told_apart(monkeypatch):
    import gc
    import tracemalloc
    from callsmith.llm import tokenizing
    enc = tokenizing.TextEncoder(A_FILE, False)
    enc.batch(["start"])
    tracemalloc.start()
    enc.batch([" ".join(f"q{i}xz" for i in range(30_000))], space=True)
    gc.collect()
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(enc.young) > 30_000 and held / 30_000 < 100
    monkeypatch.setattr(tokenizing, "_BYTE_KEYS", np.zeros(256, np.uint64))
    enc = tokenizing.TextEncoder(A_FILE, False)
    for text in ("one two three", "two four one", "four five, two two"):
        assert enc.batch([text], space=True)[0].tolist() == enc.tokenizer.encode(" " + text, add_special_tokens=False).ids


def test_many_blocks_of_a_task_are_many_row_groups(spark, libraries, monkeypatch):
    import glob

    import pyarrow.parquet as pq
    rows = [(i, f"some text number {i % 7} of many, {'word ' * (i % 5)}".strip() if i % 4 else None) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    for name, most in (("BLOCK_LINKS", 20), ("BATCH_CHARS", 40), ("SLICE_CHARS", 90), ("GROUP_BYTES", 1), ("SUM_LINKS", 3)):
        monkeypatch.setattr(alignment, name, most)
    blocks = alignment.aligned_blocks(frame, A_FILE, B_FILE)
    files = [pq.ParquetFile(f.removeprefix("file:")) for f in blocks.inputFiles()]
    assert sum(f.metadata.num_row_groups for f in files) == blocks.count() > 8
    got = [tuple(r) for r in alignment.align_documents(frame, A_FILE, B_FILE).collect()]
    assert sorted(got, key=str) == sorted(plain(libraries, rows), key=str)


def test_sums_and_merged_parts(monkeypatch):
    rng = np.random.default_rng(3)
    for links in (1, 7, 50):
        monkeypatch.setattr(alignment, "SUM_LINKS", links)
        place, weights = rng.integers(0, 9, 40), rng.integers(0, 5, (2, 9))
        ends = np.array([0, 0, 7, 7, 20, 39, 40, 40])
        want = [[w[place[a:b]].sum() for a, b in zip([0, *ends[:-1]], ends)] for w in weights]
        assert alignment._sums(weights, place, ends).tolist() == want
        assert alignment._sums(weights[:, :0], place[:0], np.zeros(2, int)).tolist() == [[0, 0], [0, 0]]
    parts = [rng.integers(0, 30, n) for n in (0, 5, 40, 1)]
    for got, want in zip(alignment._merged([alignment._distinct(p) for p in parts]), alignment._distinct(np.concatenate(parts))):
        assert got.tolist() == want.tolist()
