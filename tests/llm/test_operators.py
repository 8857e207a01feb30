"""The corpus operators on small fixtures: defined cases, brute force, round trips."""

import hashlib
import random
import re
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from callsmith.llm import ann, chat, decontaminate, html_blocks, langid, licenses, packing, pii
from callsmith.llm import simhash, token_files
from callsmith.llm.common import sampled
from callsmith.llm.queries import tokenizer_file
from callsmith.llm.tokenizing import TextEncoder
from conftest import SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, kind string, start string"


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(ascii_lower(text))


@pytest.fixture(scope="module")
def docs(spark):
    """Null, empty, tied, repeated and long texts, null ids, clashing extra columns."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(300)] + ["The", "café", "mit", "license", "cc", "by"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 120))) for _ in range(40)]
    texts += [None, "", "   ", "one", "one two", texts[0], texts[0], texts[1] + " tail",
              " ".join(rng.choices(vocabulary, k=9000)), "x" * 30_000, "ＡＢ 中文 \x1c odd space",
              "mail me.now@host.example.com or +1 (555) 010-9999, 10.0.0.255, card 4111 1111 1111 1111",
              "999.1.1.1 1.2.3.4.5 4111111111111112 +12 a@b a..b@c-d.e.f x@y.z@q.r"]
    rows = [(i, t, "en", "s", None, "r", "k", "z") for i, t in enumerate(texts)]
    rows += [(3, texts[3], "en", "s", None, "r", "k", "z"), (None, texts[4], None, None, None, "r", "k", "z")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_tokens_equal_the_library():
    rng = random.Random(5)
    letters = "ab E'st.,!\n \t1é中́<|> _\x1c İ"
    texts = ["".join(rng.choices(letters, k=60)) for _ in range(1500)]
    texts += ["<|endoftext|> x<|endoftext|>", "don't WE'RE I'll", "  a  b\n\n c\t d ", ""]
    for name, kind in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        enc = TextEncoder(tokenizer_file(name), kind)
        for t in texts:
            want = enc.tokenizer.encode(t, add_special_tokens=False).ids
            assert np.frombuffer(enc.packed(t), "<u4").tolist() == want, repr(t)


def test_decontamination_against_brute_force(spark, docs, empty):
    rows = docs.collect()
    items = [(0, " ".join(rows[0].text.split()[:14])), (1, rows[2].text), (2, "one"), (10, "one TWO"),
             (3, None), (4, "..."), (5, "never seen anywhere at all"), (None, "café"), (0, "mit license")]
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("win", F.lit(1))
    windows = set()
    for i, t in items:
        w = words(t)
        windows |= {(i, tuple(w[s:s + 10])) for s in range(max(1, len(w) - 9)) if w}
    want = []
    for r in rows:
        w, hit, found = words(r.text), set(), set()
        for i, win in windows:
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s:s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    found |= {str(i)} if i is not None else set()
        want.append((r.doc_id, len(w), len(hit), len(found), sorted(found)))
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"])
           for r in decontaminate.contamination(docs, bench).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    kept = decontaminate.clean_documents(docs, bench)
    bad = {x[0] for x in want if x[2] and x[0] is not None}
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == \
        sorted(r.doc_id for r in rows if r.doc_id is not None and r.doc_id not in bad)
    assert kept.columns == docs.columns
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_simhash_against_brute_force(docs, empty):
    rows = docs.collect()
    want = {r.doc_id: simhash.simhash(r.text) for r in rows if r.doc_id is not None}
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    parent = {d: d for d in want}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a in want:
        for b in want:
            if ((want[a] ^ want[b]) & (2 ** 64 - 1)).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert {d: got[d].fp for d in want} == want
    assert {d: got[d].component_id for d in want} == {d: find(d) for d in want}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == \
        sorted({find(d) for d in want})
    assert simhash.near_duplicates(empty).count() == 0


def test_filters_tell_rows_of_one_id_apart(spark):
    one, two = "a b c d e f g h i j k l", "quite other words stand in this one text here"
    rows = [(7, one), (7, two), (7, two), (None, one), (None, "only rows without an id hold this"),
            (None, "only rows without an id hold this"), (8, one)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("root", F.lit("x"))
    kept = sorted((str(r.doc_id), r.text) for r in simhash.keep_one(frame).collect())
    assert kept == sorted([("7", one), ("7", two), ("None", rows[4][1])])
    bench = spark.createDataFrame([(1, one)], "item_id bigint, text string")
    clean = [(r.doc_id, r.text) for r in decontaminate.clean_documents(frame, bench).collect()]
    assert sorted(map(str, clean)) == sorted(str(r) for r in rows if r[1] != one)


def test_samples_stay_small_on_any_table(spark):
    rows = spark.range(200_000).withColumn("k", F.col("id").cast("string"))
    for share in (1.0, 0.5, 1e-3):
        n = rows.filter(sampled(F.col("k"), share)).count()
        assert abs(n - 200_000 * share) <= 5 * (200_000 * share) ** 0.5 * (share < 1)
    assert rows.filter(sampled(F.col("k"), 1e-12)).count() == 0


def test_hot_segments_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 8)
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(4)]
    fps = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(60)}
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    frame = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    found = {r.node: r.root for r in simhash.connected_components(simhash.links(frame)).collect()}
    parent = {f: f for f in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in signed:
        for b in signed:
            if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert all(found.get(f, f) == find(f) for f in signed)


def test_packing_round_trip(docs, empty):
    enc = TextEncoder(tokenizer_file("word_bpe_49k.json"), True)
    pieces = packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json")).collect()
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in (None, 3)}
    for d, t in texts.items():
        mine = sorted((p for p in pieces if p.doc_id == d), key=lambda p: p.start)
        ids = enc.packed(t) + (1).to_bytes(4, "little")
        assert b"".join(p["ids"] for p in mine) == ids
        assert [p.start for p in mine] == [sum(q.length for q in mine[:k]) for k in range(len(mine))]
        assert {p.doc_tokens for p in mine} == {len(ids) // 4}
    sequences = {}
    for p in sorted(pieces, key=lambda p: p.offset):
        assert p.offset == sequences.get(p.sequence_id, 0)
        sequences[p.sequence_id] = p.offset + p.length
    assert max(sequences.values()) <= 2048
    assert packing.pack_documents(empty, tokenizer_file("word_bpe_49k.json")).count() == 0


def test_differencing_is_near_equal():
    rng = random.Random(2)
    sizes = [rng.randint(1, 512) for _ in range(600)]
    dealt = packing.differencing(sizes, 40)
    assert sorted(i for w in dealt for i in w) == list(range(600))
    sums = [sum(sizes[i] for i in w) for w in dealt]
    assert max(sums) - min(sums) < 40
    assert packing.differencing([], 3) == []
    assert all(sum([5, 5, 5][i] for i in w) <= 7 for w in packing.deal([5, 5, 5], 7))


def test_chat_reads_back(spark):
    rows = [(1, 0, "user", "hi <|im_end|> <\\|x|>"), (1, 1, "assistant", "<|im_start|>assistant ok"),
            (1, 1, "assistant", "tie"), (2, 0, None, None), (None, 5, "assistant", "no id"),
            (3, 0, "as\nsist\\n<|ant", "odd role")] + [(4, i, ("user", "assistant")[i % 2], f"t{i}")
                                                       for i in range(200)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    formatted = chat.format_conversations(table)
    assert formatted.filter("rewrites_history").count() == 0
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    for c in (1, 2, None, 3, 4):
        mine = sorted((t, r or "", x or "") for k, t, r, x in rows if k == c)
        assert got[c].n_turns == len(mine)
        assert got[c].turns_text == "".join(f"{r}\n{x}\n" for _, r, x in mine)
        assert got[c].loss_text == "".join(x for _, r, x in mine if r == "assistant")
    assert chat.read_back(chat.format_conversations(table.limit(0))).count() == 0


def test_chat_detects_rewritten_history():
    def last_only(turns):  # earlier turns lose their brackets
        return "".join(f"{r}:{t};" if i == len(turns) - 1 else f"({r}){t}." for i, (r, t) in enumerate(turns))

    turns = [("user", "a"), ("assistant", "bb"), ("user", "ccc")]
    whole, spans, rewrites = chat.text_spans(last_only, turns)
    assert rewrites and [whole[a:z] for a, z in spans] == ["a", "bb", "ccc"]
    whole, spans, rewrites = chat.text_spans(chat.marked_template, turns * 60)
    assert not rewrites and [whole[a:z] for a, z in spans] == ["a", "bb", "ccc"] * 60


def test_licenses(docs, empty):
    got = licenses.scan_licenses(docs).collect()
    for r, g in zip(docs.collect(), got):
        w, places, labels = words(r.text), [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            places, labels = places + at, labels | ({label} if at else set())
        assert (g.n_words, g.n_base, g.base_labels) == (len(w), len(places), ",".join(sorted(labels)))
        assert (g.first_word, g.last_word) == (min(places, default=None), max(places, default=None))
        assert labels <= set(g.labels.split(",")) | {""}
    assert licenses.scan_licenses(empty).count() == 0
    scan = licenses.Scanner().scan
    typo = scan("under the GNU Genral Publik License; Mozila public license")
    assert typo["labels"] == "gpl,mpl" and typo["n_base"] == 0 and 0.9 < typo["score"] < 1
    assert [(s["first"], s["last"]) for s in typo["spans"]] == [(2, 5), (6, 8)]
    both = scan("gnu genral public licens and the gnu general public license")
    assert [(s["first"], s["edits"]) for s in both["spans"] if not s["base"]] == [(0, 2), (6, 0)]
    assert scan("nothing of the kind")["labels"] == "" and scan(None)["score"] == 0


def base_spans(text):
    def luhn(d):
        return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0

    rules = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
             (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub("[^0-9]", "", m)) <= 19
              and luhn(re.sub("[^0-9]", "", m))),
             (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15)]
    return sorted((m.start(), k + 1, m.end()) for k, (p, ok) in enumerate(rules)
                  for m in re.finditer(p, text or "") if ok(m[0]))


def test_pii_base_spans_and_redaction(spark, docs, empty):
    model = pii.Model(None, {})
    got = pii.find_pii(docs, model).collect()
    want = [(r.doc_id, base_spans(r.text)) for r in docs.collect()]
    assert sorted(str((g.doc_id, [(s.start, s.kind_no, s.end) for s in g.base])) for g in got) == \
        sorted(map(str, want))
    clean = pii.redact(docs, model)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    by_id = {r.doc_id: r.text for r in clean.collect()}
    assert by_id[51] == "mail [EMAIL] or [PHONE], [IP], card [CARD]"
    assert all(by_id[r.doc_id] == r.text for r in docs.collect() if not base_spans(r.text))
    assert pii.redact(empty, model).count() == 0
    assert pii.train(empty).score is None


def test_pii_patterns_on_random_strings(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choices("a.@-+ 1234567()é", k=70)) for _ in range(600)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: [(s.start, s.kind_no, s.end) for s in r.base]
           for r in pii.find_pii(frame, pii.Model(None, {})).collect()}
    assert got == {i: base_spans(t) for i, t in enumerate(texts)}


def test_pii_trees_add_spans(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        number = f"{rng.randint(100, 999)}-{rng.randint(1000, 9999)}"
        rows.append((i, f"call +1 555 {number} now, order {rng.randint(10, 99)}"))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = pii.train(frame)
    assert model.score is not None
    spans = pii.find_pii(frame, model).collect()
    assert all(any(s.kind == "phone" for s in r.spans) for r in spans)
    assert all({tuple(s) for s in r.base} <= {tuple(s) for s in r.spans} for r in spans)


def test_language_held_out_accuracy(spark, empty):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held = langid.held_out(F.col("doc_id"))
    model = langid.train(docs.filter(~held))
    found = langid.identify(docs, model).join(docs.filter(held).select("doc_id", "lang"), "doc_id")
    assert found.filter("lang_pred = lang").count() / found.count() > 0.97
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 ..."), (4, "Это русский текст " * 3)],
                                "doc_id bigint, text string").withColumn("lang_pred", F.lit("x"))
    got = {r.doc_id: r for r in langid.identify(odd, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3
    assert all(got[i].lang_rejected for i in got)
    assert langid.accepted(odd, model).count() == 0
    assert langid.identify(empty, model).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, langid.train(empty)).collect()} == {"und"}
    expected = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in docs.select("doc_id").collect()}
    assert {r.doc_id: r.h for r in docs.select("doc_id", held.alias("h")).collect()} == expected


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>", ""),
    ("<nav><a href=x>Home</a></nav><article><h1>T &amp; U</h1><p>a <b>b</b>\n c<p>d<br>e</article><footer>f</footer>",
     "T & U\na b c\nd e"),
    ("<article><p>One<div class='comments'><p>me too</p></div><p>Two &lt;b&gt;", "One\nTwo <b>"),
    ("<article>x<script>var t='</p>'</script><!-- <p>no</p> --><p>y<a hr", "x\ny"),
    ("<div id=content><p>" + "word " * 40 + "</p></div><div class='cookie-notice'>" + "we " * 40 + "</div>",
     ("word " * 40).strip()),
    ("<body><p>" + "long text " * 40 + "</p><ul><li><a href=a>x</a></li><li><a href=b>y</a></li></ul>",
     ("long text " * 40).strip()),
])
def test_main_text(page, text):
    assert html_blocks.main_text(page, html_blocks.train()) == text


def test_extract_keeps_rows(spark):
    pages = spark.createDataFrame([(1, "u", None), (1, "u", "<article>a</article>"), (None, None, "<p")],
                                  "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    got = html_blocks.extract(pages)
    assert got.columns == ["page_id", "url", "text"]
    assert sorted(r.text for r in got.collect()) == ["", "", "a"]
    assert html_blocks.extract(pages.limit(0)).count() == 0


def test_neighbours_recall_and_defined_cases(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16))
    x = (centres[rng.integers(0, 30, 3000)] + 0.4 * rng.normal(size=(3000, 16))).astype(np.float32)
    x[1000:1800] = x[1000]  # one common vector
    rows = [(i, [float(v) for v in x[i]]) for i in range(3000)]
    rows += [(3000, None), (3020, [0.0] * 16), (3040, [float("nan")] * 16), (3060, [None] + [1.0] * 15), (3080, [1.0])]
    frame = spark.createDataFrame(rows, T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))]))
    router = ann.fit(ann.usable(frame), per_partition=300)
    assert router.partitions > 4
    got = ann.search(frame, F.col("vec_id") % 20 == 0, router=router).toPandas()
    hits = 0
    for q, mine in got.groupby("query_id"):
        scores = np.zeros(3000)
        for d in range(16):
            scores += x[q, d].astype(float) * x[:, d].astype(float)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(3000), -scores))[:20]
        mine = mine.sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21))
        assert np.array_equal(scores[mine.vec_id.to_numpy()], mine.score.to_numpy())
        hits += len(set(best) & set(mine.vec_id))
    assert got.query_id.nunique() == 150 and hits / 3000 >= 0.9
    few = ann.search(frame.filter("vec_id < 5"), F.col("vec_id") == 0).collect()
    assert len(few) == 4
    assert ann.search(frame.limit(0), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("n", [90, 400])
def test_neighbours_have_learned_partitions_in_small_tables(spark, n):
    x = np.random.default_rng(n).normal(size=(n, 8))
    frame = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    router = ann.fit(ann.usable(frame))
    assert router.partitions >= 2
    found = ann.search(frame, F.col("vec_id") % 20 == 0, router=router).collect()
    hits = 0
    for q in range(0, n, 20):
        near = x @ x[q]
        near[q] = -np.inf
        hits += len(set(np.argsort(-near)[:20]) & {r.vec_id for r in found if r.query_id == q})
    assert hits / (20 * len(range(0, n, 20))) >= 0.9


def test_simple8b_round_trip():
    rng = np.random.default_rng(2)
    for n in (1, 5, 100, 40_000):
        for top in (1, 100, 50_257, 2 ** 35, 2 ** 62):
            v = rng.integers(0, top, n).astype(np.uint64)
            if top == 2 ** 62:
                v[::3] |= np.uint64(1 << 63)  # escapes
            assert np.array_equal(token_files.decode_row(*token_files.encode_row(v), n), v)


def test_token_files_round_trip(spark, docs, empty, tmp_path):
    enc = TextEncoder(tokenizer_file("byte_bpe_50k.json"), False)
    for name, frame in (("all", docs), ("none", empty)):
        path = str(tmp_path / name)
        token_files.write_token_files(frame, path, tokenizer_file("byte_bpe_50k.json"), row_ids=500)
        got = token_files.read_token_files(spark, path).orderBy("start").collect()
        rows = sorted(frame.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
        at = 0
        assert len(got) == len(rows)
        for g, r in zip(got, rows):
            ids = enc.packed(r.text) + (2).to_bytes(4, "little")
            assert (g.doc_id, g.start, g.n_tokens, bytes(g["ids"])) == (r.doc_id, at, len(ids) // 4, ids)
            at += g.n_tokens


def test_neighbours_of_repeated_query_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 8))
    rows = [(i, x[i].tolist()) for i in range(60)]
    rows += [(0, x[0].tolist())] * 2 + [(20, rng.normal(size=8).tolist())]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = ann.search(frame, F.col("vec_id") % 20 == 0, k=20).toPandas()
    vectors = {0: [rows[0][1]], 20: [rows[20][1], rows[62 + 0][1]], 40: [rows[40][1]]}
    for q, own in vectors.items():
        want = []
        for v in own:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)[:20]
            want += [(k + 1, i) for k, (_, i) in enumerate(scored)]
        mine = got[got.query_id == q]
        assert sorted(zip(mine["rank"].tolist(), mine.vec_id.tolist())) == sorted(want)
    assert len(got) == 80


def test_pii_long_runs_do_not_end_the_job(spark):
    digits, labels = " ".join("1" * 50_000), "a@b" + ".c" * 50_000
    spelled = "a (at) b" + " (dot) c" * 50_000
    frame = spark.createDataFrame([(1, digits), (2, labels), (3, spelled)], "doc_id bigint, text string")
    got = {(r.doc_id, r.made): r.match for r in pii.candidates(frame).filter("match is not null").collect()}
    assert got[1, "card"] == digits and got[2, "email"] == labels and got[3, "address"] == spelled
    assert {r.doc_id: r.text for r in pii.redact(frame, pii.Model(None, {})).collect()} == {
        1: digits, 2: "[EMAIL]", 3: spelled}


def test_language_with_many_copies_stays_in_the_model(spark):
    texts = {"aa": [f"kalo mira tuno {'pe' * i} sola" for i in range(1, 41)],
             "bb": [f"zwerk gruft {'sch' * i} pfund" for i in range(1, 501)]}
    rows = [(t, "aa") for t in texts["aa"] for _ in range(1000)] + [(t, "bb") for t in texts["bb"]]
    rows += [("123", "aa"), (None, "aa"), (None, "bb")]
    frame = spark.createDataFrame(rows, "text string, lang string")
    # With as many centroids as texts, each drawn text is one: all 40 and 300 of 500.
    model = langid.train(frame, sample=300, centroids=300)
    assert [model.languages.count(x) for x in ("aa", "bb")] == [40, 300]


def test_pii_adds_loose_forms(spark):
    plain = [f"no number in text {i}, only words" for i in range(40)]
    loose = {"write me (at) host (dot) com today": "write [EMAIL] today", "or me @ host.com, please": "or [EMAIL], please",
             "call (555) 010-9999 now": "call [PHONE] now"}
    kept = ["on 2024-03-15 it rained", "the years 1998-2004 here", "order 20391827 came", "12 @ 4.99 each",
            "token = \"aebccd4559894937c75946a5f6\"", "by 5693240340017844 was", "a population of 1 234 567 people",
            "thanks @jane.doe for it", "ISBN 978-3-16-148410-0 is", "at 999.1.1.1 or 10.0.19041.1266"]
    frame = spark.createDataFrame(list(enumerate([*plain, *loose, *kept])), "doc_id bigint, text string")
    model = pii.train(frame)
    assert set(model.thresholds) == {"email", "phone"}
    got = [r.text for r in pii.redact(frame, model).orderBy("doc_id").collect()]
    assert got == [*plain, *loose.values(), *kept]


def test_language_rejects_untrained_languages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))
    strange = [
        "Tämä on suomenkielinen teksti jossa puhutaan säästä ja kahvista. Aamulla satoi lunta mutta päivällä paistoi aurinko.",
        "Lapset leikkivät pihalla kunnes tuli ilta ja kaikki menivät kotiin syömään. Huomenna lähdemme mökille uimaan järveen.",
        "Wczoraj wieczorem poszliśmy do kina, ponieważ chcieliśmy zobaczyć nowy film o historii naszego miasta i mieszkańców.",
        "Każdego ranka dziadek czytał gazetę przy oknie, a babcia przygotowywała śniadanie dla wszystkich wnuków w kuchni.",
        "for i in range(len(xs)): print(xs[i], end=' '); import numpy as np; def f(x): return x ** 2 + np.sqrt(x) - 1",
        "xkqz wvvj qqpzx jjkwq zzxv kqwj xvzq pqkx wzjv qxkz vjwq zkxq jqwv xzkp qvjw kzxq wjvq zxkp qjvw"]
    found = langid.identify(spark.createDataFrame(list(enumerate(strange)), "doc_id int, text string"), model)
    assert sum(r.lang_rejected for r in found.collect()) >= 5
    rejected = langid.identify(docs, model).filter("lang_rejected").count()
    assert rejected <= 0.02 * docs.count()


def test_whole_documents_have_the_librarys_ids(spark):
    texts = [r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    for name, kind in (("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)):
        enc = TextEncoder(tokenizer_file(name), kind)
        assert not enc.whole
        want = [e.ids for e in enc.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        for _ in range(2):  # without and with the caches
            assert [np.frombuffer(enc.packed(t), "<u4").tolist() for t in texts] == want


def test_caches_of_two_generations_and_other_files(monkeypatch):
    from callsmith.llm import tokenizing
    monkeypatch.setattr(tokenizing, "RUN_ENTRIES", 5)
    monkeypatch.setattr(tokenizing, "PIECE_ENTRIES", 3)
    monkeypatch.setattr(tokenizing, "FIRST_ENTRIES", 5)
    enc = TextEncoder(tokenizer_file("byte_bpe_50k.json"), False)
    rng = random.Random(1)
    for _ in range(200):
        text = " ".join(rng.choices(["alpha", "beta,", "gamma.", "Straße", "d-e", "\n", "x1", "the", "of"], k=9))
        assert np.frombuffer(enc.packed(text), "<u4").tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(enc.cache) <= 5 and len(enc.cache.old) <= 5
    # The wrong kind for a file differs from the library, so the library gets every text.
    wrong = TextEncoder(tokenizer_file("word_bpe_49k.json"), False)
    assert wrong.whole
    assert np.frombuffer(wrong.packed("Some Words"), "<u4").tolist() == wrong.tokenizer.encode(
        "Some Words", add_special_tokens=False).ids


def test_batches_of_texts_give_each_distinct_run_to_the_library_once(monkeypatch):
    from callsmith.llm import tokenizing
    enc = TextEncoder(tokenizer_file("byte_bpe_50k.json"), False)
    rng = random.Random(4)
    runs = ["alpha", "beta,", "Straße", "d-e", "x1", "中文", "<|endoftext|>", "'s", "e\u0301", "\u0301", "..", "z" * 80]
    texts = [" ".join(rng.choices(runs + ["a\nb", "of.\nThe", "two  spaces", "tab\t", "\n\n", "wide\u3000"], k=rng.randrange(9)))
             for _ in range(300)]
    texts += [None, "", " ", "\n", " lead", "trail ", "odd\x1cspace", "\v0", "\tb"]
    want = [enc.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    asked, whole = [], enc._spaced_ids
    monkeypatch.setattr(enc, "_spaced_ids", lambda some: asked.extend(some) or whole(some))
    for most in (tokenizing.RUN_ENTRIES, 5):  # the second time with generations of five chunks
        monkeypatch.setattr(tokenizing, "RUN_ENTRIES", most)
        for size in (len(texts), 7):
            for lo in range(0, len(texts), size):
                ids, sizes = enc.batch(texts[lo:lo + size])
                assert sizes.tolist() == [len(w) for w in want[lo:lo + size]]
                assert ids.tolist() == [i for w in want[lo:lo + size] for i in w]
            if most > 5 and size > 7:
                assert len(asked) == len(set(asked)) and set(asked) <= {r for t in texts for r in (t or "").split()}
    assert len(enc.young) <= 5 and len(enc.old) <= 5
    assert [len(x) for x in enc.batch([])] == [0, 0]
    words = TextEncoder(tokenizer_file("word_bpe_49k.json"), True)
    ids, sizes = words.batch(texts)
    assert ids.tobytes() == b"".join(words.packed(t) for t in texts) and len(sizes) == len(texts)


def test_batches_ask_for_a_word_once_whatever_marks_end_it():
    enc = TextEncoder(tokenizer_file("byte_bpe_50k.json"), False)
    library, asked = enc.tokenizer, []
    enc.tokenizer = SimpleNamespace(
        encode=library.encode, model=SimpleNamespace(tokenize=lambda t: asked.append(t) or library.model.tokenize(t)),
        encode_batch_fast=lambda ts, **kw: asked.extend(ts) or library.encode_batch_fast(ts, **kw))
    text = "x alphaword alphaword, alphaword. alphaword!? (alphaword) alphaword's alphaword's, 12alphaword$$$"
    for _ in range(2):
        assert enc.batch([text, "y alphaword;"])[0].tolist() == [
            i for t in (text, "y alphaword;") for i in library.encode(t, add_special_tokens=False).ids]
    # Alone, and in the runs that begin or go on in another way.
    assert asked.count("Ġalphaword") == 1 and "".join(asked).count("alphaword") == 4
    rng = random.Random(9)
    parts = ["ab", "É", "ß", "7", "'", "'s", "'t", ",", ".", "!!", "$", "-", "_", "中", "e\u0301", "²", "½", "“", "Ж"]
    runs = ["".join(rng.choices(parts, k=rng.randint(1, 5))) for _ in range(4000)]
    texts = ["".join(r + rng.choice(["\n", " ", " ", " "]) for r in runs[i:i + 9])[:-1] for i in range(0, len(runs), 9)]
    for size in (len(texts), 50):
        for space in ("", " "):
            for lo in range(0, len(texts), size):
                some = texts[lo:lo + size]
                want = [library.encode(space + t, add_special_tokens=False).ids for t in some]
                ids, sizes = enc.batch(some, bool(space))
                assert sizes.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
    odd = ["", None, " ", "\n", " lead", "trail ", "a  b", "\tx", "x"]
    want = [library.encode(" " + (t or ""), add_special_tokens=False).ids for t in odd]
    assert enc.batch(odd, space=True)[0].tolist() == [i for w in want for i in w]


def test_slices_of_a_batch_keep_every_row(monkeypatch):
    monkeypatch.setattr(token_files, "SLICE_BYTES", 10)
    texts = ["four", None, "", "a text of more than ten bytes", "x", "é" * 30, "last"]
    batch = pa.RecordBatch.from_arrays([pa.array([3, None, 1, 3, 4, 5, 6]), pa.array(texts)], ["doc_id", "text"])
    cut = list(token_files._slices(batch))
    assert len(cut) > 2 and [x for ids, _ in cut for x in ids] == [3, None, 1, 3, 4, 5, 6]
    assert [x for _, some in cut for x in some] == texts
    assert list(token_files._slices(batch.slice(0, 0))) == []


def test_trees_are_fitted_on_few_partitions(spark, monkeypatch):
    from pyspark.ml.classification import GBTClassifier
    seen = []
    fit = GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, rows, *a: seen.append(rows.rdd.getNumPartitions()) or fit(self, rows, *a))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        pii.train(spark.read.parquet(f"{SMALL}/documents.parquet"), rounds=2, depth=2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen and seen[0] <= pii.FIT_PARTITIONS


def test_paragraphs_and_items_that_say_they_are_none():
    tree = html_blocks.train()
    page = ("<article><p>Keep this first paragraph of the text</p><p class=\"ad\">Buy now cheap</p><p>and this one too"
            "<p hidden>secret words<p>the third one<ul><li class='comment'>nice post<li>a real item of the list"
            "<ul><li>inner item here</li></ul><li class=comment>more</ul><p class='ad'>buy <div>a block in the text</div></article>")
    assert html_blocks.main_text(page, tree).split("\n") == [
        "Keep this first paragraph of the text", "and this one too", "the third one", "a real item of the list",
        "inner item here", "a block in the text"]
    assert html_blocks.main_text("<article><ul><li class=comment>x y<ul><li>z of it</li></ul> tail</li><li>kept item</li></ul></article>",
                                 tree) == "kept item"


def _asked_features(tree, row):
    asked = set()
    while isinstance(tree, tuple):
        asked.add(html_blocks.FEATURES[tree[0]])
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return asked


def test_words_and_links_decide_blocks():
    """The tree is asked about every block that no container rules out, and it asks for word counts and link density."""
    tree = html_blocks.train()
    page = ("<body><div><a href=1>Home</a> <a href=2>News</a></div><div>" + "a sentence of the text " * 12 + "</div><div>Short one.</div><div>"
            + "more of the text follows " * 9 + "</div><div><a href=3>Read this too</a></div><div><a href=4>And this</a></div></body>")
    assert html_blocks.main_text(page, tree).split("\n") == [
        ("a sentence of the text " * 12).strip(), "Short one.", ("more of the text follows " * 9).strip()]
    html = pd.read_parquet(f"{SMALL}/pages.parquet").html
    for h in [page, *html]:
        found, marked = html_blocks.undecided(html_blocks.blocks(h))
        for row in html_blocks.features(found, marked):
            assert _asked_features(tree, row) & {"words", "link", "words_before", "link_before", "words_after", "link_after"}


def test_labelled_pages_held_out():
    """Trained on the other labelled pages, the tree is right on most blocks of each left out."""
    pages = html_blocks.LABELLED_PAGES
    right = total = 0
    for i in range(len(pages)):
        tree = html_blocks.train(pages[:i] + pages[i + 1:])
        rows, labels = html_blocks.labelled_blocks([pages[i]])
        right += sum(html_blocks.classify(tree, r) == bool(x) for r, x in zip(rows, labels))
        total += len(labels)
    assert right / total > 0.85


def test_very_long_page():
    tree = html_blocks.train()
    page = "<article>" + "<p>some words of a paragraph</p>" * 20000 + "</article>"
    assert html_blocks.main_text(page, tree).count("\n") == 19999
