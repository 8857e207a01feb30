"""Whole input instead of samples, and equal requests asked once."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from callsmith.operators import catalog as C


def test_pii_is_trained_on_every_document(spark, monkeypatch):
    from pyspark.ml.classification import GBTClassifier
    from callsmith.llm import pii
    seen = []

    def fit(self, rows, *a):
        seen.append(rows.filter("label = 0").count())
        raise StopIteration

    monkeypatch.setattr(GBTClassifier, "fit", fit)
    written = sum(1 for label, _ in pii.labelled() if label == 0)
    docs = spark.range(12000).selectExpr("id as doc_id", "concat('item x', 1000000 + id, 'b is here') as text")
    with pytest.raises(StopIteration):
        pii.train(docs.union(docs))
    # Half of the texts are held out for the thresholds; a sample held 4,000 of them, and its half 2,000.
    assert 5000 < seen[0] - written / 2 < 7500


def test_language_floors_see_every_document(spark):
    from callsmith.llm import langid
    words = {"aa": ["kalo", "mira", "tuno", "sola"], "bb": ["zwerk", "gruft", "pfund", "schal"]}
    rng = random.Random(3)

    def rows(n):
        return [(" ".join(rng.choices(words[lang], k=30)) + f" q{'x' * (i % 7)}", lang) for lang in words for i in range(n)]

    base = rows(60)
    odd = [("12 34 ; a " * 20 + "b" * (i % 50), "aa") for i in range(400)]

    def model(some):
        return langid.train(spark.createDataFrame(some, "text string, lang string"), sample=20, centroids=2)

    # With a sample of 20 texts a language the other texts changed nothing but idf.
    one, two = model(base), model(base + odd)
    assert one.languages == two.languages == ["aa", "aa", "bb", "bb"]
    aa = [c for c, x in zip(two.centres, two.languages) if x == "aa"]
    seen = langid._unit(langid.gram_counts(odd[7][0]), two.idf)
    assert max(float(c @ seen) for c in aa) > 0.9


def test_window_cosines_are_those_of_the_windows():
    from callsmith.llm import langid
    rng = np.random.default_rng(2)
    centres = rng.random((3, langid.BINS))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    idf = 1 + rng.random(langid.BINS)
    text = "Ab,  c dé 12 xyz.\n\n" * 40
    want = Counter()
    for c in range(2, langid.CLASSES):
        size = max(1, (1 << c) // 4)
        starts = {(len(text) - size) * k // (langid.WINDOWS - 1) for k in range(langid.WINDOWS)} if len(text) > size else {0}
        for at in starts:
            counts = langid.gram_counts(text[at:at + size])
            if counts is not None:
                cosine = float((langid._unit(counts, idf) @ centres.T).max())
                want[min(langid.size_class(counts), langid.CLASSES - 1), round(cosine, 9)] += 1
        if len(text) <= size:
            break
    assert Counter((c, round(x, 9)) for c, x in langid.window_cosines(text, centres, idf)) == want
    assert list(langid.window_cosines("", centres, idf)) == []


def test_summary_calls_for_equal_requests_once(spark, monkeypatch):
    from callsmith.plans import job
    asked = []
    propose = job.propose_calls
    monkeypatch.setattr(job, "propose_calls", lambda rows, *a, **k: asked.append(rows.count()) or propose(rows, *a, **k))
    texts = ["What is the sum of 2 and 3?"] * 50 + ["Greet Bob", "  ", None, None, "nothing to do", "nothing to do"]
    req = spark.createDataFrame([(t,) for t in texts], "prompt string")
    got = job.summarize_requests(req, C.catalog_from_rows(spark)).first()
    assert (got.n_calls, got.n_unmatched, got.n_rejected) == (53, 2, 3)
    assert asked == [5]  # three texts, and a row for each reason of a rejection
    none = job.summarize_requests(req.limit(0), C.catalog_from_rows(spark)).first()
    assert tuple(none) == (0, 0, 0, 0, 0)


def test_bigram_counts_are_made_without_a_row_a_character(spark):
    from callsmith.operators import choose
    text = "ab" * 600_000 + "é\tab~ "
    model = choose.bigram_model(spark.createDataFrame([(text,), (None,), ("",), ("x😀x",)], "text string"))
    vocab = ["a", "b", "~", "é", " "]
    scores = [v.tolist() for v in model.score(None, ["", "", ""], [[0], [1], [2]], vocab)]
    assert scores == [[0, 600_001, 0, 0, 0], [599_999, 0, 1, 0, 0], [0, 0, 0, 0, 1]]


def test_step_scores_off_every_path_are_not_shuffled(spark):
    from callsmith.operators.walk import catalog_sequences, constrained_walk_table
    cat = C.catalog_from_rows(spark)
    paths = [r["ids"] for r in catalog_sequences(cat).collect()]
    own = [(1, k, t, 1.0 if i == 2 else 0.0) for i, s in enumerate(paths) for k, t in enumerate(s)]
    scores = spark.createDataFrame([*own, (1, 0, 10**6, 9.0), (1, 10**6, 0, 9.0), (2, 0, paths[0][0], None)],
                                   "id int, step int, token_id int, score double")
    walkers = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    walked = constrained_walk_table(walkers, cat, scores, "id")
    assert "CoGroup" not in walked._jdf.queryExecution().executedPlan().toString()
    got = sorted(((r.id or 0), r.walk_unique) for r in walked.collect())
    assert got == [(0, False), (1, True), (1, True), (2, False)]


def test_partitions_of_the_keyword_join_follow_the_input(spark, monkeypatch):
    from callsmith.operators import select
    monkeypatch.setattr(select, "JOIN_BYTES", 1)
    monkeypatch.setattr(select, "MAX_JOIN_PARTITIONS", 37)
    req = spark.createDataFrame([(i, f"sum of {i} and 2") for i in range(50)], "k int, prompt string")
    got = select.select_function(req, C.catalog_from_rows(spark), key_cols=["k"], method="join")
    assert "hashpartitioning(k" in (plan := got._jdf.queryExecution().executedPlan().toString()) and ", 37)" in plan
    assert sorted(r.k for r in got.collect()) == list(range(50))


def test_model_walk_scores_equal_requests_once(spark, tmp_path, monkeypatch):
    from callsmith.operators import scorer
    from callsmith.plans.queries import REGISTRY
    calls = spark.sparkContext.accumulator(0)
    count = scorer._count_scores

    def counted(model, texts, vocab):
        calls.add(len(texts))
        return count(model, texts, vocab)

    monkeypatch.setattr(scorer, "substring_count_model",
                        lambda: scorer.ModelScorer(lambda: None, counted, name="counted"))
    small = "/root/testdata/sf0.001"
    rows = REGISTRY["model_walk"](spark, small).count()
    assert rows > 6000 and 0 < calls.value < rows / 2


def test_a_streamed_file_is_worked_on_in_parallel(spark, tmp_path):
    import os
    from callsmith.plans.queries import REGISTRY
    folder = str(tmp_path)
    spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").coalesce(1).write.parquet(f"{folder}/made")
    os.rename(next(f"{folder}/made/{f}" for f in os.listdir(f"{folder}/made") if f.endswith(".parquet")),
              f"{folder}/lineitem.parquet")
    out = REGISTRY["stream_calls"](spark, folder)
    assert len(out.inputFiles()) > 1


def test_the_request_array_is_sorted_before_it_is_written(spark, monkeypatch):
    from callsmith.plans.queries import REGISTRY
    kind = type(spark.range(1))
    seen = []
    original = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda self, *a, **k: seen.append(len(self.columns)) or original(self, *a, **k))
    got = REGISTRY["load_request_array"](spark, "/root/testdata/sf0.001")
    assert seen[0] == 1  # the lines, before the states of the chunks
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
