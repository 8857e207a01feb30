"""Candidate choice by a model, the job that uses it, and the stream that writes three outputs."""

import os
import random
import tempfile

import numpy as np
import pytest

from callsmith.operators.catalog import catalog_from_rows
from callsmith.operators.choose import bind_with_model, choose
from callsmith.operators.scorer import ModelScorer
from callsmith.plans.job import run_job


def plain_walk(cands, score):
    """The reference rule on one row: best permitted character, first whole candidate."""
    if len(cands) == 1:
        return cands[0]
    made = ""
    while True:
        allowed = sorted({c[len(made)] for c in cands if c.startswith(made) and len(c) > len(made)})
        if not allowed:
            return cands[0]
        made += max(allowed, key=lambda t: (score(made, t), -ord(t)))
        if made in cands:
            return made


def weights(made, t):
    return (ord(t) * 7 + 3 * len(made) + sum(map(ord, made))) % 11


def by_weight():
    def score(_model, texts, generated, vocab):  # the same rule, in the worker
        made = ["".join(vocab[i] for i in ids) for ids in generated]
        return [np.array([(ord(t) * 7 + 3 * len(m) + sum(map(ord, m))) % 11 for t in vocab], float) for m in made]
    return ModelScorer(lambda: None, score, name="by_weight", per_step=True)


def test_choice_equals_the_plain_walk():
    rng = random.Random(2)
    batch = [(i, ["".join(rng.choices("0123.-", k=rng.randint(1, 6))) for _ in range(rng.randint(2, 6))], "") for i in range(300)]
    found = choose(by_weight(), batch, list)
    assert found == {i: plain_walk(cands, weights) for i, cands, _ in batch}


def test_job_binds_by_model_in_declared_order(spark, catalog):
    rng = random.Random(3)
    numbers = [[str(rng.randint(-99, 999)) for _ in range(rng.randint(0, 5))] for _ in range(60)]
    rows = [(i, "Find the max of " + " and ".join(ns)) for i, ns in enumerate(numbers)] + [(900, "Greet shrek")]
    requests = spark.createDataFrame(rows, "k int, prompt string")
    calls = {r.k: r for r in run_job(requests, catalog, candidate_policy="model", candidate_scorer=by_weight()).calls.collect()}
    for i, ns in enumerate(numbers):
        used, want = [], []
        for _ in range(2):
            left = [n for n in ns if n not in used]
            used.append(plain_walk(left, weights) if left else "")
            want.append((used[-1], len(left)))
        assert [(p.raw, p.n_cands) for p in calls[i].picks] == want, ns
    assert [p.raw for p in calls[900].picks] == ["shrek"]


def test_context_and_failures_of_the_model(spark, catalog):
    def score(_model, texts, generated, vocab):
        if any("broken" in t for t in texts):
            raise RuntimeError("no")
        assert all(t.startswith("Select a from: ") or t.startswith("Select b from: ") for t in texts)
        return [np.zeros(0) for _ in texts]  # nothing is permitted: the first candidate
    scorer = ModelScorer(lambda: None, score, name="picky", per_step=True)
    requests = spark.createDataFrame([(1, "add 5 and 7 and 9"), (2, "broken add 5 and 7"), (3, "add 1 and 2")], "k int, prompt string")
    calls = {r.k: r for r in run_job(requests, catalog, candidate_policy="model", candidate_scorer=scorer).calls.collect()}
    assert [p.raw for p in calls[1].picks] == ["5", "7"] and [p.raw for p in calls[3].picks] == ["1", "2"]
    assert calls[2].is_fallback and not calls[1].is_fallback


def test_stream_job_loses_and_doubles_nothing(spark, catalog, monkeypatch):
    from callsmith.streaming import stream
    base = tempfile.mkdtemp(prefix="callsmith-test-", dir="/tmp")
    monkeypatch.setattr(stream, "stream_root", lambda _s: base)
    schema = "k int, prompt string"
    source = os.path.join(base, "in")
    spark.createDataFrame([(1, "What is the sum of 1 and 2?"), (2, "  ")], schema).write.parquet(os.path.join(source, "a"))

    def start():
        rows = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        query, path = stream.run_stream_job(spark, rows, catalog, "t")
        query.awaitTermination()
        return path

    whole = stream.run_job

    class Broken:
        """Ends the batch between its first output and the others."""
        def __init__(self, job):
            self.calls, self.rejects = job.calls, job.rejects

        def summary(self):
            raise RuntimeError("killed")

    path = start()
    spark.createDataFrame([(3, "Greet shrek"), (4, None)], schema).write.parquet(os.path.join(source, "b"))

    def broken(*args, **options):
        job = whole(*args, **options)
        job.calls.write.mode("overwrite").parquet(os.path.join(path, "calls", "batch=1"))  # the first output is there
        return Broken(job)

    monkeypatch.setattr(stream, "run_job", broken)
    with pytest.raises(Exception, match="killed"):
        start()
    assert {r.k for r in stream.read_stream_job(spark, path, "calls").select("k").collect()} == {1}
    monkeypatch.setattr(stream, "run_job", whole)
    start()
    calls = sorted((r.batch, r.k, r.fn_name) for r in stream.read_stream_job(spark, path, "calls").collect())
    rejects = sorted((r.batch, r.k, r.issue) for r in stream.read_stream_job(spark, path, "rejects").collect())
    summary = sorted((r.batch, r.n_calls, r.n_rejected) for r in stream.read_stream_job(spark, path, "summary").collect())
    assert calls == [(0, 1, "fn_add_numbers"), (1, 3, "fn_greet")]
    assert rejects == [(0, 2, "blank_prompt"), (1, 4, "missing_prompt")] and summary == [(0, 1, 1), (1, 1, 1)]


def test_decoded_calls_return_the_stripped_text(spark):
    from callsmith.operators.decode import decode_calls
    cat = catalog_from_rows(spark, [("fn_a", [("x", "int")], "int")])
    raw = spark.createDataFrame([("fn_a", '{"x": 3}', " \\t text \\n")], "raw_fn string, j string, prompt string").selectExpr(
        "raw_fn", "parse_json(j) AS raw_args", "replace(replace(prompt, '\\\\t', '\t'), '\\\\n', '\n') AS prompt")
    assert decode_calls(raw, cat, text_col="prompt").first().prompt == "text"


def test_equal_requests_are_asked_once(spark, catalog, tmp_path):
    """Function and candidates by a model that notes each text: distinct texts, whatever the copies; same calls."""
    log = str(tmp_path / "asked")

    def score(_model, texts, generated, vocab):
        with open(log, "a") as f:
            f.writelines(f"{len(ids)}|{t}\n" for t, ids in zip(texts, generated))
        return [np.array([(ord(t[0]) * 5 + len(x) + len(ids)) % 13 for t in vocab], float) for x, ids in zip(texts, generated)]

    def model():
        return ModelScorer(lambda: None, score, name="noting", per_step=True)

    rows = [(i, f"Find the max of {i % 7} and {i % 3} and 55", "x") for i in range(300)]
    rows += [(1000 + i, "Find the max of 1 and 2 and 3", None) for i in range(600)] + [(5000, "  ", None), (5001, None, None)]
    requests = spark.createDataFrame(rows, "k int, prompt string, note string").repartition(5)
    options = dict(scorer=model(), candidate_policy="model", candidate_scorer=model())
    job = run_job(requests, catalog, **options)
    got = job.calls
    found = sorted(map(tuple, got.collect()))
    asked = open(log).read().splitlines()
    distinct = len({p for _, p, _ in rows if p and p.strip()})
    # The first question about a text (no token generated yet) is put once by each of the two walks.
    firsts = [a for a in asked if a.startswith("0|")]
    assert len(firsts) == len(set(firsts)) and len(firsts) <= 3 * distinct
    os.remove(log)
    each = run_job(requests, catalog, equal_once=False, **options).calls
    assert got.columns == each.columns
    assert found == sorted(map(tuple, each.collect()))
    assert len(found) == 900 and len(open(log).read().splitlines()) > 10 * len(asked)
    assert job.rejects.count() == 2
