"""Sources, validation, selection, decoding, the job and the sink."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from callsmith import fixed
from callsmith.operators.catalog import CatalogError, catalog_from_rows, dedupe_catalog, validate_catalog
from callsmith.operators.decode import decode_calls, unknown_calls
from callsmith.operators.select import select_function
from callsmith.operators.validate import validate_requests
from callsmith.plans.job import propose_calls, run_job
from callsmith.sources.json_records import load_catalog, load_json_records, load_requests
from callsmith.sources.requests import mixed_requests
from callsmith.sources.sink import write_calls
from conftest import SMALL


def _tmpdir():
    return tempfile.mkdtemp(prefix="callsmith-test-", dir="/tmp")


def test_json_loader_edge_cases(spark):
    d = _tmpdir()
    files = {"bad.json": "{bad", "obj.json": '{"a":1}', "empty.json": "[]", "nums.json": "[1,null]",
             "mix.json": '["x",{"prompt":"y"},5]'}
    for n, c in files.items():
        with open(os.path.join(d, n), "w") as f:
            f.write(c)
    records, rejects = load_json_records(spark, d)
    got = sorted((os.path.basename(r.source), r.ord) for r in records.collect())
    assert got == [("mix.json", 0), ("mix.json", 1)]
    issues = sorted((os.path.basename(r.source), r.issue) for r in rejects.collect())
    assert ("bad.json", "bad_json") in issues and ("obj.json", "not_array") in issues
    assert ("mix.json", "skipped_bigint") in issues
    assert not any(s == "empty.json" for s, _ in issues)
    _, missing = load_json_records(spark, os.path.join(d, "nope"))
    assert [r.issue for r in missing.collect()] == ["missing_path"]


def test_prompt_validation(spark):
    d = _tmpdir()
    path = os.path.join(d, "p.json")
    with open(path, "w") as f:
        json.dump([{"prompt": "x"}, {}, {"prompt": None}, {"prompt": 5}, {"prompt": ""},
                   {"prompt": "  "}, {"prompt": "\t a "}, {"prompt": "b", "extra": 1}, "bare"], f)
    valid, rejects = load_requests(spark, path)
    assert sorted((r.req_id, r.prompt) for r in valid.collect()) == [(1, "x"), (7, "a"), (8, "b"),
                                                                     (9, "bare")]
    assert sorted(r.issue for r in rejects.collect()) == sorted(
        ["missing_prompt", "missing_prompt", "not_string", "empty_prompt", "blank_prompt"])


def test_catalog_gate(spark):
    bad = catalog_from_rows(spark, [("add", [("a", "float")], "float")])
    with pytest.raises(CatalogError):
        validate_catalog(bad)
    empty_ret = catalog_from_rows(spark, [("fn_x", [], "")])
    with pytest.raises(CatalogError):
        validate_catalog(empty_ret)
    valid, rejects = validate_catalog(catalog_from_rows(spark, [("fn_ok", [], "int")]))
    assert valid.count() == 1 and rejects.count() == 0
    missing_type = spark.createDataFrame([(0, "fn_y", ["a"], {}, "int")],
                                         "ord bigint, fn_name string, args_names array<string>, "
                                         "args_types map<string,string>, return_type string")
    _, rej = validate_catalog(missing_type, strict=False)
    assert rej.first()["issue"] == "missing_arg_type:a"


def test_dedupe_keeps_first_position_last_value(spark):
    cat = catalog_from_rows(spark, [("fn_a", [("x", "int")], "int"), ("fn_b", [], "int"),
                                    ("fn_a", [("y", "str")], "str")])
    rows = {r.fn_name: r for r in dedupe_catalog(cat).collect()}
    assert rows["fn_a"].ord == 0 and rows["fn_a"].args_names == ["y"]


def test_load_catalog_file(spark):
    d = _tmpdir()
    path = os.path.join(d, "defs.json")
    defs = [{"fn_name": n, "args_names": [a for a, _ in args], "args_types": dict(args),
             "return_type": r} for n, args, r in fixed.REFERENCE_CATALOG]
    with open(path, "w") as f:
        json.dump(defs, f)
    cat = load_catalog(spark, path)
    assert cat.count() == 20 and cat.orderBy("ord").first()["fn_name"] == "fn_add_numbers"


@pytest.mark.parametrize("prompt,fn", [
    ("Give me the sum of 2 and 3", "fn_add_numbers"), ("Greet walter", "fn_greet"),
    ("Reverse the string 'lantern'", "fn_reverse_string"), ("Join 'sun' with 'rise'",
                                                          "fn_concatenate_strings"),
    ("Would -14 count as an even number?", "fn_is_even"), ("Bonjour tout le monde", "fn_add_numbers"),
])
def test_lexical_selection(spark, catalog, prompt, fn):
    df = spark.createDataFrame([(1, prompt)], "k int, prompt string")
    assert select_function(df, catalog).first()["fn_name"] == fn


def test_join_form_equals_inrow(spark, catalog):
    req = mixed_requests(spark, SMALL)
    cols = ["src", "file_id", "row_index", "fn_name", "fn_score"]
    a = select_function(req, catalog).select(cols)
    b = select_function(req, catalog, key_cols=["src", "file_id", "row_index"], method="join").select(cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_invariants_of_the_job(spark, catalog):
    req = mixed_requests(spark, SMALL)
    res = run_job(req, catalog)
    calls = res.calls
    n_valid = validate_requests(req)[0].count()
    assert calls.count() == n_valid
    names = {r.fn_name: r for r in catalog.collect()}
    for r in calls.select("fn_name", "picks").collect():
        spec = names[r.fn_name]
        assert [p.arg_name for p in r.picks] == spec.args_names
        for p in r.picks:
            t = spec.args_types[p.arg_name]
            field = {"int": "v_int", "float": "v_float", "bool": "v_bool"}.get(t, "v_str")
            assert p.c[field] is not None


def test_decode_repairs(spark, catalog):
    raw = spark.createDataFrame([
        (1, "fn_add_numbers", '{"a": "2.5", "b": 3, "z": 1}'),
        (2, "fn_nope", '{"a": 1}'),
        (3, None, None),
        (4, "fn_is_even", '{"n": 1e400}'),
        (5, "fn_greet", '{}'),
    ], "id int, raw_fn string, j string").withColumn("raw_args", F.try_parse_json("j"))
    out = {r.id: r for r in decode_calls(raw, catalog).collect()}
    assert [p.c.v_float for p in out[1].picks] == [2.5, 3.0]
    assert out[2].fn_name == "fn_add_numbers" and out[2].fn_unknown
    assert out[3].fn_name == "fn_add_numbers" and [p.c.v_float for p in out[3].picks] == [0.0, 0.0]
    assert out[5].picks[0].c.v_str == "" and out[5].picks[0].c.issue == "missing_arg"
    assert sorted(r.id for r in unknown_calls(raw, catalog).collect()) == [2, 3]  # NULL name is unknown


def test_fatal_value_falls_back(spark, catalog):
    req = spark.createDataFrame([(1, "Is " + "9" * 400 + " an even number?")], "k int, prompt string")
    r = propose_calls(req, catalog).first()
    assert r.is_fallback and r.fn_name == "fn_add_numbers"
    assert [p.c.v_float for p in r.picks] == [0.0, 0.0]


def test_sink_json_lines(spark, catalog):
    req = spark.createDataFrame([(2, "Greet Zoë"), (1, "Give me the sum of 2 and 3")],
                                "req_id int, prompt string")
    out = os.path.join(_tmpdir(), "out")
    n = write_calls(propose_calls(req, catalog), out, fmt="json", order_col="req_id")
    assert n == 2
    lines = [json.loads(x) for f in sorted(os.listdir(out)) if f.startswith("part")
             for x in open(os.path.join(out, f), encoding="utf-8") if x.strip()]
    assert lines[0] == {"prompt": "Give me the sum of 2 and 3", "fn_name": "fn_add_numbers",
                        "args": {"a": 2.0, "b": 3.0}}
    assert lines[1]["args"] == {"name": "Zoë"}
    pq = os.path.join(_tmpdir(), "pq")
    assert write_calls(propose_calls(req, catalog), pq) == 2
    assert spark.read.parquet(pq).count() == 2


def test_decode_blank_prompt_falls_back(spark, catalog):
    raw = spark.createDataFrame([(1, "  ", "fn_greet", '{"name": "x"}'), (2, "hi", "fn_greet", '{"name": "x"}')],
                                "id int, prompt string, raw_fn string, j string") \
        .withColumn("raw_args", F.parse_json("j"))
    out = {r.id: r for r in decode_calls(raw, catalog, text_col="prompt").collect()}
    assert out[1].is_fallback and out[1].fn_name == "fn_add_numbers"
    assert not out[2].is_fallback and out[2].picks[0].c.v_str == "x"


def _brute_candidate(cands, scores, extra=5):
    if not cands:
        return ""
    if len(cands) == 1:
        return cands[0]
    toks = [[ord(ch) for ch in c] for c in cands]
    g = []
    for _ in range(max(len(t) for t in toks) + extra):
        allowed = {t[len(g)] for t in toks if len(t) > len(g) and t[:len(g)] == g}
        allowed = [i for i in allowed if i < len(scores)]
        if not allowed:
            break
        best = max(scores[i] for i in allowed)
        g.append(min(i for i in allowed if scores[i] == best))
        for i, t in enumerate(toks):
            if t == g:
                return cands[i]
    return cands[0]


def test_scored_candidate_walk(spark):
    from callsmith.operators.select import select_candidate
    import random
    rnd = random.Random(7)
    rows = [(["12", "1", "123"], [0.0] * 128), (["2", "3"], [float(i % 5) for i in range(128)]),
            (["abc"], [0.0] * 128), ([], [0.0] * 128)]
    for _ in range(40):
        cands = [str(rnd.randint(0, 150)) for _ in range(rnd.randint(0, 4))]
        rows.append((cands, [float(rnd.randint(0, 3)) for _ in range(rnd.randint(40, 128))]))
    df = spark.createDataFrame(rows, "c array<string>, s array<double>")
    got = [r.x for r in df.select(select_candidate(F.col("c"), "scored", F.col("s")).alias("x")).collect()]
    assert got == [_brute_candidate(c, s) for c, s in rows]
    assert got[0] == "1"  # the shorter candidate completes first


def test_scored_policy_in_binding(spark, catalog):
    from callsmith.operators.bind import bind_arguments, type_picks
    from callsmith.operators.catalog import args_literal
    spec = {r.fn_name: r for r in catalog.collect()}
    add = spec["fn_add_numbers"]
    scores = [0.0] * 128
    scores[ord("3")] = 5.0          # the scorer prefers '3'
    df = spark.createDataFrame([("Give me the sum of 2 and 3", scores)], "prompt string, s array<double>") \
        .select("prompt", "s", F.lit("fn_add_numbers").alias("fn_name"),
                args_literal(add.args_names, add.args_types).alias("fn_args"))
    first = type_picks(bind_arguments(df)).first().picks
    scored = type_picks(bind_arguments(df, policy="scored", scores_col="s")).first().picks
    assert [p.c.v_float for p in first] == [2.0, 3.0]
    assert [p.c.v_float for p in scored] == [3.0, 2.0]


@pytest.mark.parametrize("defs", [
    ['fn_add', {"fn_name": "fn_ok", "return_type": "int"}],                   # a bare string
    [{"fn_name": "add", "return_type": "int"}],                               # no fn_ prefix
    [{"fn_name": "fn_x", "args_names": ["a"], "args_types": {}, "return_type": "int"}],  # untyped arg
    [{"fn_name": "fn_x", "return_type": ""}],                                 # empty return type
    [],                                                                       # empty catalogue
])
def test_catalog_file_gate_aborts(spark, defs):
    d = _tmpdir()
    path = os.path.join(d, "defs.json")
    with open(path, "w") as f:
        json.dump(defs, f)
    with pytest.raises(CatalogError):
        load_catalog(spark, path)


def test_catalog_file_without_args_is_valid(spark):
    d = _tmpdir()
    path = os.path.join(d, "defs.json")
    with open(path, "w") as f:
        json.dump([{"fn_name": "fn_now", "return_type": "str", "extra": True}], f)
    cat = load_catalog(spark, path)
    r = cat.first()
    assert (r.fn_name, r.args_names, r.args_types) == ("fn_now", [], {})


def test_calls_wide_keeps_declared_order(spark, catalog):
    from callsmith.plans.job import calls_wide
    req = spark.createDataFrame([(1, "Replace all vowels in 'ab c' with asterisks")], "k int, prompt string")
    r = calls_wide(propose_calls(req, catalog), ["k"]).first()
    assert r.fn_name == "fn_substitute_string_with_regex"
    assert r.args == '{"source_string":"ab c","regex":"[aeiouAEIOU]","replacement":"*"}'
    assert list(json.loads(r.args)) == ["source_string", "regex", "replacement"]


def test_fingerprint_ignores_type_order(spark):
    from callsmith.operators.catalog import definition_fingerprint
    rows = [(0, "fn_a", ["x", "y"], {"x": "int", "y": "str"}, "int"),
            (1, "fn_a", ["x", "y"], {"y": "str", "x": "int"}, "int"),
            (2, "fn_a", ["x", "y"], {"x": "int", "y": "int"}, "int")]
    df = spark.createDataFrame(rows, "ord bigint, fn_name string, args_names array<string>, "
                                     "args_types map<string,string>, return_type string")
    fp = {r.ord: r.f for r in df.select("ord", definition_fingerprint().alias("f")).collect()}
    assert fp[0] == fp[1] != fp[2]


def test_job_with_a_model_scorer(spark, catalog):
    from callsmith.operators.scorer import ModelScorer
    from callsmith.plans.job import run_job

    def counts(_model, texts, vocab):  # local, so that it is pickled by value
        if any("broken" in t for t in texts):
            raise RuntimeError("no scores")
        return [[float(t.split("request: ")[1].lower().count(v)) for v in vocab] for t in texts]

    prompts = ["fn_reverse_string of 'abc' please: reverse the string", "this one is broken 5", "fn_greet Bob: greet"]
    frame = spark.createDataFrame(list(enumerate(prompts)), "k int, prompt string")
    scorer = ModelScorer(lambda: None, counts, name="counts")
    got = {r.k: r for r in run_job(frame, catalog, scorer=scorer).calls.collect()}
    first = catalog.orderBy("ord").first()["fn_name"]
    assert [got[k].is_fallback for k in range(3)] == [False, True, False]
    assert got[1].fn_name == first and all(p.n_cands == 0 for p in got[1].picks)
    assert {got[0].fn_name, got[2].fn_name}.isdisjoint({None})
