"""Extraction rules as data, and binding compiled from them."""

import pytest
from pyspark.sql import functions as F

from callsmith.operators import rules as R
from callsmith.operators.bind import bind_arguments, type_picks
from callsmith.operators.catalog import catalog_from_rows
from callsmith.operators.select import select_function
from callsmith.plans.job import propose_calls, run_job
from callsmith.sources.requests import mixed_requests
from tests.conftest import SMALL

MIXED = [
    ("fn_repeat_text", [("s", "str"), ("n", "int"), ("m", "float")], "str"),
    ("fn_flag", [("id", "int"), ("on", "bool"), ("again", "int"), ("name", "str"), ("w", "float")], "bool"),
    ("fn_substitute_string_with_regex", [("regex", "str"), ("other", "str"), ("source_string", "str")], "str"),
    ("fn_concatenate_strings", [("s2", "str"), ("s1", "str"), ("n", "int")], "str"),
    ("fn_reverse_string", [("s", "str"), ("n", "int")], "str"),
    ("fn_greet", [("who", "str")], "str"),
    ("fn_now", [], "str"),
    ("fn_odd_type", [("x", "date"), ("n", "int")], "str"),
]
TEXTS = [
    "Repeat '3' 3 times, then 3.5 and -3", "", "7 7 7", "'7' \"8\" 7 8 9", "greet Ana-Maria 1e400 " + "9" * 400,
    "Replace all digits in 'a 1 b 2' with '#' 5", 'Substitute the word "cat" in the string "my cat" with stars',
    "Concatenate 'x' and 'y' 4 4 5", "reverse 'ab' \"abcd\" 'abcd' 2", "5. -0 05 5 9223372036854775808", "''", "Zoë ünï 12",
]


def both(df, catalog):
    plain = type_picks(bind_arguments(df, method="fold"))
    return (df.columns, R.bind_compiled(df, catalog).select(*df.columns, "picks", "call_fatal"),
            plain.select(*df.columns, "picks", "call_fatal"))


def each_function(spark, catalog, texts=TEXTS):
    from callsmith.operators.catalog import arg_specs_column
    texts = spark.createDataFrame(list(enumerate(texts)), "i int, prompt string")
    return texts.crossJoin(catalog.select("fn_name", arg_specs_column().alias("fn_args")))


def rows(df):
    return sorted((str(r.asDict(True)) for r in df.collect()))


def test_compiled_equals_fold_for_every_signature(spark):
    catalog = catalog_from_rows(spark, MIXED)
    df = each_function(spark, catalog)
    _, compiled, fold = both(df, catalog)
    assert rows(compiled) == rows(fold)
    assert compiled.count() == len(TEXTS) * len(MIXED)


def test_compiled_equals_fold_on_requests(spark, catalog):
    df = select_function(mixed_requests(spark, SMALL), catalog).select("src", "key", "prompt", "fn_name", "fn_args")
    _, compiled, fold = both(df, catalog)
    assert rows(compiled) == rows(fold)


@pytest.mark.parametrize("limit", [0, 1, 3])
def test_signatures_beyond_the_bound_are_folded(spark, monkeypatch, limit):
    catalog = catalog_from_rows(spark, MIXED)
    df = each_function(spark, catalog)
    monkeypatch.setattr(R, "MAX_SIGNATURES", limit)
    _, compiled, fold = both(df, catalog)
    assert rows(compiled) == rows(fold)
    if limit:
        monkeypatch.setattr(R, "MAX_ARGS", 2)
        _, compiled, fold = both(df, catalog)
        assert rows(compiled) == rows(fold)


def test_null_text_and_empty_table(spark, catalog):
    df = each_function(spark, catalog, [None])
    _, compiled, fold = both(df, catalog)
    assert rows(compiled) == rows(fold)
    assert R.bind_compiled(df.filter("i < 0"), catalog).count() == 0


def test_binding_is_generated_code(spark, catalog):
    """Every projection of the binding's columns is inside a whole-stage span; no lambda is left."""
    df = spark.range(10).select(F.concat(F.lit("add "), "id", F.lit(" and 3")).alias("prompt")).select(
        "prompt", F.lit("fn_add_numbers").alias("fn_name"),
        F.expr("array(named_struct('arg_ord',0,'arg_name','a','arg_type','float'),"
               "named_struct('arg_ord',1,'arg_name','b','arg_type','float'))").alias("fn_args"))
    only_numbers = catalog.filter("fn_name not in ('fn_reverse_string','fn_to_uppercase','fn_to_lowercase','fn_string_length')")
    plan = R.bind_compiled(df, only_numbers)._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan
    assert all(line.lstrip(" +-:").startswith("*(") for line in plan.splitlines() if "Project" in line)


def test_large_plan_stays_small(spark, catalog):
    calls = run_job(mixed_requests(spark, SMALL), catalog).calls
    assert len(calls._jdf.queryExecution().optimizedPlan().toString()) < 200_000


def test_user_rule_without_code(spark):
    catalog = catalog_from_rows(spark, [("fn_ship", [("order", "int"), ("code", "str"), ("n", "int")], "str")])
    rules = spark.createDataFrame(
        [(2, None, None, None, "quoted"), (1, "int", None, None, "numbers"), (0, None, "fn_ship", "code", r"regex:code ([A-Z]\d+)"),
         (-1, "int", "fn_ship", "order", r"regex:#(\d+)")],
        "ord int, arg_type string, fn_name string, arg_name string, extractor string")
    req = spark.createDataFrame([(1, "Ship 7 of #12 with code B77"), (2, "ship nothing")], "k int, prompt string")
    out = {r.k: [p.raw for p in r.picks] for r in propose_calls(req, catalog, rules=rules).collect()}
    assert out == {1: ["12", "B77", "7"], 2: ["", "", ""]}


def test_rules_are_checked(spark, catalog):
    with pytest.raises(ValueError, match="unknown extractor"):
        R.rule_rows([(None, None, None, "nonsense")])
    assert R.rule_rows(spark.createDataFrame(
        [(i, *r) for i, r in enumerate(R.DEFAULT_RULES)],
        "ord int, arg_type string, fn_name string, arg_name string, extractor string")) == list(R.DEFAULT_RULES)
    req = spark.createDataFrame([(1, "add 1 and 2")], "k int, prompt string")
    with pytest.raises(ValueError, match="compiled form"):
        propose_calls(req, catalog, bind_method="fold", rules=R.DEFAULT_RULES)


def test_unicode_numbers_rule(spark):
    """D3: a rule reads digits of any script; the default reads ASCII digits."""
    cat = catalog_from_rows(spark, [("fn_add_numbers", [("a", "int"), ("b", "float")], "float")])
    req = spark.createDataFrame([("add \u0664\u0662 and \uff13.5",)], "prompt string")
    rules = [("int", None, None, "unicode_numbers"), ("float", None, None, "unicode_numbers")]
    picks = propose_calls(req, cat, rules=rules).first().picks
    assert [p.raw for p in picks] == ["42", "3.5"] and picks[1].c.v_float == 3.5
    assert [p.raw for p in propose_calls(req, cat).first().picks] == ["5", ""]


def test_no_requests_give_no_calls(spark, catalog):
    """P10: an empty request set ends in empty calls and rejects and a summary of zeros."""
    job = run_job(spark.createDataFrame([], "k int, prompt string"), catalog)
    assert job.calls.count() == 0 and job.rejects.count() == 0
    assert [job.summary().first()[c] for c in ("n_calls", "n_fallback", "n_rejected")] == [0, 0, 0]
