"""Argument extraction with the function given: hand-traced goldens and edge cases."""

import re

import pytest
from pyspark.sql import functions as F

from callsmith.functions import text as X
from callsmith.functions.convert import convert_text, convert_variant
from callsmith.operators.bind import bind_arguments, type_picks
from callsmith.operators.catalog import args_literal

# Own sentences, one for each rule that a function name selects.
GOLDENS = [
    ("Tell me the square root of 81 please", "fn_get_square_root", {"a": 81.0}),
    ("Reverse the string 'lantern'", "fn_reverse_string", {"s": "lantern"}),
    ("Substitute the digits in the string 'Room 12 on floor 407' with 'NUMBERS'",
     "fn_substitute_string_with_regex",
     {"source_string": "Room 12 on floor 407", "regex": r"\d+", "replacement": "NUMBERS"}),
    ("Replace all vowels in 'Quiet harbour' with asterisks", "fn_substitute_string_with_regex",
     {"source_string": "Quiet harbour", "regex": "[aeiouAEIOU]", "replacement": "*"}),
    ("Substitute the word 'tea' with 'rum' in 'More tea for the tea house'",
     "fn_substitute_string_with_regex",
     {"source_string": "More tea for the tea house", "regex": r"\btea\b", "replacement": "rum"}),
    ("Replace consonants in 'ladder' with underscores", "fn_substitute_string_with_regex",
     {"source_string": "ladder", "regex": "[bcdfghjklmnpqrstvwxyzBCDFGHJKLMNPQRSTVWXYZ]",
      "replacement": "_"}),
    ("Substitute spaces in 'red green blue' with nothing", "fn_substitute_string_with_regex",
     {"source_string": "red green blue", "regex": r"\s+", "replacement": ""}),
    ("Replace all vowels in 'We're late, aren't we?' with 'Q'", "fn_substitute_string_with_regex",
     {"source_string": "We're late, aren't we?", "regex": "[aeiouAEIOU]", "replacement": "Q"}),
    ("Would -14 count as an even number?", "fn_is_even", {"n": -14}),
    ("Greet walter", "fn_greet", {"name": "walter"}),
    ("Greet Zoë", "fn_greet", {"name": "Zoë"}),
    ("Greet Anne-Sophie", "fn_greet", {"name": "Anne-Sophie"}),
    ("Concatenate 'Left ' and 'Right'", "fn_concatenate_strings", {"s1": "Left ", "s2": "Right"}),
    ("Join 'sun' with 'rise'", "fn_concatenate_strings", {"s1": "sun", "s2": "rise"}),
    ("Reverse '98760'", "fn_reverse_string", {"s": "98760"}),
    ("Give the sum of 0 and 0 now", "fn_add_numbers", {"a": 0.0, "b": 0.0}),
    ("Pick the max of 6 and 6", "fn_max_of_two", {"a": 6.0, "b": 0.0}),
    ("Absolute value of -9.75", "fn_absolute_value", {"n": -9.75}),
    ("Give the sum of 41 and 7", "fn_add_numbers", {"a": 41.0, "b": 7.0}),
    ("Subtract 8 from 31", "fn_subtract_numbers", {"a": 8.0, "b": 31.0}),
]


def _value(c):
    for f in ("v_int", "v_float", "v_bool", "v_str"):
        if c[f] is not None:
            return c[f]
    return None


@pytest.mark.parametrize("method", ["fold", "auto"])
def test_goldens(spark, catalog, method):
    specs = {r["fn_name"]: r for r in catalog.collect()}
    rows = []
    for i, (prompt, fn, _) in enumerate(GOLDENS):
        rows.append((i, prompt, fn))
    df = spark.createDataFrame(rows, "i int, prompt string, fn_name string")
    args = F.create_map(*[x for n, r in specs.items()
                          for x in (F.lit(n), args_literal(r["args_names"], r["args_types"]))])
    df = df.withColumn("fn_args", F.element_at(args, F.col("fn_name")))
    out = {r["i"]: r for r in type_picks(bind_arguments(df, method=method)).collect()}
    for i, (prompt, fn, expected) in enumerate(GOLDENS):
        got = {p["arg_name"]: _value(p["c"]) for p in out[i]["picks"]}
        assert got == expected, prompt


def test_numbers_edge_cases(spark):
    cases = {"10-3": ["10", "-3"], "5.": ["5."], "3.14.15": ["3.14", "15"], "1e5": ["1", "5"],
             "1,000": ["1", "000"], "123-456-7890": ["123", "-456", "-7890"]}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r["t"]: r["n"] for r in df.select("t", X.extract_numbers(F.col("t")).alias("n")).collect()}
    assert got == cases


def test_numbers_in_digits_of_any_script(spark):
    """As Python's own pattern, whose digits are those of any script, and its float give them."""
    texts = ["\u0663.\u0665 and -\u096a\u0968", "\uff11\uff12 1\u06f2.", "\U0001d7d9\U0001d7ce x 7", "\u00b2 \u2167 \u0bf0", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["n"] for r in df.select("t", X.extract_numbers(F.col("t"), unicode_digits=True).alias("n")).collect()}
    for t in texts:
        found = re.findall(r"-?\d+\.?\d*", t)
        assert [float(x) for x in got[t]] == [float(x) for x in found]
        assert all(x.isascii() and len(x) == len(y) for x, y in zip(got[t], found))


def test_closed_form_equals_fold(spark):
    prompts = ["a 1 2 3", "1 1 2", "5 5 5", "7", "", "-1 1 -1 2", "2.0 2 2."]
    df = spark.createDataFrame([(p,) for p in prompts], "p string")
    nums = X.extract_numbers(F.col("p"))
    fold = F.aggregate(F.sequence(F.lit(0), F.lit(2)), F.array().cast("array<string>"),
                       lambda acc, _k: F.concat(acc, F.array(F.coalesce(
                           F.get(X.exclude_used(nums, acc), 0), F.lit("")))))
    closed = F.array(*[F.coalesce(X.kth_distinct(nums, k), F.lit("")) for k in range(3)])
    for r in df.select(fold.alias("a"), closed.alias("b")).collect():
        assert r["a"] == r["b"]


@pytest.mark.parametrize("raw,typ,field,expected,issue", [
    ("3.9", "int", "v_int", 3, None), ("-3.9", "int", "v_int", -3, None),
    ("abc", "int", "v_int", 0, "bad_int"), ("", "int", "v_int", 0, None),
    (None, "int", "v_int", 0, None), ("5.", "float", "v_float", 5.0, None),
    ("1d", "float", "v_float", 0.0, "bad_float"), ("TRUE", "bool", "v_bool", True, None),
    ("yes", "bool", "v_bool", False, None), ("x", "date", "v_str", "", "unknown_type"),
    ("1" * 30, "int", "v_int", 0, "int_overflow"),
    ("9223372036854775808", "int", "v_int", 0, "int_overflow"),
])
def test_convert_text(spark, raw, typ, field, expected, issue):
    r = spark.createDataFrame([(raw, typ)], "v string, t string") \
        .select(convert_text(F.col("v"), F.col("t")).alias("c")).first()["c"]
    assert r[field] == expected and r["issue"] == issue


def test_convert_text_infinite_int_is_fatal(spark):
    r = spark.createDataFrame([("1" * 400, "int")], "v string, t string") \
        .select(convert_text(F.col("v"), F.col("t")).alias("c")).first()["c"]
    assert r["fatal"] is True


@pytest.mark.parametrize("js,expected", [
    ("true", True), ('"TRUE"', True), ('"1"', True), ('"yes"', True), ('"t"', False),
    ('"no"', False), ("2", True), ("0", False), ("[]", False), ('{"a": 1}', True)])
def test_convert_variant_bool(spark, js, expected):
    r = spark.createDataFrame([(js,)], "j string") \
        .select(convert_variant(F.parse_json("j"), F.lit("bool")).alias("c")).first()["c"]
    assert r["v_bool"] is expected


def test_convert_variant_numbers(spark):
    df = spark.createDataFrame([("3.9", "int"), ('"3.9"', "int"), ("true", "int"), ("69", "str"),
                                ("null", "float"), ('"x"', "float")], "j string, t string")
    got = [r["c"] for r in df.select(convert_variant(F.parse_json("j"), F.col("t")).alias("c")).collect()]
    assert got[0]["v_int"] == 3 and got[1]["v_int"] == 3 and got[2]["v_int"] == 1
    assert got[3]["v_str"] == "69"
    assert got[4]["v_float"] == 0.0 and got[4]["issue"] == "missing_arg"
    assert got[5]["v_float"] == 0.0 and got[5]["issue"] == "bad_float"


def test_strip_matches_python(spark):
    samples = ["\t a  ", "　x ", "\x1cy\x1f", " z\n", "keep inner  space"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r["o"] for r in df.select(X.strip_ws(F.col("s")).alias("o")).collect()]
    assert got == [s.strip() for s in samples]
