"""End-to-end calls on a hand-written request corpus (one or more phrasings per function)."""

import pytest

from callsmith.plans.job import propose_calls

CORPUS = [
    ("What is the sum of 7 and 8?", "fn_add_numbers", {"a": 7.0, "b": 8.0}),
    ("Please add 4.5 to 10", "fn_add_numbers", {"a": 4.5, "b": 10.0}),
    ("Compute 3 plus -9", "fn_add_numbers", {"a": 3.0, "b": -9.0}),
    ("What is the product of 6 and 7?", "fn_multiply_numbers", {"a": 6.0, "b": 7.0}),
    ("Multiply 12 by 3", "fn_multiply_numbers", {"a": 12.0, "b": 3.0}),
    ("What is 9 times 9?", "fn_multiply_numbers", {"a": 9.0, "b": 0.0}),
    ("Subtract 2 from 11", "fn_subtract_numbers", {"a": 2.0, "b": 11.0}),
    ("What is 50 minus 8?", "fn_subtract_numbers", {"a": 50.0, "b": 8.0}),
    ("Divide 81 by 9", "fn_divide_numbers", {"a": 81.0, "b": 9.0}),
    ("What is 5 divided by 2?", "fn_divide_numbers", {"a": 5.0, "b": 2.0}),
    ("Find the square root of 49", "fn_get_square_root", {"a": 49.0}),
    ("sqrt of 2", "fn_get_square_root", {"a": 2.0}),
    ("What is 3 to the power of 5?", "fn_power", {"base": 3.0, "exponent": 5.0}),
    ("Compute 2 raised to 6", "fn_power", {"base": 2.0, "exponent": 6.0}),
    ("Is 12 an even number?", "fn_is_even", {"n": 12}),
    ("Is -7 even?", "fn_is_even", {"n": -7}),
    ("Is 3.5 positive?", "fn_is_positive", {"n": 3.5}),
    ("Reverse the string 'spark'", "fn_reverse_string", {"s": "spark"}),
    ("Write 'stressed' backwards", "fn_reverse_string", {"s": "stressed"}),
    ("Turn 'quiet' into uppercase", "fn_to_uppercase", {"s": "quiet"}),
    ("Make 'LOUD' lowercase", "fn_to_lowercase", {"s": "LOUD"}),
    ("What is the length of 'banana'?", "fn_string_length", {"s": "banana"}),
    ("How long is the string 'ok'?", "fn_string_length", {"s": "ok"}),
    ("Greet Zoë", "fn_greet", {"name": "Zoë"}),
    ("Please greet the-team", "fn_greet", {"name": "the-team"}),
    ("Replace all vowels in 'data lake' with asterisks", "fn_substitute_string_with_regex",
     {"source_string": "data lake", "regex": "[aeiouAEIOU]", "replacement": "*"}),
    ("Substitute the word 'big' with 'small' in 'a big big world'", "fn_substitute_string_with_regex",
     {"source_string": "a big big world", "regex": r"\bbig\b", "replacement": "small"}),
    ("Replace digits in 'room 101' with '#'", "fn_substitute_string_with_regex",
     {"source_string": "room 101", "regex": r"\d+", "replacement": "#"}),
    ("Concatenate 'data' and 'frame'", "fn_concatenate_strings", {"s1": "data", "s2": "frame"}),
    ("Join 'py' with 'spark'", "fn_concatenate_strings", {"s1": "py", "s2": "spark"}),
    ("What is the factorial of 6?", "fn_factorial", {"n": 6}),
    ("Absolute value of -42", "fn_absolute_value", {"n": -42.0}),
    ("What is the maximum of 4 and 9?", "fn_max_of_two", {"a": 4.0, "b": 9.0}),
    ("Which is larger, 2 or 8?", "fn_max_of_two", {"a": 2.0, "b": 8.0}),
    ("What is the minimum of -1 and 1?", "fn_min_of_two", {"a": -1.0, "b": 1.0}),
    ("What is 20 modulo 6?", "fn_modulo", {"a": 20, "b": 6}),
    ("Calculate 9 mod 4", "fn_modulo", {"a": 9, "b": 4}),
]


@pytest.fixture(scope="module")
def calls(spark, catalog):
    req = spark.createDataFrame([(i, p) for i, (p, _, _) in enumerate(CORPUS)], "i int, prompt string")
    return {r.i: r for r in propose_calls(req, catalog).collect()}


def _value(c):
    for f in ("v_int", "v_float", "v_bool", "v_str"):
        if c[f] is not None:
            return c[f]


@pytest.mark.parametrize("i", range(len(CORPUS)))
def test_corpus_call(calls, i):
    prompt, fn, args = CORPUS[i]
    r = calls[i]
    assert r.fn_name == fn, prompt
    assert {p.arg_name: _value(p.c) for p in r.picks} == args, prompt
