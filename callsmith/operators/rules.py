"""Extraction rules as data (F16) and argument binding compiled from them.

A rule is a row ``(arg_type, fn_name, arg_name, extractor)``; a null matches anything and the first
row that matches an argument names the extractor of its candidates.  The rows may be a list or a DataFrame
with an ``ord`` column, so a user adds rules without code: ``regex:<pattern>`` takes the first group of every
match (the match itself where the pattern has no group).

Binding is compiled when the plan is built.  The size-checked catalogue is read once and functions whose arguments have
the same extractors and types share a signature.  A request then needs its signature's number only: each
argument position is one projection with a ``CASE`` over signature numbers, conversions are those
of the declared type alone, and there is no lambda, so Spark generates code for binding and typing.
Extractors that no signature needs are left out of the plan; the others run only on rows whose signature reads them.

Functions beyond ``MAX_SIGNATURES`` signatures, with more than ``MAX_ARGS`` arguments or an argument without a type
are bound by the in-row fold of ``bind`` in the same plan, with equal results; with rules of the user's own, which the
fold does not know, they raise instead.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from callsmith import fixed
from callsmith.functions import text as X
from callsmith.functions.convert import KNOWN_TYPES, convert_known, py_float
from callsmith.operators.bind import bind_arguments, type_picks
from callsmith.operators.catalog import collect_entries
from callsmith.operators.decode import PICK_TYPE

MAX_SIGNATURES = 64
MAX_ARGS = 16
MAX_RULES = 10_000
KINDS = (*KNOWN_TYPES, "other")
NUMERIC = KINDS[:2]  # int and float

# (arg_type, fn_name, arg_name, extractor); the first row that matches decides.
DEFAULT_RULES = (
    [(t, None, None, "numbers") for t in NUMERIC]
    + [("bool", None, None, "truth")]
    + [(None, fixed.FN_SUBSTITUTE, "source_string", "substitution_source"),
       (None, fixed.FN_SUBSTITUTE, "regex", "phrase_regex"),
       (None, fixed.FN_SUBSTITUTE, "replacement", "replacement"),
       (None, fixed.FN_SUBSTITUTE, None, "nothing"),
       (None, fixed.FN_CONCATENATE, "s1", "pair_first"),
       (None, fixed.FN_CONCATENATE, "s2", "pair_second"),
       (None, fixed.FN_CONCATENATE, None, "nothing")]
    + [(None, fn, None, "longest_quoted") for fn in fixed.FN_UNARY_STRING]
    + [(None, fixed.FN_GREET, None, "name_after_greet"),
       (None, None, None, "quoted")])

# Extractors of one nullable value, and of a list of values.
ONE = {
    "substitution_source": X.extract_sub_source,
    "phrase_regex": X.classify_pattern_phrase,
    "replacement": X.classify_replacement_phrase,
    "pair_first": lambda text: X.extract_quoted_pair(text, 1),
    "pair_second": lambda text: X.extract_quoted_pair(text, 2),
    "longest_quoted": X.extract_longest_quoted,
    "name_after_greet": X.extract_after_keyword,
}
MANY = {"numbers": X.extract_numbers, "unicode_numbers": lambda text: X.extract_numbers(text, unicode_digits=True),
        "quoted": X.extract_any_quoted}
CONSTANT = {"truth": fixed.BOOL_CANDIDATES, "nothing": ()}
REGEX = "regex:"


def rule_rows(rules) -> list[tuple]:
    """Rules as tuples, in order; a DataFrame has ``ord, arg_type, fn_name, arg_name, extractor``."""
    if rules is None:
        return DEFAULT_RULES
    if isinstance(rules, DataFrame):
        rows = rules.orderBy("ord").select("arg_type", "fn_name", "arg_name", "extractor").limit(MAX_RULES + 1).collect()
        if len(rows) > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} extraction rules")
        rules = [tuple(r) for r in rows]
    rules = list(rules)
    for *_, extractor in rules:
        known = extractor in ONE or extractor in MANY or extractor in CONSTANT
        if not known and not (extractor or "").startswith(REGEX):
            raise ValueError(f"unknown extractor {extractor!r}")
    return rules


def extractor_for(rules: Iterable[tuple], arg_type: str, fn_name: str, arg_name: str) -> str:
    """F16: the extractor of the first rule that matches; ``nothing`` where none does."""
    for t, fn, arg, extractor in rules:
        if t in (None, arg_type) and fn in (None, fn_name) and arg in (None, arg_name):
            return extractor
    return "nothing"


def extract(extractor: str, text: Column) -> Column:
    """The values of an extractor, as an array of strings."""
    if extractor.startswith(REGEX):
        pattern = extractor[len(REGEX):]
        return X.all_matches(text, pattern, min(1, re.compile(pattern).groups))
    return X.as_array(ONE[extractor](text)) if extractor in ONE else MANY[extractor](text)


def signatures(entries: list[dict], rules: list[tuple]) -> tuple[dict[tuple, list[str]], list[str]]:
    """({signature: function names}, names left to the fold); a signature is ((extractor, type), ...)."""
    found: dict[tuple, list[str]] = {}
    rest = []
    for e in entries:
        types = e["args_types"] or {}
        args = [(a, types.get(a)) for a in e["args_names"] or []]
        if len(args) > MAX_ARGS or any(t is None for _, t in args):
            rest.append(e["fn_name"])
            continue
        key = tuple((extractor_for(rules, t, e["fn_name"], a), t) for a, t in args)
        found.setdefault(key, []).append(e["fn_name"])
    ranked = sorted(found.items(), key=lambda kv: -len(kv[1]))
    rest += [fn for _, names in ranked[MAX_SIGNATURES:] for fn in names]
    return dict(ranked[:MAX_SIGNATURES]), rest


def _cases(branches: list[tuple[Column, Column]]) -> Column:
    return reduce(lambda c, b: c.when(*b), branches[1:], F.when(*branches[0]))


def bind_compiled(df: DataFrame, catalog: DataFrame, text_col: str = "prompt", rules=None) -> DataFrame | None:
    """Typed ``picks`` and ``call_fatal`` as of ``type_picks(bind_arguments(df))``, without lambdas.

    Needs ``fn_name`` and ``fn_args``.  None for a catalogue that fails the size check.  A request
    without a known function gets null ``picks``."""
    entries = collect_entries(catalog)
    if entries is None:
        return None
    rows = rule_rows(rules)
    known, rest = signatures(entries, rows)
    if rest and rules is not None:
        raise ValueError(f"own rules need compiled signatures; too many, or untyped arguments: {rest[0]}")
    if not known:
        return type_picks(bind_arguments(df, text_col=text_col, method="auto"))
    columns = df.columns
    keys = list(known)
    number = F.col("_sig")
    out = df.withColumn("_sig", _cases([(F.col("fn_name").isin(*names), F.lit(i))
                                        for i, names in enumerate(known.values())]))

    def of(wanted) -> Column | None:
        """The request's signature is one of those for which ``wanted`` holds (None: there is none)."""
        numbers = [i for i, key in enumerate(keys) if wanted(key)]
        return number.isin(*numbers) if numbers else None

    used = sorted({x for key in keys for x, _ in key if x not in CONSTANT})
    held = {x: f"_x{i}" for i, x in enumerate(used)}
    out = out.withColumns({name: F.when(of(lambda key: any(a == x for a, _ in key)), extract(x, F.col(text_col)))
                           for x, name in held.items()})

    def constant(values) -> Column:
        return F.array(*[F.lit(c) for c in values]).cast("array<string>")

    positions = max(map(len, keys))
    for k in range(positions):
        lists = []
        for extractor, numeric in sorted({(key[k][0], key[k][1] in NUMERIC) for key in keys if len(key) > k}):
            values = constant(CONSTANT[extractor]) if extractor in CONSTANT else F.col(held[extractor])
            if numeric:  # J8: every copy of a value bound before is no candidate
                values = reduce(F.array_remove, [F.col(f"_v{j}") for j in range(k)], values)
            lists.append((of(lambda key: len(key) > k and key[k][0] == extractor and (key[k][1] in NUMERIC) == numeric),
                          values))
        out = out.withColumn(f"_c{k}", _cases(lists))
        out = out.withColumn(f"_v{k}", F.coalesce(F.get(F.col(f"_c{k}"), F.lit(0)), F.lit("")))
    # M1-M5: only the declared types' conversions are in the plan and a number is parsed once.  What the extractor
    # ``numbers`` finds is plain decimal digits, which the cast reads as Python does.
    typed, parsed, fatal = {}, {}, F.lit(False)
    for k in range(positions):
        codes = [KINDS.index(key[k][1] if key[k][1] in KINDS else "other") if len(key) > k else None for key in keys]
        parsed[f"_k{k}"] = F.get(F.array(*[F.lit(c).cast("int") for c in codes]), number)
        plain = of(lambda key: len(key) > k and key[k][1] in NUMERIC and key[k][0] == "numbers")
        other = of(lambda key: len(key) > k and key[k][1] in NUMERIC and key[k][0] != "numbers")
        ways = [(c, d) for c, d in ((plain, F.col(f"_v{k}").try_cast("double")), (other, py_float(F.col(f"_v{k}"))))
                if c is not None]
        parsed[f"_d{k}"] = _cases(ways) if ways else F.lit(None).cast("double")
    out = out.withColumns(parsed)
    for k in range(positions):
        present = {key[k][1] if key[k][1] in KINDS else "other" for key in keys if len(key) > k}
        code, n = F.col(f"_k{k}"), F.size(F.col(f"_c{k}"))
        kinds = {t: code == i if t in present else None for i, t in enumerate(KINDS)}
        # A string argument always has a candidate, if only the empty one.
        n = F.when((n == 0) & (code >= len(NUMERIC)), F.lit(1)).otherwise(n)
        spec = F.get(F.col("fn_args"), F.lit(k))
        typed[f"_p{k}"] = F.struct(
            F.lit(k).alias("arg_ord"), spec["arg_name"].alias("arg_name"), spec["arg_type"].alias("arg_type"),
            F.col(f"_v{k}").alias("raw"), n.alias("n_cands"),
            convert_known(F.col(f"_v{k}"), F.col(f"_d{k}"), kinds).alias("c"))
        if "int" in present:
            fatal = fatal | F.col(f"_p{k}")["c"]["fatal"]
    out = out.withColumns(typed)
    size = F.get(F.array(*[F.lit(len(key)) for key in keys]), number)
    picks = F.slice(F.array(*[F.col(p) for p in typed]), F.lit(1), size) if positions else F.when(
        number.isNotNull(), F.array().cast(f"array<{PICK_TYPE}>"))
    if not rest:
        return out.select(*columns, picks.alias("picks"), fatal.alias("call_fatal"))
    folded = type_picks(bind_arguments(out, text_col=text_col, method="auto"))
    compiled = number.isNotNull()
    return folded.select(*columns, F.when(compiled, picks).otherwise(F.col("picks").cast(f"array<{PICK_TYPE}>")).alias("picks"),
                         F.when(compiled, fatal).otherwise(F.col("call_fatal")).alias("call_fatal"))
