"""Argument binding (K3, W2, J8, F15, F16) and typing of the bound values.

For each request with a chosen function, arguments are bound in declared
order.  Each argument's candidates come from a rule chosen by (type,
function, argument); numeric candidates exclude every value already picked
by an earlier argument, so binding is a recurrence.  It runs as an in-row
``aggregate`` fold over the argument specs: no shuffle, no Python.

Regex work is done once per row, outside the fold, and only for the rules the
row's function needs (``CASE`` evaluates lazily).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsmith import fixed
from callsmith.functions import text as X
from callsmith.functions.convert import VALUE_FIELDS, convert_text
from callsmith.operators.select import select_candidate

PICK_TYPE = "struct<arg_ord:int,arg_name:string,arg_type:string,raw:string,n_cands:int>"


def _empty() -> Column:
    return F.array().cast("array<string>")

_NUMERIC = ("int", "float")


def _has_arg(args: Column, pred) -> Column:
    return F.exists(args, pred)


def candidate_features(text: Column, fn: Column, args: Column) -> dict[str, Column]:
    """Per-row extraction results the rules read, computed only where needed."""
    numeric = _has_arg(args, lambda a: a["arg_type"].isin(*_NUMERIC))
    stringy = _has_arg(args, lambda a: ~a["arg_type"].isin("int", "float", "bool"))
    special = fn.isin(fixed.FN_SUBSTITUTE, fixed.FN_CONCATENATE, fixed.FN_GREET,
                      *fixed.FN_UNARY_STRING)
    sub = fn == fixed.FN_SUBSTITUTE
    cat = fn == fixed.FN_CONCATENATE
    return {
        "nums": F.when(numeric, X.extract_numbers(text)).otherwise(_empty()),
        "sub_source": F.when(sub, X.extract_sub_source(text)),
        "sub_regex": F.when(sub, X.classify_pattern_phrase(text)),
        "sub_repl": F.when(sub, X.classify_replacement_phrase(text)),
        "pair1": F.when(cat, X.extract_quoted_pair(text, 1)),
        "pair2": F.when(cat, X.extract_quoted_pair(text, 2)),
        "longest": F.when(fn.isin(*fixed.FN_UNARY_STRING), X.extract_longest_quoted(text)),
        "greet": F.when(fn == fixed.FN_GREET, X.extract_after_keyword(text)),
        "quoted": F.when(~special & stringy, X.extract_any_quoted(text)).otherwise(_empty()),
    }


def candidates(f: dict[str, Column], fn: Column, arg: Column, used: Column) -> Column:
    """F16 rule dispatch for one argument; string rules never return an empty list."""
    name = arg["arg_name"]
    sub_c = (F.when(name == "source_string", X.as_array(f["sub_source"]))
             .when(name == "regex", X.as_array(f["sub_regex"]))
             .when(name == "replacement", X.as_array(f["sub_repl"]))
             .otherwise(_empty()))
    cat_c = (F.when(name == "s1", X.as_array(f["pair1"]))
             .when(name == "s2", X.as_array(f["pair2"]))
             .otherwise(_empty()))
    str_c = (F.when(fn == fixed.FN_SUBSTITUTE, sub_c)
             .when(fn == fixed.FN_CONCATENATE, cat_c)
             .when(fn.isin(*fixed.FN_UNARY_STRING), X.as_array(f["longest"]))
             .when(fn == fixed.FN_GREET, X.as_array(f["greet"]))
             .otherwise(f["quoted"]))
    str_c = F.when(F.size(str_c) == 0, F.array(F.lit(""))).otherwise(str_c)
    return (F.when(arg["arg_type"].isin(*_NUMERIC), X.exclude_used(f["nums"], used))
            .when(arg["arg_type"] == "bool", F.array(*[F.lit(c) for c in fixed.BOOL_CANDIDATES]))
            .otherwise(str_c))


def bind_arguments(df: DataFrame, text_col: str = "prompt", fn_col: str = "fn_name",
                   args_col: str = "fn_args", method: str = "fold",
                   policy: str = "first", scores_col: str | None = None) -> DataFrame:
    """Add ``picks`` = array<struct(arg_ord, arg_name, arg_type, raw, n_cands)>.

    ``method='fold'`` is the general recurrence.  ``'closed'`` is valid only
    when every argument is numeric: the k-th argument is the k-th distinct
    number (first-occurrence order), or '' when there are fewer.  ``'auto'``
    picks per row.

    ``policy='scored'`` (with ``scores_col``, a score vector per request)
    chooses among several candidates by the greedy candidate walk (K2); it
    always uses the fold, since a scored pick changes what later arguments see.
    """
    text, fn, args = F.col(text_col), F.col(fn_col), F.col(args_col)
    if policy != "first":
        scores = F.col(scores_col) if scores_col else None
        return df.withColumn("picks", _fold_picks(text, fn, args, policy, scores))
    if method == "closed":
        return df.withColumn("picks", _closed_picks(text, args))
    if method == "auto":
        # Rows whose function takes only numbers use the closed form; the
        # rest fold.  CASE evaluates one branch per row.
        all_numeric = F.forall(args, lambda a: a["arg_type"].isin(*_NUMERIC))
        return df.withColumn("picks", F.when(all_numeric, _closed_picks(text, args))
                             .otherwise(_fold_picks(text, fn, args)))
    return df.withColumn("picks", _fold_picks(text, fn, args))


def _closed_picks(text: Column, args: Column) -> Column:
    distinct = F.array_distinct(X.extract_numbers(text))
    # The distinct numbers ride in an accumulator so the regex runs once per row.
    init = F.struct(distinct.alias("d"), F.array().cast(f"array<{PICK_TYPE}>").alias("picks"))

    def step(acc, a):
        pick = F.struct(
            a["arg_ord"].cast("int").alias("arg_ord"), a["arg_name"].alias("arg_name"),
            a["arg_type"].alias("arg_type"),
            F.coalesce(F.get(acc["d"], a["arg_ord"]), F.lit("")).alias("raw"),
            F.greatest(F.size(acc["d"]) - a["arg_ord"], F.lit(0)).cast("int").alias("n_cands"))
        return F.struct(acc["d"].alias("d"), F.concat(acc["picks"], F.array(pick)).alias("picks"))

    return F.aggregate(args, init, step)["picks"]


def _fold_picks(text: Column, fn: Column, args: Column, policy: str = "first",
                scores: Column | None = None) -> Column:
    # The features ride in the fold's accumulator: an outer column referenced
    # from inside a lambda would be inlined there by Catalyst and recomputed for
    # every argument.
    feats = candidate_features(text, fn, args)
    init = F.struct(_empty().alias("used"), F.array().cast(f"array<{PICK_TYPE}>").alias("picks"),
                    F.struct(*[c.alias(k) for k, c in feats.items()]).alias("f"))

    def step(acc, a):
        f = {k: acc["f"][k] for k in feats}
        cands = candidates(f, fn, a, acc["used"])
        value = select_candidate(cands, policy, scores)
        pick = F.struct(a["arg_ord"].cast("int").alias("arg_ord"), a["arg_name"].alias("arg_name"),
                        a["arg_type"].alias("arg_type"), value.alias("raw"),
                        F.size(cands).cast("int").alias("n_cands"))
        return F.struct(F.concat(acc["used"], F.array(value)).alias("used"),
                        F.concat(acc["picks"], F.array(pick)).alias("picks"),
                        acc["f"].alias("f"))

    return F.aggregate(args, init, step)["picks"]


def type_picks(df: DataFrame, picks_col: str = "picks") -> DataFrame:
    """Convert every pick to its declared type; add ``call_fatal``."""
    typed = F.transform(F.col(picks_col), lambda p: F.struct(
        p["arg_ord"].alias("arg_ord"), p["arg_name"].alias("arg_name"),
        p["arg_type"].alias("arg_type"), p["raw"].alias("raw"), p["n_cands"].alias("n_cands"),
        convert_text(p["raw"], p["arg_type"]).alias("c")))
    return (df.withColumn(picks_col, typed)
            .withColumn("call_fatal", F.exists(F.col(picks_col), lambda p: p["c"]["fatal"])))


def explode_picks(df: DataFrame, keep: list[str], picks_col: str = "picks") -> DataFrame:
    """Long form: one row per (call, argument) with four typed value columns.

    ``explode_outer`` + a filter above it: a plain ``explode`` makes Catalyst
    infer ``size(picks) > 0`` and push it below the projections, which would
    inline (and so repeat) the whole binding expression inside the filter.
    """
    return (df.select(*keep, F.explode_outer(picks_col).alias("p"))
            .filter(F.col("p").isNotNull())
            .select(*keep, "p.arg_ord", "p.arg_name", "p.arg_type",
                    *[F.col(f"p.c.{v}").alias(v) for v in VALUE_FIELDS],
                    F.col("p.c.issue").alias("issue")))
