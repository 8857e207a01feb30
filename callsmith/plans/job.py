"""The whole batch (K4, K7, K8, A9, U2) as one lazy DataFrame plan.

``requests → validate → select function → bind arguments → type → fallback``.
The catalogue, its keywords and the fallback definition are broadcast once;
with the lexical scorer the plan is narrow (no shuffle) up to the sink.
Nothing raises per row: every failure is an issue column or a fallback call.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsmith.operators.bind import bind_arguments, explode_picks, type_picks
from callsmith.operators.choose import bind_with_model
from callsmith.operators.decode import apply_fallback, pack_arguments, with_first_function
from callsmith.operators.rules import bind_compiled
from callsmith.operators.scorer import ModelScorer, TableScorer
from callsmith.operators.select import select_function
from callsmith.operators.validate import validate_requests
from callsmith.session import default_parallelism


def propose_calls(requests: DataFrame, catalog: DataFrame, scorer=None,
                  text_col: str = "prompt", key_cols: list[str] | None = None,
                  bind_method: str = "compiled", candidate_policy: str = "first",
                  scores_col: str | None = None, candidate_scorer=None, rules=None,
                  equal_once: bool = True) -> DataFrame:
    """K4: one call per request: ``fn_ord, fn_name, fn_score, fn_fallback, is_fallback, picks``.

    ``candidate_policy='scored'`` with ``scores_col`` (a score vector per
    request) picks among several candidates by the greedy candidate walk.
    ``candidate_policy='model'`` asks ``candidate_scorer`` (a ``ModelScorer``; default: ``scorer``) at the branches
    of the candidates' tokens.  ``scorer`` is lexical by default; a ``TableScorer`` or ``ModelScorer`` selects by a
    constrained walk, and a request it raises for becomes the fallback call.

    ``bind_method='compiled'`` binds by expressions compiled from a catalogue that passes the size check and
    from ``rules`` (F16, see ``operators.rules``); a larger catalogue, the other methods and policies
    bind in a fold, by the default rules only.

    Where a model is asked, equal texts are asked once: the job runs over the distinct texts (counted with map-side
    combine) and its answers are joined back by the text; a hot text's requests are left to AQE's
    skew-join split.  ``equal_once=False`` asks for each request, as a stream does and a model must whose answers are drawn.
    """
    models = isinstance(scorer, ModelScorer) or candidate_policy == "model"
    if equal_once and models and scores_col is None and not isinstance(scorer, TableScorer) and not requests.isStreaming:
        return _propose_distinct(requests, catalog, scorer, text_col, bind_method, candidate_policy, candidate_scorer, rules)
    selected = select_function(requests, catalog, scorer, text_col=text_col, key_cols=key_cols)
    typed = None
    if candidate_policy == "first" and bind_method == "compiled":
        typed = bind_compiled(selected, catalog, text_col, rules)
    if typed is None:
        if rules is not None:
            raise ValueError("own rules need the compiled form: a size-checked catalogue and the policy 'first'")
        if candidate_policy == "model":
            bound = bind_with_model(selected, candidate_scorer or scorer, text_col)
        else:
            bound = bind_arguments(selected, text_col=text_col, method="auto" if bind_method == "compiled" else bind_method,
                                   policy=candidate_policy, scores_col=scores_col)
        typed = type_picks(bound)
    typed = typed.withColumn("is_fallback", F.lit(False))
    for flag in ("fn_failed", "choice_failed"):  # K8: a request a scorer raised for becomes the fallback call
        if flag in typed.columns:
            typed = typed.withColumn("call_fatal", F.col("call_fatal") | F.col(flag)).drop(flag)
    return apply_fallback(with_first_function(typed, catalog)).drop("fn_args", "call_fatal")


def spread(texts: DataFrame) -> DataFrame:
    """Spread again after an aggregate: AQE would give a few megabytes of texts to one task, and so to one model."""
    spark = texts.sparkSession
    return texts.repartition(max(default_parallelism(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _propose_distinct(requests: DataFrame, catalog: DataFrame, scorer, text_col: str, *options) -> DataFrame:
    bind_method, candidate_policy, candidate_scorer, rules = options
    texts = spread(requests.select(text_col).distinct())
    calls = propose_calls(texts, catalog, scorer, text_col, [text_col], bind_method, candidate_policy,
                          None, candidate_scorer, rules, equal_once=False)
    added = [c for c in calls.columns if c != text_col]
    answers = calls.select(F.col(text_col).alias("_asked_text"), F.struct(*added).alias("_answer"))
    kept = [c for c in requests.columns if c not in added]
    joined = requests.join(answers, requests[text_col].eqNullSafe(answers["_asked_text"]))
    return joined.select(*[requests[c] for c in kept], *[F.col("_answer")[c].alias(c) for c in added])


def calls_long(calls: DataFrame, keep: list[str]) -> DataFrame:
    """One row per (call, argument) with typed value columns."""
    return explode_picks(calls, keep)


def calls_wide(calls: DataFrame, keep: list[str], text_col: str = "prompt") -> DataFrame:
    """``(…keep, prompt, fn_name, args)``, args as JSON text in declared order."""
    return calls.select(*keep, text_col, "fn_name", pack_arguments(F.col("picks")).alias("args"))


@dataclass
class JobResult:
    calls: DataFrame
    rejects: DataFrame

    def summary(self) -> DataFrame:
        return run_summary(self.calls, self.rejects)


def run_job(requests: DataFrame, catalog: DataFrame, scorer=None,
            text_col: str = "prompt", key_cols: list[str] | None = None,
            bind_method: str = "compiled", candidate_policy: str = "first",
            scores_col: str | None = None, candidate_scorer=None, rules=None, equal_once: bool = True) -> JobResult:
    """K7: validated requests → calls, plus the rejected requests."""
    valid, rejects = validate_requests(requests, text_col)
    calls = propose_calls(valid, catalog, scorer, text_col, key_cols, bind_method,
                          candidate_policy, scores_col, candidate_scorer, rules, equal_once)
    return JobResult(calls=calls, rejects=rejects)


def run_summary(calls: DataFrame, rejects: DataFrame | None = None) -> DataFrame:
    """Counts and rates.  Fallback, unmatched and defaulted calls are reported apart."""
    defaulted = F.exists(F.col("picks"), lambda p: p["c"]["issue"].isNotNull() | (p["n_cands"] == 0))
    agg = calls.agg(
        F.count(F.lit(1)).alias("n_calls"),
        F.count_if(F.col("is_fallback")).alias("n_fallback"),
        F.count_if(F.col("fn_fallback")).alias("n_unmatched"),
        F.count_if(defaulted).alias("n_defaulted"))
    if rejects is not None:
        agg = agg.crossJoin(rejects.agg(F.count(F.lit(1)).alias("n_rejected")))
    return agg


def summarize_requests(requests: DataFrame, catalog: DataFrame, scorer=None,
                       text_col: str = "prompt") -> DataFrame:
    """A9/S13 in one pass over the requests: rejected rows ride along (flagged)
    instead of being counted from a second scan of the input.  Equal texts are counted first (with map-side
    combine) and get one call, which counts as often as they come."""
    from callsmith.functions.text import strip_ws
    from callsmith.operators.validate import request_issue
    checked = (requests.withColumn("_issue", request_issue(F.col(text_col)))
               .withColumn(text_col, F.when(F.col("_issue").isNull(), strip_ws(F.col(text_col)))
                           .otherwise(F.lit(""))))
    checked = checked.withColumn("_times", F.lit(1).cast("bigint"))
    if not isinstance(scorer, TableScorer) and not requests.isStreaming:
        checked = spread(checked.groupBy("_issue", text_col).agg(F.sum("_times").alias("_times")))
    calls = propose_calls(checked, catalog, scorer, text_col)
    ok = F.col("_issue").isNull()

    def times(which):
        return F.coalesce(F.sum(F.when(which, F.col("_times"))), F.lit(0).cast("bigint"))

    defaulted = F.exists(F.col("picks"), lambda p: p["c"]["issue"].isNotNull() | (p["n_cands"] == 0))
    return calls.agg(
        times(ok).alias("n_calls"),
        times(ok & F.col("is_fallback")).alias("n_fallback"),
        times(ok & F.col("fn_fallback")).alias("n_unmatched"),
        times(ok & defaulted).alias("n_defaulted"),
        times(~ok).alias("n_rejected"))
