"""Registered queries: one per operator group, over the driver's whole tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame with flat scalar
columns; ``callsmith.plans.oracle`` holds the DuckDB SQL for the same name.
"""

from __future__ import annotations

import uuid
import zlib

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsmith.functions import text as X
from callsmith.functions.convert import VALUE_FIELDS, convert_text
from callsmith.operators import catalog as C
from callsmith.operators.bind import bind_arguments, explode_picks, type_picks
from callsmith.operators.decode import decode_calls, pack_arguments, resolve_function, unknown_calls
from callsmith.operators.select import select_function
from callsmith.operators.validate import validate_requests, validation_report
from callsmith.plans.job import propose_calls, run_job, spread
from callsmith.session import default_parallelism, ensure_parallelism, shared_path, table
from callsmith.sources import requests as R

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _arg(i: int, field: str):
    return F.get(F.col("picks"), i)["c"][field]


def _with_function(df: DataFrame, catalog: DataFrame, fn_name: str) -> DataFrame:
    """Attach one catalogue entry's argument specs as constants (the function is given)."""
    row = catalog.filter(F.col("fn_name") == fn_name).first()
    return df.select("*", F.lit(fn_name).alias("fn_name"),
                     C.args_literal(row["args_names"], row["args_types"]).alias("fn_args"))


def _bound(df: DataFrame, spark: SparkSession, fn_name: str) -> DataFrame:
    return type_picks(bind_arguments(_with_function(df, C.catalog_from_rows(spark), fn_name)))


# --- flagship -----------------------------------------------------------------

@register("bind_two_numbers")
def bind_two_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum requests from lineitem → selected function and two typed numbers."""
    req = ensure_parallelism(R.lineitem_sum_requests(table(spark, sf_dir, "lineitem")))
    calls = propose_calls(req, C.catalog_from_rows(spark))
    return calls.select("l_orderkey", "l_linenumber", "fn_name",
                        _arg(0, "v_float").alias("a"), _arg(1, "v_float").alias("b"))


# --- extraction -----------------------------------------------------------------

@register("extract_numbers_requests")
def extract_numbers_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 + C9: every number of a request built from orders, with its position."""
    o = table(spark, sf_dir, "orders")
    req = o.select("o_orderkey", F.concat(
        F.lit("Compare "), R.dec_text("o_totalprice"), F.lit(" with -"), R.s("o_custkey"),
        F.lit(" and "), R.s("o_orderkey"), F.lit("-"), R.s(F.col("o_custkey") % 7)).alias("prompt"))
    return (ensure_parallelism(req)
            .select("o_orderkey", F.posexplode_outer(X.extract_numbers(F.col("prompt"))).alias("pos", "num"))
            .filter(F.col("num").isNotNull())
            .select("o_orderkey", F.col("pos").cast("int").alias("pos"), "num"))


@register("extract_numbers_documents")
def extract_numbers_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 over whole documents, summarised per language."""
    d = ensure_parallelism(table(spark, sf_dir, "documents").select("lang", "text"))
    nums = d.select("lang", X.extract_numbers(F.col("text")).alias("nums"))
    return (nums.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(F.size("nums") > 0).alias("n_docs_with_numbers"),
        F.sum(F.size("nums")).cast("bigint").alias("n_numbers"),
        F.sum(F.size(F.filter("nums", lambda x: x.startswith("-")))).cast("bigint").alias("n_negative"),
        F.sum(F.size(F.filter("nums", lambda x: x.contains(".")))).cast("bigint").alias("n_decimal"),
        F.max(F.size("nums")).cast("int").alias("max_per_doc")))


@register("substitute_args")
def substitute_args(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source text, regex and replacement of substitution requests over part."""
    req = ensure_parallelism(table(spark, sf_dir, "part")).select("p_partkey",
                                                                  R.substitute_prompt().alias("prompt"))
    b = _bound(req, spark, "fn_substitute_string_with_regex")
    return b.select("p_partkey", _arg(0, "v_str").alias("source_string"),
                    _arg(1, "v_str").alias("regex"), _arg(2, "v_str").alias("replacement"))


@register("quoted_pair")
def quoted_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two strings of concatenation requests over part."""
    req = ensure_parallelism(table(spark, sf_dir, "part")).select("p_partkey",
                                                                  R.pair_prompt().alias("prompt"))
    b = _bound(req, spark, "fn_concatenate_strings")
    return b.select("p_partkey", _arg(0, "v_str").alias("s1"), _arg(1, "v_str").alias("s2"))


@register("longest_quoted_pages")
def longest_quoted_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longest quoted string of each whole web page."""
    p = ensure_parallelism(table(spark, sf_dir, "pages").select("page_id", "html"))
    q = p.select("page_id", X.extract_quoted(F.col("html")).alias("q"))
    longest = X.longest_of(F.col("q"))
    return q.select("page_id", F.size("q").cast("int").alias("n_quoted"),
                    F.nullif(longest, F.lit("")).alias("longest"),
                    F.length(longest).cast("int").alias("longest_len"))


@register("name_after_keyword")
def name_after_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the name after 'greet' in requests over nation, customer and supplier."""
    n = table(spark, sf_dir, "nation").select(F.lit("nation").alias("src"),
                                              F.col("n_nationkey").cast("bigint").alias("key"),
                                              F.concat(F.lit("Greet "), "n_name").alias("prompt"))
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("src"),
                                                F.col("c_custkey").cast("bigint").alias("key"),
                                                F.concat(F.lit("greet "), "c_name").alias("prompt"))
    s = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("src"),
                                                F.col("s_suppkey").cast("bigint").alias("key"),
                                                F.concat(F.lit("Please GREET  "), "s_name").alias("prompt"))
    b = _bound(n.unionByName(c).unionByName(s), spark, "fn_greet")
    return b.select("src", "key", _arg(0, "v_str").alias("name"))


@register("bind_mixed_fold")
def bind_mixed_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 fold with a mixed signature: a string argument's pick blocks an equal number later."""
    cat = C.catalog_from_rows(spark, [("fn_repeat_text", [("s", "str"), ("n", "int"), ("m", "float")],
                                       "str")])
    p = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("Repeat '"), R.s(F.col("p_size") % 4), F.lit("' "),
                              R.s(F.col("p_partkey") % 4), F.lit(" times, then "),
                              R.s(F.col("p_size") % 3), F.lit(" more")).alias("prompt"))
    b = type_picks(bind_arguments(_with_function(p, cat, "fn_repeat_text")))
    return b.select("p_partkey", _arg(0, "v_str").alias("s"), _arg(1, "v_int").alias("n"),
                    _arg(2, "v_float").alias("m"))


@register("bind_closed_form")
def bind_closed_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 closed form (k-th distinct number) on max requests over orders; equal numbers give 0."""
    o = ensure_parallelism(table(spark, sf_dir, "orders")).select(
        "o_orderkey", F.concat(F.lit("Find the max of "), R.s(F.col("o_custkey") % 10), F.lit(" and "),
                               R.s(F.col("o_orderkey") % 10)).alias("prompt"))
    cat = C.catalog_from_rows(spark)
    b = type_picks(bind_arguments(_with_function(o, cat, "fn_max_of_two"), method="closed"))
    return b.select("o_orderkey", _arg(0, "v_float").alias("a"), _arg(1, "v_float").alias("b"))


# --- conversion -------------------------------------------------------------------

_RAW_VALUES = ["5.", "-3.9", "abc", "", "yes", "TRUE", "1e3", "007"]


@register("convert_args")
def convert_args(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M7: typed conversion of text values spread over all of lineitem."""
    li = ensure_parallelism(table(spark, sf_dir, "lineitem"))
    k = F.col("l_linenumber") % 4
    raw = (F.when(k == 0, R.dec_text("l_extendedprice"))
           .when(k == 1, F.concat(F.lit("-"), R.int_text("l_quantity")))
           .when(k == 2, F.element_at(F.array(*[F.lit(v) for v in _RAW_VALUES]),
                                      (F.col("l_orderkey") % len(_RAW_VALUES) + 1).cast("int")))
           .otherwise(F.when(F.col("l_orderkey") % 3 == 0, F.lit(None).cast("string"))
                      .otherwise(F.col("l_returnflag"))))
    types = F.array(*[F.lit(t) for t in ("int", "float", "bool", "str", "date")])
    arg_type = F.element_at(types, (F.col("l_orderkey") % 5 + 1).cast("int"))
    df = li.select("l_orderkey", "l_linenumber", raw.alias("raw"), arg_type.alias("arg_type"))
    c = convert_text(F.col("raw"), F.col("arg_type"))
    return df.select("l_orderkey", "l_linenumber", "arg_type", "raw",
                     *[c[v].alias(v) for v in VALUE_FIELDS], c["issue"].alias("issue"))


# --- validation ---------------------------------------------------------------------

def _conversation_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    cv = table(spark, sf_dir, "conversations")
    k = (F.col("conv_id") + F.col("turn")) % 11
    prompt = (F.when(k == 0, F.lit("   "))
              .when(k == 1, F.lit(""))
              .when(k == 2, F.lit(None).cast("string"))
              .when(k == 3, F.concat(F.lit("\t "), "text", F.lit(" 　\n")))
              .otherwise(F.col("text")))
    return cv.select("conv_id", "turn", prompt.alias("prompt"))


@register("validate_requests")
def validate_requests_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation turn as a request; blanks and nulls become rejects."""
    req = _conversation_requests(spark, sf_dir)
    valid, rejects = validate_requests(req)
    return (valid.select("conv_id", "turn", F.lit(None).cast("string").alias("issue"), "prompt")
            .unionByName(rejects.select("conv_id", "turn", "issue",
                                        F.lit(None).cast("string").alias("prompt"))))


@register("validation_report")
def validation_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid / rejected counts by reason."""
    req = _conversation_requests(spark, sf_dir)
    from callsmith.operators.validate import request_issue
    return validation_report(req.withColumn("issue", request_issue(F.col("prompt"))))


def _part_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    name = F.concat(F.lit("fn_"), F.regexp_replace("p_name", " ", "_"))
    fn_name = (F.when(F.col("p_partkey") % 9 == 0, F.col("p_name"))
               .when(F.col("p_partkey") % 13 == 0, F.lit(""))
               .otherwise(name))
    args_names = F.array(F.lit("a"), F.lit("b"))
    args_types = F.when(F.col("p_partkey") % 7 == 0,
                        F.create_map(F.lit("a"), F.lit("float")))\
        .otherwise(F.create_map(F.lit("a"), F.lit("float"), F.lit("b"), F.lower("p_type")))
    ret = F.when(F.col("p_partkey") % 11 == 0, F.lit("")).otherwise(F.lit("float"))
    return p.select(F.col("p_partkey").alias("ord"), fn_name.alias("fn_name"),
                    args_names.alias("args_names"), args_types.alias("args_types"),
                    ret.alias("return_type"))


@register("validate_catalog")
def validate_catalog_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions built from part, some broken; the first failed rule per row."""
    defs = _part_definitions(spark, sf_dir)
    valid, rejects = C.validate_catalog(defs, strict=False)
    return (valid.select(F.col("ord").alias("p_partkey"), "fn_name",
                         F.lit(None).cast("string").alias("issue"))
            .unionByName(rejects.select(F.col("ord").alias("p_partkey"), "fn_name", "issue")))


@register("dedupe_catalog")
def dedupe_catalog_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: part names as function names; last definition wins at the first position."""
    p = table(spark, sf_dir, "part")
    defs = p.select(F.col("p_partkey").alias("ord"),
                    F.concat(F.lit("fn_"), F.regexp_replace("p_name", " ", "_")).alias("fn_name"),
                    F.array(F.lit("x")).alias("args_names"),
                    F.create_map(F.lit("x"), F.lower("p_type")).alias("args_types"),
                    F.col("p_brand").alias("return_type"))
    d = C.dedupe_catalog(defs)
    return d.select("ord", "fn_name", "return_type",
                    F.element_at("args_types", F.lit("x")).alias("x_type"))


# --- selection and the whole job ---------------------------------------------------

@register("select_function")
def select_function_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lexical closed-set selection over requests from seven tables."""
    req = ensure_parallelism(R.mixed_requests(spark, sf_dir))
    sel = select_function(req, C.catalog_from_rows(spark))
    return sel.select("src", "key", "fn_name", F.col("fn_score").cast("int").alias("fn_score"))


@register("select_function_join")
def select_function_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 keyword-join form (used for catalogues too large to ship to every task)."""
    req = R.mixed_requests(spark, sf_dir)
    sel = select_function(req, C.catalog_from_rows(spark), key_cols=["src", "file_id", "row_index"],
                          method="join")
    return sel.select("src", "key", "fn_name", F.col("fn_score").cast("int").alias("fn_score"))


def _mixed_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    req = ensure_parallelism(R.mixed_requests(spark, sf_dir))
    valid, _ = validate_requests(req)
    return propose_calls(valid, C.catalog_from_rows(spark))


@register("run_job")
def run_job_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: the whole pipeline on mixed requests, one row per (call, argument)."""
    calls = _mixed_job(spark, sf_dir)
    return explode_picks(calls, ["src", "key", "fn_name"])


@register("run_job_scored")
def run_job_scored_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 with a table scorer (X2): each part request walks the catalogue under the embedding of
    its id and its arguments are bound; parts without one get the first function."""
    from callsmith.operators.scorer import TableScorer
    req = ensure_parallelism(table(spark, sf_dir, "part")).select("p_partkey",
                                                                  R.part_prompt().alias("prompt"))
    scores = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("p_partkey"), "embedding")
    job = run_job(req.join(scores, "p_partkey", "left"), C.catalog_from_rows(spark),
                  scorer=TableScorer("embedding"))
    return explode_picks(job.calls, ["p_partkey", "fn_name"])


@register("run_summary")
def run_summary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over the whole job's calls and rejects, in one pass."""
    from callsmith.plans.job import summarize_requests
    return summarize_requests(R.mixed_requests(spark, sf_dir), C.catalog_from_rows(spark))


@register("select_candidate")
def select_candidate_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2, T5: candidates from whole documents (quoted strings, else numbers); first wins."""
    d = ensure_parallelism(table(spark, sf_dir, "documents").select("doc_id", "text"))
    quoted = X.extract_any_quoted(F.col("text"))
    cands = F.when(F.size(quoted) > 0, quoted).otherwise(X.extract_numbers(F.col("text")))
    from callsmith.operators.select import select_candidate
    return d.select("doc_id", F.size(cands).cast("int").alias("n_cands"),
                    select_candidate(cands).alias("chosen"))


# --- raw calls: resolve, anti-join, decode -----------------------------------------

EVENT_CATALOG = [
    ("fn_click", [("k", "int"), ("v", "float")], "bool"),
    ("fn_view", [("k", "str")], "str"),
    ("fn_purchase", [("k", "bool"), ("note", "str")], "float"),
]


def _raw_event_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = ensure_parallelism(table(spark, sf_dir, "events"))
    return ev.select("event_id", F.concat(F.lit("fn_"), "event_type").alias("raw_fn"),
                     F.try_parse_json("props").alias("raw_args"))


@register("resolve_calls")
def resolve_calls_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call names from events resolved against a 3-entry catalogue."""
    r = resolve_function(_raw_event_calls(spark, sf_dir),
                         C.catalog_from_rows(spark, EVENT_CATALOG))
    return r.select("event_id", "raw_fn", "fn_name", "fn_unknown")


@register("unknown_calls")
def unknown_calls_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls whose name is not in the catalogue."""
    u = unknown_calls(_raw_event_calls(spark, sf_dir), C.catalog_from_rows(spark, EVENT_CATALOG))
    return u.select("event_id", "raw_fn")


@register("decode_calls")
def decode_calls_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events' props as raw arguments, typed per declared argument."""
    d = decode_calls(_raw_event_calls(spark, sf_dir), C.catalog_from_rows(spark, EVENT_CATALOG))
    return explode_picks(d, ["event_id", "fn_name", "is_fallback"])


def _mixed_payload():
    """Raw arguments in eight shapes, by event; ``k`` is the number in the event's props."""
    k = F.get_json_object("props", "$.k")
    shapes = [F.lit("null"), F.concat(F.lit('"'), k, F.lit('"')),
              F.concat(F.lit('{"k":'), k, F.lit('.5,"v":"-'), k, F.lit('.5e1"}')),
              F.lit('{"k":true,"v":false}'), F.concat(F.lit('{"k":['), k, F.lit('],"v":{"a":1}}')),
              F.lit('{"k":"Infinity","v":1}'), F.concat(F.lit('{"k":"yes","v":"abc","note":"n'), k, F.lit('"}')),
              F.concat(F.lit('{"k":92233720368547758'), F.lpad(k, 2, "0"), F.lit('}'))]
    shape = F.col("event_id") % len(shapes)
    out = F.lit(None).cast("string")
    for i, text in enumerate(shapes):
        out = F.when(shape == i, text).otherwise(out)
    return out


@register("decode_mixed_calls")
def decode_mixed_calls_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads that are null, text, numbers, booleans, nested,
    infinite or beyond BIGINT, and blank requests; arguments packed as JSON in declared order."""
    ev = ensure_parallelism(table(spark, sf_dir, "events"))
    raw = ev.select("event_id", F.concat(F.lit("fn_"), "event_type").alias("raw_fn"),
                    F.try_parse_json(_mixed_payload()).alias("raw_args"),
                    F.when(F.col("event_id") % 9 == 0, " \t").otherwise(F.col("props")).alias("prompt"))
    d = decode_calls(raw, C.catalog_from_rows(spark, EVENT_CATALOG), text_col="prompt")
    return d.select("event_id", "fn_name", "is_fallback", pack_arguments(F.col("picks")).alias("args"))


FLAG_CATALOG = [("fn_flag", [("id", "int"), ("active", "bool"), ("again", "int"), ("name", "str")], "bool")]


@register("bind_flag")
def bind_flag_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bool argument between numeric ones; the number bound first is not reused."""
    req = ensure_parallelism(table(spark, sf_dir, "customer")).select("c_custkey", F.concat(
        F.lit("Flag customer "), F.col("c_custkey").cast("string"), F.lit(' of "'), F.col("c_mktsegment"),
        F.lit('" in nation '), F.col("c_nationkey").cast("string")).alias("prompt"))
    calls = propose_calls(req, C.catalog_from_rows(spark, FLAG_CATALOG))
    return calls.select("c_custkey", "fn_name", pack_arguments(F.col("picks")).alias("args"))


SHIP_CATALOG = [("fn_ship", [("order_no", "int"), ("code", "str"), ("n", "int")], "str")]
SHIP_RULES = [("int", "fn_ship", "order_no", r"regex:#(\d+)"), (None, None, "code", r"regex:code ([A-Z]\d+)"),
              ("int", None, None, "numbers")]


@register("bind_user_rules")
def bind_user_rules_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16, K3: a user's extraction rules as rows; the number bound by one rule is no candidate of another."""
    req = ensure_parallelism(table(spark, sf_dir, "orders")).select("o_orderkey", F.concat(
        F.lit("Ship "), R.s(F.col("o_custkey") % 50), F.lit(" of #"), R.s("o_orderkey"), F.lit(" with code K"),
        R.s("o_custkey")).alias("prompt"))
    rules = spark.createDataFrame([(i, *r) for i, r in enumerate(SHIP_RULES)],
                                  "ord int, arg_type string, fn_name string, arg_name string, extractor string")
    calls = propose_calls(req, C.catalog_from_rows(spark, SHIP_CATALOG), rules=rules)
    return calls.select("o_orderkey", "fn_name", _arg(0, "v_int").alias("order_no"), _arg(1, "v_str").alias("code"),
                        _arg(2, "v_int").alias("n"))


# --- prefix index over whole documents ------------------------------------------

def _document_sequences(spark: SparkSession, sf_dir: str):
    """Documents and their whole-text token expression (tokenised after the shuffle)."""
    from callsmith.operators.prefix import word_tokens
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d, word_tokens(F.col("text"))


@register("allowed_next_tokens")
def allowed_next_tokens_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trie edge of the documents' whole token sequences."""
    from callsmith.operators.prefix import allowed_next
    d, toks = _document_sequences(spark, sf_dir)
    return allowed_next(d, "doc_id", toks)


@register("merge_prefix_index")
def merge_prefix_index_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges of ``allowed_next_tokens`` from a stored index, to which the documents are added in two
    batches by id, each written as its own edges alone."""
    from callsmith.operators import index_store
    from callsmith.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark)}/prefix-index-{uuid.uuid4().hex}"
    d, toks = _document_sequences(spark, sf_dir)
    even = F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False))
    for name, batch in (("even", d.filter(even)), ("odd", d.filter(~even))):
        index_store.append_batch(batch, path, name, "doc_id", toks)
    return index_store.stored_allowed_next(spark, path)


@register("shortest_unique_prefix")
def shortest_unique_prefix_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, A4: where a greedy walk along each document's tokens becomes unique."""
    from callsmith.operators.prefix import shortest_unique_prefix
    d, toks = _document_sequences(spark, sf_dir)
    return shortest_unique_prefix(d, "doc_id", toks)


def _permitted(vec_id, label):
    # Some ids beyond the vector, which are not permitted.
    return F.filter(F.sequence(F.lit(0), F.size("embedding") + 7),
                    lambda i: i % (label + 2) == vec_id % (label + 2))


@register("masked_argmax")
def masked_argmax_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best permitted token per score vector (embeddings as scores), in-row."""
    from callsmith.operators.prefix import masked_argmax
    e = table(spark, sf_dir, "embeddings")
    best = masked_argmax(F.col("embedding"), _permitted(F.col("vec_id"), F.col("label")))
    return e.select("vec_id", best["token_id"].alias("token_id"), best["score"].alias("score"))


@register("masked_argmax_long")
def masked_argmax_long_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 long form: semi-join of exploded scores with the permitted table, max per key."""
    from callsmith.operators.prefix import masked_argmax_long
    e = table(spark, sf_dir, "embeddings")
    scores = e.select(F.col("vec_id").alias("req_id"),
                      F.posexplode("embedding").alias("token_id", "score"))
    permitted = e.select(F.col("vec_id").alias("req_id"),
                         F.explode(_permitted(F.col("vec_id"), F.col("label"))).alias("token_id"))
    return masked_argmax_long(scores, permitted).withColumnRenamed("req_id", "vec_id")


# --- token tables ------------------------------------------------------------------

def _raw_token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary-like table from whole documents: marker-decorated tokens, first occurrence order."""
    from callsmith.operators.prefix import word_tokens
    d = ensure_parallelism(table(spark, sf_dir, "documents").select("doc_id", "text"))
    t = (d.select("doc_id", F.posexplode_outer(word_tokens(F.col("text"))).alias("pos", "w"))
         .filter(F.col("w").isNotNull()))
    k = F.col("pos") % 3
    raw = (F.when(k == 0, F.concat(F.lit("Ġ"), "w")).when(k == 1, F.concat(F.lit("▁"), "w"))
           .otherwise(F.concat("w", F.lit("</w>"))))
    ordkey = F.col("doc_id") * F.lit(1 << 31) + F.col("pos")  # a text has fewer than 2^31 tokens
    return (t.select(raw.alias("token"), ordkey.alias("o")).groupBy("token")
            .agg(F.min("o").alias("ord"))
            .select("ord", "token", F.col("ord").alias("token_id")))


@register("normalize_tokens")
def normalize_tokens_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised vocabulary; the last entry wins on collisions."""
    from callsmith.operators.tokens import normalize_token_table
    n = normalize_token_table(_raw_token_table(spark, sf_dir))
    return n.select("token", "token_id", "n_raw")


@register("token_table_report")
def token_table_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct raw and normalised tokens, from one pass over the raw table."""
    from callsmith.operators.tokens import normalize_token
    raw = _raw_token_table(spark, sf_dir)
    return raw.agg(F.count(F.lit(1)).alias("n_raw_tokens"),
                   F.count_distinct(normalize_token(F.col("token"))).alias("n_tokens"))


@register("invert_tokens")
def invert_tokens_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id-keyed entries (some keys not integers) → id to token, last entry wins."""
    from callsmith.operators.tokens import invert_token_table
    raw = _raw_token_table(spark, sf_dir)
    key = (F.when(F.col("ord") % 10 == 0, F.concat(F.lit("x"), F.col("ord").cast("string")))
           .otherwise((F.col("ord") - F.when(F.col("ord") % 100 == 1, 1).otherwise(0)).cast("string")))
    pairs = raw.select(key.alias("key"), F.col("token").alias("value"), "ord")
    return invert_token_table(pairs)


@register("encode_tokens")
def encode_tokens_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts encoded with the documents' normalised table, and decoded back."""
    from callsmith.operators.tokens import (decode_with_table, encode_with_table,
                                            normalize_token_table)
    from callsmith.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    # The vocabulary is built from every document once and cut with a reliable
    # checkpoint (shared folder): both the encode and the decode join read it,
    # instead of each re-scanning the corpus.
    vocab = normalize_token_table(_raw_token_table(spark, sf_dir)).select("token", "token_id") \
        .checkpoint()
    b = ensure_parallelism(table(spark, sf_dir, "benchmark"))
    enc = encode_with_table(b, vocab, "item_id")
    dec = decode_with_table(enc, vocab, "item_id")
    return (enc.join(dec, "item_id")
            .select("item_id", F.col("n_tokens").cast("bigint").alias("n_tokens"),
                    F.col("n_unknown").cast("bigint").alias("n_unknown"),
                    F.array_join(F.transform("ids", lambda i: i.cast("string")), " ").alias("ids"),
                    F.col("text").alias("decoded")))


@register("encode_longest")
def encode_longest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts cut into the longest entries of the documents' normalised vocabulary, and decoded back."""
    from callsmith.operators.longest import decode_longest, encode_longest
    from callsmith.operators.tokens import normalize_token_table
    from callsmith.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    vocab = normalize_token_table(_raw_token_table(spark, sf_dir)).select("token", "token_id").checkpoint()
    b = ensure_parallelism(table(spark, sf_dir, "benchmark").select("item_id", "text"))
    enc = encode_longest(b, vocab, "item_id")
    dec = decode_longest(enc, vocab, "item_id").withColumnRenamed("text", "decoded")
    return enc.join(dec, "item_id").select(
        "item_id", "n_tokens", "n_unknown", F.array_join(F.transform("ids", lambda i: i.cast("string")), " ").alias("ids"), "decoded")


# --- prefix-mode selection -----------------------------------------------------------

@register("constrained_walk")
def constrained_walk_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 prefix mode, K9, T3: each embedding row walks the tokenised catalogue greedily.

    The oracle is a recursive CTE; tests also compare it with a brute-force walk.
    """
    from callsmith.operators.walk import constrained_walk
    e = ensure_parallelism(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    w = constrained_walk(e, C.catalog_from_rows(spark), "embedding")
    return w.select("vec_id", "fn_name", F.col("walk_steps").cast("int").alias("walk_steps"),
                    "walk_unique")


def _part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A definition for every row of part (names repeat)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ord"),
        F.concat(F.lit("fn_"), F.regexp_replace("p_name", " ", "_")).alias("fn_name"),
        F.array(F.lit("x"), F.lit("n")).alias("args_names"),
        F.create_map(F.lit("x"), F.lower("p_type"), F.lit("n"), F.lit("int")).alias("args_types"),
        F.col("p_brand").alias("return_type"))


@register("walk_part_catalog")
def walk_part_catalog_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 prefix mode, K9, A1 over a catalogue that grows with the data: a definition for every
    part; each embedding, repeated to cover the vocabulary, is a score vector."""
    from callsmith.operators.walk import constrained_walk
    e = ensure_parallelism(table(spark, sf_dir, "embeddings")).select(
        "vec_id", F.flatten(F.array_repeat("embedding", 32)).alias("scores"))
    return constrained_walk(e, _part_catalog(spark, sf_dir), "scores").select(
        "vec_id", "fn_name", "walk_steps", "walk_unique")


@register("walk_part_catalog_join")
def walk_part_catalog_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 prefix mode, K9, T3 by joins with the path-compressed trie, as for a catalogue that is too large to
    be shipped: ``walk_part_catalog``'s definitions and scores."""
    from callsmith.operators.walk import constrained_walk
    e = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.flatten(F.array_repeat("embedding", 32)).alias("scores"))
    return constrained_walk(e, _part_catalog(spark, sf_dir), "scores", form="join").select(
        "vec_id", "fn_name", "walk_steps", "walk_unique")


@register("choose_candidates_model")
def choose_candidates_model_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2, J7, T2, X1 in the whole job: both numbers of a request are chosen among three candidates by a
    character model that is learnt from every document; the second choice leaves the first one out."""
    from callsmith.operators.choose import bigram_model
    c = table(spark, sf_dir, "customer").select("c_custkey", F.concat(
        F.lit("Find the max of "), R.dec_text("c_acctbal"), F.lit(" and "), R.s("c_custkey"), F.lit(" and "),
        R.s(F.col("c_custkey") % 97)).alias("prompt"))
    job = run_job(ensure_parallelism(c), C.catalog_from_rows(spark), candidate_policy="model",
                  candidate_scorer=bigram_model(ensure_parallelism(table(spark, sf_dir, "documents").select("text"))))
    return explode_picks(job.calls, ["c_custkey", "fn_name"]).select("c_custkey", "fn_name", "arg_name", "v_float")


@register("load_request_array")
def load_request_array_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests of one large JSON array file, read in parallel by splits.  The file is
    written first from every order, in key order."""
    from callsmith.sources.json_records import load_requests
    from callsmith.sources.sink import joined_lines
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_json(F.struct(
        F.concat(F.lit(' Note, "max" of '), R.s("o_custkey"), F.lit(" [and], "), R.s("o_orderkey"), F.lit(" ")).alias("prompt"),
        F.col("o_orderstatus").alias("status"))).alias("v"))
    ends = o.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    lines = o.orderBy("o_orderkey").select(F.concat(
        F.when(F.col("o_orderkey") == ends[0], "[").otherwise(","), "v",
        F.when(F.col("o_orderkey") == ends[1], "]").otherwise("")))
    path = shared_path(spark, "requests")
    # Sorted, formatted and joined in parallel; the one task that writes the file only copies megabytes of lines.
    joined_lines(lines).checkpoint().coalesce(1).write.text(path)
    valid, _ = load_requests(spark, path, form="split")
    return valid.select("req_id", "prompt")


@register("catalog_fingerprints")
def catalog_fingerprints_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-insensitive fingerprint of every definition built from part."""
    return _part_catalog(spark, sf_dir).select("ord", "fn_name", C.definition_fingerprint().alias("fingerprint"))


# --- streaming -----------------------------------------------------------------------

@register("stream_calls")
def stream_calls_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum requests from lineitem read as a file stream, processed to a parquet sink
    (availableNow), then read back; same result as ``bind_two_numbers``."""
    from callsmith.streaming.stream import run_stream_to_parquet, stream_calls
    path = f"{sf_dir}/lineitem.parquet"
    schema = spark.read.parquet(path).schema
    # As a glob, the table may be one file or a folder of part files.
    src = spark.readStream.schema(schema).parquet(f"{sf_dir}/lineitem.parque[t]").select(
        "l_orderkey", "l_linenumber", "l_quantity").repartition(default_parallelism(spark))  # a file may be one split
    calls = stream_calls(R.lineitem_sum_requests(src), C.catalog_from_rows(spark))
    flat = calls.select("l_orderkey", "l_linenumber", "fn_name",
                        _arg(0, "v_float").alias("a"), _arg(1, "v_float").alias("b"))
    query, out = run_stream_to_parquet(spark, flat, f"sum-{zlib.crc32(path.encode()):08x}")
    query.awaitTermination()
    return spark.read.parquet(out)


@register("model_walk")
def model_walk_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1, X2 + K1 prefix mode: a model scorer (Arrow batches) scores every mixed request
    over the catalogue vocabulary, then each request walks the catalogue trie.

    The oracle recomputes the double's scores in SQL (non-overlapping
    substring counts) and walks with the same recursive CTE as
    ``constrained_walk``.
    """
    from callsmith.operators.scorer import substring_count_model
    from callsmith.operators.walk import catalog_sequences, constrained_walk
    cat = C.catalog_from_rows(spark)
    vocab = sorted({t for r in catalog_sequences(cat).select("tokens").collect() for t in r["tokens"]})
    req = ensure_parallelism(R.mixed_requests(spark, sf_dir).select("src", "key", "prompt"))
    # Equal requests are scored and walk once; the answers are joined back by the text.
    scored = substring_count_model().scores(spread(req.select("prompt").distinct()), "prompt", vocab)
    w = constrained_walk(scored, cat, "scores").select(
        F.col("prompt").alias("asked"), "fn_name", F.col("walk_steps").cast("int").alias("walk_steps"), "walk_unique")
    return req.join(w, F.col("prompt").eqNullSafe(F.col("asked"))).select("src", "key", "fn_name", "walk_steps", "walk_unique")


@register("walk_step_scores")
def walk_step_scores_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 prefix mode with step-dependent scores from a long score table.

    Token t at step k scores ``embedding[(t + k) % 64]``; token 7 has no score
    row at even steps.  One shuffle by walker (see
    ``constrained_walk_table``); the oracle is a recursive CTE.
    """
    from callsmith.operators.walk import catalog_sequences, constrained_walk_table
    cat = C.catalog_from_rows(spark)
    seqs = catalog_sequences(cat).select("ids").collect()  # the constant 20-entry catalogue
    vocab = 1 + max(max(r["ids"]) for r in seqs)
    e = ensure_parallelism(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    steps = F.sequence(F.lit(0), F.lit(max(len(r["ids"]) for r in seqs) - 1))
    toks = F.sequence(F.lit(0), F.lit(vocab - 1))
    scores = (e.select("vec_id", "embedding", F.explode(steps).alias("step"))
              .select("vec_id", "step", "embedding", F.explode(toks).alias("token_id"))
              .filter(~((F.col("token_id") == 7) & (F.col("step") % 2 == 0)))
              .select("vec_id", "step", "token_id",
                      F.get("embedding", (F.col("token_id") + F.col("step")) % 64).alias("score")))
    w = constrained_walk_table(e.select("vec_id"), cat, scores, key="vec_id")
    return w.select("vec_id", "fn_name", F.col("walk_steps").cast("int").alias("walk_steps"),
                    "walk_unique")


@register("model_walk_steps")
def model_walk_steps_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 + K1 prefix mode with a live model: part requests walk the catalogue
    while a model scorer (mapInPandas) re-scores every step given the ids
    generated so far.  The oracle recomputes the double's scores in the CTE."""
    from callsmith.operators.scorer import prefix_aware_model
    from callsmith.operators.walk import constrained_walk_model
    req = ensure_parallelism(table(spark, sf_dir, "part")).select("p_partkey",
                                                                  R.part_prompt().alias("prompt"))
    w = constrained_walk_model(req, C.catalog_from_rows(spark), prefix_aware_model(), "prompt",
                               "p_partkey")
    return w.select("p_partkey", "fn_name", F.col("walk_steps").cast("int").alias("walk_steps"),
                    "walk_unique")
