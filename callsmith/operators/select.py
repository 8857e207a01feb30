"""Closed-set function selection (K1, J1, W1) and candidate selection.

The default scorer is lexical and deterministic: a catalogue entry scores the
number of its distinct keywords that occur as whole words of the lower-cased
request.  The best score wins, ties go to the lowest catalogue position, and a
best score of 0 falls back to the first function (as the reference does when
no unique match is found).

Two physical forms, chosen by a bounded count of the catalogue:

* in-row (catalogue ≤ ``MAX_BROADCAST_CATALOG`` entries): the catalogue is
  collected into one broadcast row and every request takes the argmax over
  it in-row.  One BroadcastNestedLoopJoin against a single row, no shuffle of
  the requests.
* keyword join (larger catalogues): request words are exploded and
  equi-joined to the keyword table, scores are counted per (request, entry)
  with map-side partial aggregation and the best entry per request is a
  ``max`` of (score, -ord), so hot keywords never
  collect a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsmith import fixed
from callsmith.operators.catalog import arg_specs_column, collect_entries, dedupe_catalog
from callsmith.session import ensure_checkpoint_dir

WORD_PATTERN = "[a-z0-9_]+"


def request_words(text: Column) -> Column:
    """Distinct lower-case ASCII word tokens of a request."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0)))


def default_keywords(catalog: DataFrame, aliases: dict | None = None) -> DataFrame:
    """``(fn_name, keyword)``: name parts minus stop words, plus an alias table."""
    spark = catalog.sparkSession
    aliases = fixed.KEYWORD_ALIASES if aliases is None else aliases
    parts = (catalog.select("fn_name", F.explode(F.split("fn_name", "_")).alias("keyword"))
             .filter(~F.col("keyword").isin(*fixed.KEYWORD_STOPWORDS) & (F.col("keyword") != "")))
    alias_rows = [(fn, kw) for fn, kws in aliases.items() for kw in kws]
    extra = spark.createDataFrame(alias_rows or [("", "")], "fn_name string, keyword string")
    extra = extra.join(catalog.select("fn_name"), "fn_name", "left_semi")
    return parts.unionByName(extra).distinct()


def default_keyword_sets(names, aliases: dict | None = None) -> dict[str, set[str]]:
    """The same rule as ``default_keywords`` for a collected (small) catalogue."""
    aliases = fixed.KEYWORD_ALIASES if aliases is None else aliases
    out = {}
    for n in names:
        kws = {p for p in n.split("_") if p and p not in fixed.KEYWORD_STOPWORDS}
        out[n] = kws | set(aliases.get(n, ()))
    return out


class LexicalScorer:
    """Keyword-count scorer; ``keywords`` is a ``(fn_name, keyword)`` DataFrame."""

    name = "lexical"

    def __init__(self, keywords: DataFrame | None = None, aliases: dict | None = None):
        self.keywords = keywords
        self.aliases = aliases

    def keyword_table(self, catalog: DataFrame) -> DataFrame:
        if self.keywords is not None:
            return self.keywords
        return default_keywords(catalog, self.aliases)

    def keyword_sets(self, entries) -> dict[str, set[str]]:
        """Keywords of a collected catalogue, without a Spark job for the default rule."""
        if self.keywords is None:
            return default_keyword_sets([e["fn_name"] for e in entries], self.aliases)
        kw: dict[str, set[str]] = {}
        for r in self.keywords.collect():
            kw.setdefault(r["fn_name"], set()).add(r["keyword"])
        return kw


def select_function(requests: DataFrame, catalog: DataFrame, scorer: LexicalScorer | None = None,
                    text_col: str = "prompt", key_cols: list[str] | None = None,
                    method: str = "auto") -> DataFrame:
    """Add ``fn_ord, fn_name, fn_args, fn_score, fn_fallback`` to every request.

    ``key_cols`` (a unique key of the requests) saves the keyword-join form
    from numbering and checkpointing the requests.  A scorer with a ``walk`` method
    (``TableScorer``, ``ModelScorer``) selects by a constrained walk; ``fn_score`` is then the
    number of tokens walked and ``fn_failed`` says that the scorer raised for the request.
    """
    scorer = scorer or LexicalScorer()
    if hasattr(scorer, "walk"):
        specs = dedupe_catalog(catalog).select(F.col("ord").alias("_ord"),
                                               arg_specs_column().alias("fn_args"))
        walked = scorer.walk(requests, catalog, text_col).join(specs, F.col("fn_ord") == F.col("_ord"))
        return walked.select(*requests.columns, "fn_ord", "fn_name", "fn_args",
                             F.col("walk_steps").alias("fn_score"),
                             (~F.col("walk_unique")).alias("fn_fallback"),
                             F.col("walk_failed").alias("fn_failed"))
    entries = collect_entries(catalog) if method in ("auto", "inrow") else None
    if method == "inrow" and entries is None:
        raise ValueError("catalogue too large for the in-row form")
    if entries is not None:
        return _select_inrow(requests, entries, scorer.keyword_sets(entries), text_col)
    catalog = dedupe_catalog(catalog)
    if key_cols:
        return _select_join(requests, catalog, scorer.keyword_table(catalog), text_col, key_cols)
    # Without a key the requests are numbered once and cut reliably, so both
    # branches of the join read the same numbers.
    ensure_checkpoint_dir(requests.sparkSession)
    numbered = requests.withColumn("_request", F.monotonically_increasing_id()).checkpoint()
    return _select_join(numbered, catalog, scorer.keyword_table(catalog), text_col,
                        ["_request"]).drop("_request")


ENTRY_TYPE = ("struct<ord:bigint,fn_name:string,kws:array<string>,"
              "args:array<struct<arg_ord:int,arg_name:string,arg_type:string>>>")


def _select_inrow(requests, entries, kw, text_col):
    """Argmax over a broadcast catalogue, in-row, touching only the entries hit.

    The (size-checked) catalogue travels as one broadcast row holding the
    entries in ``ord`` order and a keyword → entry positions map.  Per
    request its words are looked up in a literal keyword set, then positions of
    the hit entries are counted and the best taken.  Ties go to the lowest position, i.e. the lowest ``ord``.
    """
    def entry(e):
        args = [(i, a, (e["args_types"] or {}).get(a)) for i, a in enumerate(e["args_names"] or [])]
        return (e["ord"], e["fn_name"], sorted(kw.get(e["fn_name"], ())), args)

    rows = [entry(e) for e in entries]
    kw2pos: dict[str, list[int]] = {}
    for i, r in enumerate(rows):
        for k in r[2]:
            kw2pos.setdefault(k, []).append(i)
    spark = requests.sparkSession
    const = spark.createDataFrame(
        [(rows, kw2pos)], f"_cat array<{ENTRY_TYPE}>, _kw2pos map<string,array<int>>")
    # A literal set: one hash lookup per distinct word, whatever the catalogue's size.
    known = sorted(kw2pos)
    hits = F.filter(request_words(F.col(text_col)),
                    lambda w: w.isin(*known) if known else F.lit(False))
    staged = (requests.crossJoin(F.broadcast(const))
              .withColumn("_pos", F.flatten(F.transform(hits, lambda w: F.element_at(F.col("_kw2pos"), w)))))
    # (score, -position) of every hit entry; the maximum is the winner.
    best = F.array_max(F.transform(F.array_distinct(F.col("_pos")), lambda i: F.struct(
        F.size(F.filter(F.col("_pos"), lambda x: x == i)).alias("score"), (-i).alias("neg"))))
    chosen = staged.withColumn("_b", best)
    pos = F.coalesce(-F.col("_b.neg"), F.lit(0))
    e = F.get(F.col("_cat"), pos)
    score = F.coalesce(F.col("_b.score"), F.lit(0))
    return chosen.select(*requests.columns, *[c.alias(n) for n, c in (
        ("fn_ord", e["ord"]), ("fn_name", e["fn_name"]), ("fn_args", e["args"]),
        ("fn_score", score), ("fn_fallback", score == 0))])


MAX_BROADCAST_KEYWORDS = 1_000_000
# Estimated (stored) bytes of requests in a partition of the keyword join, and the most partitions.
JOIN_BYTES = 4 << 20
MAX_JOIN_PARTITIONS = 20_000


def _select_join(requests, catalog, keywords, text_col, key_cols):
    """Keyword equi-join form for catalogues too large to ship whole.

    Sides that grow with the requests are joined with shuffle-merge hints so
    no runtime estimate can turn them into a broadcast; the keyword table is
    broadcast only behind a bounded count.
    """
    from callsmith.operators.decode import maybe_broadcast
    kw = keywords.join(catalog.select("fn_name", "ord"), "fn_name").select("keyword", "ord")
    # By key once, before any aggregate: the counts, the best and the join back all lie in these partitions, whose
    # number follows the input, so what a task holds does not grow with it.
    size = int(str(requests._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    requests = requests.repartition(max(least, min(size // JOIN_BYTES, MAX_JOIN_PARTITIONS)), *key_cols)
    words = requests.select(*key_cols, F.explode(request_words(F.col(text_col))).alias("keyword"))
    hits = words.join(maybe_broadcast(kw, MAX_BROADCAST_KEYWORDS), "keyword")
    best = (hits.groupBy(*key_cols, "ord").agg(F.count(F.lit(1)).alias("score"))
            .groupBy(*key_cols)
            .agg(F.max(F.struct("score", (-F.col("ord")).alias("neg"))).alias("best")))
    best = best.select(*key_cols, F.col("best.score").cast("int").alias("fn_score"),
                       (-F.col("best.neg")).alias("best_ord"))
    specs = catalog.select(F.col("ord").alias("best_ord"), F.col("fn_name").alias("best_name"),
                           arg_specs_column().alias("best_args"))
    first = catalog.select(F.min_by(F.struct("ord", "fn_name", arg_specs_column().alias("args")),
                                    F.col("ord")).alias("first"))
    out = (requests.join(best.hint("shuffle_merge"), key_cols, "left")
           .join(specs, "best_ord", "left")
           .crossJoin(F.broadcast(first)))
    use_best = F.coalesce(F.col("fn_score"), F.lit(0)) > 0
    return out.select(
        *requests.columns,
        F.when(use_best, F.col("best_ord")).otherwise(F.col("first.ord")).alias("fn_ord"),
        F.when(use_best, F.col("best_name")).otherwise(F.col("first.fn_name")).alias("fn_name"),
        F.when(use_best, F.col("best_args")).otherwise(F.col("first.args")).alias("fn_args"),
        F.coalesce(F.col("fn_score"), F.lit(0)).alias("fn_score"),
        (~use_best).alias("fn_fallback"))


def select_candidate(cands: Column, policy: str = "first", scores: Column | None = None) -> Column:
    """K2: 0 candidates → '', 1 → it, many → by policy.

    ``first`` keeps the first candidate (a lexical scorer cannot tell ``2``
    from ``3``).  ``scored`` walks the candidates' token sequences greedily
    under ``scores`` (see ``walk_candidates``); only multi-candidate rows walk.
    """
    first = F.coalesce(F.get(cands, 0), F.lit(""))
    if policy == "first":
        return first
    if policy == "scored":
        if scores is None:
            raise ValueError("the scored policy needs a scores column")
        return F.when(F.size(cands) > 1, walk_candidates(cands, scores)).otherwise(first)
    raise ValueError(f"unknown candidate policy {policy!r}")


def char_tokens(text: Column) -> Column:
    """Character-level token ids (code points) of a string."""
    return F.transform(F.split(text, ""), lambda ch: F.ascii(ch))


def walk_candidates(cands: Column, scores: Column, tokens=char_tokens, extra_steps: int = 5) -> Column:
    """K2 scored mode / J7: greedy constrained walk over a row's candidates.

    At each step the permitted tokens are the next tokens of the candidates
    that still match; the best-scoring one wins (lowest id on ties, ids beyond
    the score vector are not permitted).  The walk returns the first candidate
    whose whole token list equals the generated prefix, so a shorter candidate
    (``1``) wins over a longer one sharing its prefix (``12``).  No permitted
    token or no exact match within the bound → the first candidate.
    """
    toks = F.transform(cands, tokens)
    longest = F.aggregate(toks, F.lit(0), lambda m, t: F.greatest(m, F.size(t)))
    init = F.struct(toks.alias("t"), cands.alias("c"), scores.alias("s"),
                    F.array().cast("array<int>").alias("g"), F.lit(False).alias("done"),
                    F.lit(None).cast("string").alias("res"))

    def step(acc, _i):
        n = F.size(acc["g"])
        live = F.filter(acc["t"], lambda t: (F.size(t) > n) & (F.slice(t, 1, n) == acc["g"]))
        allowed = F.filter(F.array_distinct(F.transform(live, lambda t: F.get(t, n))),
                           lambda i: i < F.size(acc["s"]))
        best = F.array_max(F.transform(allowed, lambda i: F.struct(
            F.get(acc["s"], i).cast("double").alias("score"), (-i).alias("neg"))))
        g2 = F.concat(acc["g"], F.array((-best["neg"]).cast("int")))
        pos = F.array_position(F.transform(acc["t"], lambda t: t == g2), F.lit(True))
        moved = F.struct(acc["t"].alias("t"), acc["c"].alias("c"), acc["s"].alias("s"),
                         g2.alias("g"), (pos > 0).alias("done"),
                         F.when(pos > 0, F.element_at(acc["c"], pos.cast("int"))).alias("res"))
        stopped = F.struct(acc["t"].alias("t"), acc["c"].alias("c"), acc["s"].alias("s"),
                           acc["g"].alias("g"), F.lit(True).alias("done"), acc["res"].alias("res"))
        return F.when(acc["done"], acc).when(best.isNull(), stopped).otherwise(moved)

    walked = F.aggregate(F.sequence(F.lit(1), longest + extra_steps), init, step)
    return F.coalesce(walked["res"], F.get(cands, 0), F.lit(""))


def resolve_candidate(generated: Column, candidate_tokens: Column, candidates: Column) -> Column:
    """The candidate whose token list equals the generated tokens; the first one
    wins on equal lists; NULL when none matches."""
    pos = F.array_position(F.transform(candidate_tokens, lambda t: t == generated), F.lit(True))
    return F.when(pos > 0, F.element_at(candidates, pos.cast("int")))


def scoring_context(text: Column, arg_name: Column, cands: Column) -> Column:
    """The context string shown to a scorer; only the first 5 candidates."""
    shown = F.array_join(F.transform(F.slice(cands, 1, 5),
                                     lambda c: F.concat(F.lit('"'), c, F.lit('"'))), ", ")
    return F.format_string(fixed.ARGUMENT_CONTEXT, arg_name, shown, text)
