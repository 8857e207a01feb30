"""Closed-set selection by a constrained greedy walk (K1 prefix mode, K9, T3).

The catalogue is turned into token sequences (K9: compact JSON of each
definition, word-level tokens, ids from the catalogue's own vocabulary).
Those sequences form a trie.  A request walks it greedily: at each node the
permitted next tokens are the node's edges; the one with the highest score
wins (lowest id on ties; ids beyond the score vector are not permitted); the
walk stops with a result as soon as one sequence is left, and without one
when nothing permitted is left (then the first function is the fallback).

Sequences up to ``MAX_WALK_CHARS`` are shipped sorted to every task.  A
stretch of prefixes is then a range of rows, so the trie needs no nodes: a
walk jumps from branch to branch, and only branches that are reached are
ever looked at.  Each batch of requests walks to its end in one pass,
whatever the source of the scores (a vector a request, a score table, a
model asked at every branch); no shuffle, driver loop or checkpoint.

Larger catalogues stay tables: the trie's edges (``allowed_next``) are path-compressed, so that an edge carries the
whole run of tokens that it forces (``radix_edges``).  Each round joins the walkers to the edges of
their node, one row a permitted edge, and keeps the best by a combinable maximum, so there are as many
rounds as branches on a path, not tokens, and no node's edges are gathered.  A few rounds
lie between two checkpoints.  Results are the same.  Token ids come from range-partitioned
ranks.  Only a live model still gets its vocabulary (the distinct tokens) as a list, as its
interface asks for it; on a stream, where nothing can be aggregated, a node's edges travel as an array.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsmith import fixed
from callsmith.operators.artefacts import STORE, kept
from callsmith.operators.catalog import CatalogError, dedupe_catalog
from callsmith.operators.prefix import allowed_next, dense_ranks, radix_edges
from callsmith.session import ensure_checkpoint_dir

SEQ_TOKEN_PATTERN = r"[A-Za-z0-9]+|[^A-Za-z0-9\s]"
# Largest catalogue (characters of its compact JSON, each name once) whose sequences are collected and
# shipped to every task: about 2 M tokens, some 200 MB as Python lists on the driver.
MAX_WALK_CHARS = 1 << 23
# Rounds (branches) that a walk by joins does between two checkpoints.
ROUNDS = 3

WALK_FIELDS = [T.StructField("fn_ord", T.LongType()), T.StructField("fn_name", T.StringType()),
               T.StructField("walk_steps", T.IntegerType()), T.StructField("walk_unique", T.BooleanType()),
               T.StructField("walk_failed", T.BooleanType())]
_ARROW_TYPES = [pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.bool_()]


def definition_json() -> Column:
    """Compact JSON of a definition, keys in declared order."""
    return F.to_json(F.struct("fn_name", "args_names", "args_types", "return_type"))


def catalog_sequences(catalog: DataFrame) -> DataFrame:
    """K9: ``(ord, fn_name, tokens ARRAY<STRING>, ids ARRAY<INT>)``.

    Ids are ranks of the distinct tokens of the catalogue (``ord`` unique) in
    binary string order (``dense_ranks``), joined to the tokens, whatever their number.
    """
    toks = catalog.select("ord", "fn_name", F.regexp_extract_all(
        definition_json(), F.lit(SEQ_TOKEN_PATTERN), F.lit(0)).alias("tokens"))
    placed = toks.select("ord", F.posexplode("tokens").alias("pos", "token"))
    ranks = dense_ranks(placed.select("token").distinct(), "token").withColumn("id", F.col("id").cast("int"))
    ids = placed.join(ranks, "token").groupBy("ord").agg(
        F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("placed"))
    return toks.join(ids, "ord").select("ord", "fn_name", "tokens", F.col("placed.id").alias("ids"))


Branch = tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]


@dataclass
class Paths:
    """The sorted token sequences of a catalogue, as arrays."""
    flat: np.ndarray       # all tokens, sequence by sequence
    begin: np.ndarray      # where each sequence starts in ``flat``; one more entry at the end
    ords: list[int]
    names: list[str]
    first: int             # place of the fallback definition (lowest ord)
    vocab: list[str]
    _seen: dict = field(default_factory=dict, repr=False, compare=False)

    @classmethod
    def of(cls, rows: list[tuple[int, str, list[int]]], vocab: list[str] | None = None) -> Paths:
        """From ``(ord, name, ids)`` rows."""
        rows = sorted(rows, key=lambda r: (r[2], r[0]))
        begin = np.zeros(len(rows) + 1, np.int64)
        np.cumsum([len(r[2]) for r in rows], out=begin[1:])
        flat = np.fromiter((t for r in rows for t in r[2]), np.int32, int(begin[-1]))
        ords = [r[0] for r in rows]
        return cls(flat, begin, ords, [r[1] for r in rows], ords.index(min(ords)), vocab or [])

    def branch(self, lo: int, hi: int, depth: int) -> Branch:
        """Of the sequences lo..hi-1, which share ``depth`` tokens: the further tokens that all
        share, the tokens that may follow these (ascending), and the range of each."""
        found = self._seen.get((lo, hi, depth))
        if found is None:
            a = self.flat[self.begin[lo] + depth:self.begin[lo + 1]]
            z = self.flat[self.begin[hi - 1] + depth:self.begin[hi]]
            n = min(len(a), len(z))
            differ = np.flatnonzero(a[:n] != z[:n])
            shared = 0 if hi - lo == 1 else int(differ[0]) if len(differ) else n
            at = depth + shared
            tokens, ranges, i = [], [], lo
            while i < hi and self.begin[i] + at >= self.begin[i + 1]:  # sequences that end here
                i += 1
            while i < hi:
                token = int(self.flat[self.begin[i] + at])
                after = bisect_right(range(i, hi), token,
                                     key=lambda j: self.flat[self.begin[j] + at]) + i
                tokens.append(token)
                ranges.append((i, after))
                i = after
            found = self._seen[lo, hi, depth] = (a[:shared], np.array(tokens, np.int64), ranges)
        return found

    def walk(self, permitted: Callable[[int, np.ndarray], int],
             choose: Callable[[int, np.ndarray], int | None]) -> tuple[int, int]:
        """(place of the sequence found or -1, tokens walked).  ``permitted(step, tokens)`` says
        how many of the forced tokens from ``step`` on may be walked, ``choose(step, tokens)``
        which of a branch's tokens is taken."""
        lo, hi, depth = 0, len(self.ords), 0
        while True:
            shared, tokens, ranges = self.branch(lo, hi, depth)
            if len(shared):
                walked = permitted(depth, shared)
                depth += walked
                if walked < len(shared):
                    return -1, depth
            pick = choose(depth, tokens) if len(tokens) else None
            if pick is None:
                return -1, depth
            lo, hi = ranges[pick]
            depth += 1
            if hi - lo == 1:
                return lo, depth

    def result(self, place: int, steps: int, failed: bool = False) -> tuple:
        at = place if place >= 0 else self.first
        return self.ords[at], self.names[at], steps, place >= 0, failed


def load_paths(catalog: DataFrame) -> Paths | None:
    """The sequences of a catalogue (a repeated name once, A1), whose size is checked first; None
    where they are too large to be collected."""
    catalog = dedupe_catalog(catalog)
    size = catalog.agg(F.sum(F.length(definition_json())).alias("n")).first()["n"]
    if not size:
        raise CatalogError("function catalogue is empty")
    if size > MAX_WALK_CHARS:
        return None
    if catalog.sparkSession.conf.get(STORE, None):
        rows = kept(catalog, {"sequences": lambda _: catalog_sequences(catalog)})["sequences"].collect()
    else:
        rows = catalog_sequences(catalog).collect()
    vocab = sorted({t for r in rows for t in r["tokens"]})
    return Paths.of([(r["ord"], r["fn_name"], r["ids"]) for r in rows], vocab)


class Trie:
    """A large catalogue's path-compressed trie as tables, and walks over it by joins.

    A walk's state has any columns, and ``node, depth`` (where it is; ``depth`` tokens are
    walked), ``live`` (goes on), ``found`` (ord of the sequence) and ``failed``.
    """

    STATE = ("node", "depth", "live", "found", "failed")

    def __init__(self, catalog: DataFrame):
        catalog = dedupe_catalog(catalog)
        built = kept(catalog, {
            "sequences": lambda _: catalog_sequences(catalog),
            "edges": lambda got: radix_edges(allowed_next(got["sequences"], "ord", "ids")).select(
                F.col("node_seq").cast("bigint").alias("parent"), F.col("depth").alias("at"), "token", "run", "n_seqs",
                F.col("child_seq").cast("bigint").alias("child"), "next_edges")})
        self.seqs, self.edges = built["sequences"], built["edges"]
        top = self.seqs.agg(F.min("ord").alias("first"), F.min_by("fn_name", "ord").alias("name")).first()
        self.first, self.name = top["first"], top["name"]
        self.arrays: DataFrame | None = None
        self.root_edges = self.edges.filter("at = 0").count()

    def rounds(self) -> int:
        """The most edges on a path."""
        here = self.edges.filter("at = 0")
        found = 0
        while not here.isEmpty():
            found += 1
            ends = here.filter("n_seqs > 1").select(F.col("child").alias("of"), (F.col("at") + 1 + F.size("run")).alias("upto"))
            here = self.edges.join(ends, (F.col("parent") == F.col("of")) & (F.col("at") == F.col("upto"))).drop(
                "of", "upto").checkpoint()
        return found

    def start(self, rows: DataFrame) -> DataFrame:
        return rows.select("*", F.lit(self.first).cast("bigint").alias("node"), F.lit(0).alias("depth"),
                           F.lit(True).alias("live"), F.lit(None).cast("bigint").alias("found"),
                           F.lit(False).alias("failed"))

    @staticmethod
    def ranked(score: Column, edge: Column | None = None) -> Column:
        """An edge (a struct, or the row's columns) with its score: the largest is taken (NaN above all,
        null below), then the lowest token."""
        def of(c: str) -> Column:
            return F.col(c) if edge is None else edge[c]

        return F.struct(F.coalesce(score.cast("double"), F.lit(float("-inf"))).alias("score"),
                        (-of("token")).alias("by_id"), *(of(c).alias(c) for c in ("n_seqs", "child", "run", "next_edges")))

    def best_edges(self, state: DataFrame, key: str, scores: Column) -> DataFrame:
        """The state with ``pick``, the best permitted edge (null: none) by each walker's score vector:
        one join, and a maximum by walker, which is nearly all map-side."""
        if state.isStreaming:
            return self.best_in_arrays(state, scores)
        live = F.col("live") & (F.col("node") == F.col("parent")) & (F.col("depth") == F.col("at"))
        met = state.join(self.edges, live & (F.col("token") < F.coalesce(F.size(scores), F.lit(0))), "left")
        pick = F.when(F.col("token").isNotNull(), self.ranked(F.get(scores, F.col("token"))))
        return met.select(*state.columns, pick.alias("pick")).groupBy(key).agg(
            *[F.any_value(c).alias(c) for c in state.columns if c != key], F.max("pick").alias("pick")).select(
            *state.columns, "pick")

    def best_in_arrays(self, state: DataFrame, scores: Column) -> DataFrame:
        """``best_edges`` without an aggregate, for streams: a node's edges travel as one array."""
        if self.arrays is None:
            self.arrays = self.edges.groupBy(F.col("parent").alias("of_node"), F.col("at").alias("of_depth")).agg(
                F.collect_list(F.struct("token", "n_seqs", "child", "run", "next_edges")).alias("edges")).checkpoint()
        here = state.join(self.arrays, F.col("live") & (F.col("node") == F.col("of_node"))
                          & (F.col("depth") == F.col("of_depth")), "left").drop("of_node", "of_depth")
        usable = F.filter("edges", lambda e: e["token"] < F.coalesce(F.size(scores), F.lit(0)))
        return here.withColumn("pick", F.array_max(F.transform(usable, lambda e: self.ranked(
            F.get(scores, e["token"]), e)))).drop("edges")

    @staticmethod
    def moved(state: DataFrame, walked: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
        """Live walkers follow ``pick`` and the first ``walked`` tokens that it forces (null: all); without a
        pick, or where not all may be walked, they end.  ``keep``: columns beside the state's own that stay."""
        on = F.col("live") & F.col("pick").isNotNull()
        alone = F.col("pick.n_seqs") == 1  # ends at once: the rest of the sequence is not walked
        forced = F.when(alone, 0).otherwise(F.size("pick.run"))
        done = forced if walked is None else F.least(forced, F.coalesce(walked, forced))
        other = [c for c in state.columns if c not in (*Trie.STATE, "pick", *keep)]
        return state.select(
            *other, *keep, F.when(on, F.col("pick.child")).otherwise(F.col("node")).alias("node"),
            (F.col("depth") + F.when(on, 1 + done).otherwise(0)).cast("int").alias("depth"),
            F.coalesce(on & ~alone & (done == forced), F.lit(False)).alias("live"),
            F.when(on & alone, F.col("pick.child")).otherwise(F.col("found")).alias("found"), "failed")

    def walk(self, state: DataFrame, step: Callable[[DataFrame], DataFrame], each: int | None = None) -> DataFrame:
        """All walkers with ``WALK_FIELDS``; ``step`` does one round.  A stream takes no checkpoint
        and does as many rounds as the trie has."""
        ended = None
        if state.isStreaming:
            for _ in range(self.rounds()):
                state = step(state)
        else:
            going = True
            while going:
                for _ in range(each or ROUNDS):
                    state = step(state)
                state = state.checkpoint()
                done = state.filter(~F.col("live"))
                ended = done if ended is None else ended.unionByName(done)
                state = state.filter("live")
                going = not state.isEmpty()
            state = ended
        names = self.seqs.select(F.col("ord").alias("of_ord"), F.col("fn_name").alias("of_name"))
        state = state.join(names, F.col("found") == F.col("of_ord"), "left")
        keep = [c for c in state.columns if c not in (*self.STATE, "of_ord", "of_name")]
        return state.select(
            *keep, F.coalesce("found", F.lit(self.first).cast("bigint")).alias("fn_ord"),
            F.coalesce("of_name", F.lit(self.name)).alias("fn_name"),
            F.col("depth").cast("int").alias("walk_steps"), F.col("found").isNotNull().alias("walk_unique"),
            F.col("failed").alias("walk_failed"))


def _packed(requests: DataFrame) -> DataFrame:
    """The requests as one column, numbered (the numbers hold from the checkpoint on)."""
    packed = requests.select(F.struct(*requests.columns).alias("request"))
    if requests.isStreaming:
        return packed
    ensure_checkpoint_dir(requests.sparkSession)
    return packed.withColumn("walker", F.monotonically_increasing_id()).checkpoint()


def _unpacked(walked: DataFrame, requests: DataFrame) -> DataFrame:
    return walked.select(*[F.col("request")[c].alias(c) for c in requests.columns],
                         *[f.name for f in WALK_FIELDS])


def _usable_run(length: Column) -> Column:
    """How many tokens of ``pick.run`` come before the first one that is not below ``length``."""
    beyond = F.array_position(F.transform("pick.run", lambda t: t >= length), F.lit(True))
    return F.when(beyond > 0, beyond - 1).otherwise(F.size("pick.run")).cast("int")


def _join_walk_vectors(requests: DataFrame, catalog: DataFrame, scores_col: str) -> DataFrame:
    trie = Trie(catalog)
    scores = F.col("request")[scores_col]
    length = F.coalesce(F.size(scores), F.lit(0))

    def step(state: DataFrame) -> DataFrame:
        return trie.moved(trie.best_edges(state, "walker", scores), _usable_run(length))

    return _unpacked(trie.walk(trie.start(_packed(requests)), step), requests)


def _join_walk_table(walkers: DataFrame, catalog: DataFrame, known: DataFrame, key: str) -> DataFrame:
    trie = Trie(catalog)
    known = known.select(F.col(key).alias("of_key"), F.col("step").alias("of_step"),
                         F.col("token_id").alias("of_token"), "score")
    same = F.col("key").eqNullSafe(F.col("of_key"))

    def step(state: DataFrame) -> DataFrame:
        best = state.filter("live").join(known, same & (F.col("of_step") == F.col("depth"))).join(
            trie.edges, (F.col("node") == F.col("parent")) & (F.col("depth") == F.col("at"))
            & (F.col("of_token") == F.col("token"))).groupBy("key").agg(
            F.max(trie.ranked(F.col("score"))).alias("pick"), F.any_value("depth").alias("from_depth")).withColumnRenamed(
            "key", "pick_key")
        # The forced tokens must have scores too: where the first without one stands.
        forced = best.filter("pick.n_seqs > 1").select(F.col("pick_key").alias("key"), "from_depth", F.posexplode(
            "pick.run").alias("i", "forced")).join(known, same & (F.col("of_step") == F.col("from_depth") + 1 + F.col("i"))
                                                   & (F.col("of_token") == F.col("forced")), "left")
        stops = forced.filter("of_key IS NULL AND of_token IS NULL").groupBy(F.col("key").alias("stop_key")).agg(F.min("i").alias("walked"))
        at = state.join(best.drop("from_depth"), F.col("key").eqNullSafe(F.col("pick_key")), "left").drop("pick_key").join(
            stops, F.col("key").eqNullSafe(F.col("stop_key")), "left").drop("stop_key")
        return trie.moved(at, F.col("walked")).drop("walked")

    state = trie.start(walkers.select(F.col(key).alias("key")).distinct())
    walked = trie.walk(state, step, each=1).withColumnRenamed("key", "of_key")
    return walkers.select(key).join(walked, walkers[key].eqNullSafe(F.col("of_key"))).select(
        key, *[f.name for f in WALK_FIELDS])


def _join_walk_model(requests: DataFrame, catalog: DataFrame, scorer, text_col: str,
                     context: bool) -> DataFrame:
    """The model is asked for the walkers at a node with several edges; its vector then ranks the joined edges."""
    trie = Trie(catalog)
    vocab = [r["t"] for r in trie.seqs.select(F.explode("tokens").alias("t")).distinct().collect()]
    vocab.sort()
    functions = ", ".join(r["fn_name"] for r in trie.seqs.select("ord", "fn_name").orderBy(
        "ord").collect()) if context else ""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = dict(zip(b.schema.names, b.columns))
            texts, ids, width, live, failed = (cols[c].to_pylist() for c in ("text", "ids", "width", "live", "failed"))
            if context:
                texts = [fixed.SELECTION_CONTEXT.format(functions=functions, prompt=t or "") for t in texts]
            rows = [i for i, n in enumerate(width) if live[i] and n > 1]
            # One forced edge needs no model: every token is permitted alike.
            scores: list = [np.zeros(len(vocab)) if on and n == 1 else None for on, n in zip(live, width)]
            for i, v in zip(rows, _asked(scorer, vocab, pd.Series([texts[i] for i in rows], dtype=object),
                                         [ids[i] for i in rows]) if rows else []):
                scores[i], failed[i] = v, v is None
            cols |= {"failed": pa.array(failed, pa.bool_()), "scores": pa.array(scores, pa.list_(pa.float64()))}
            yield pa.RecordBatch.from_arrays([cols[n] for n in names], names)

    rows = _packed(requests)
    # A stream's walkers are not numbered: they carry their request.
    key = "request" if requests.isStreaming else "walker"
    names = [key, "text", "ids", "width", *Trie.STATE, "scores"]

    def step(state: DataFrame) -> DataFrame:
        schema = T.StructType([*(state.schema[n] for n in names[:-1]), T.StructField("scores", T.ArrayType(T.DoubleType()))])
        picked = trie.best_edges(state.select(*names[:-1]).mapInArrow(ask, schema), key, F.col("scores")).drop("scores")
        on = F.col("live") & F.col("pick").isNotNull()
        ids = F.when(on, F.concat("ids", F.array((-F.col("pick.by_id")).cast("bigint")), F.when(
            F.col("pick.n_seqs") > 1, F.col("pick.run")).otherwise(F.array()).cast("array<bigint>"))).otherwise(F.col("ids"))
        return trie.moved(picked.withColumn("ids", ids).withColumn(
            "width", F.when(on, F.col("pick.next_edges")).otherwise(F.col("width"))))

    state = trie.start(rows.select(key, F.col("request")[text_col].alias("text"),
                                   F.array().cast("array<bigint>").alias("ids"),
                                   F.lit(trie.root_edges).cast("bigint").alias("width")))
    walked = trie.walk(state, step, each=1)
    return _unpacked(walked if key == "request" else rows.join(walked, "walker"), requests)


def walk_vector(paths: Paths, scores: np.ndarray) -> tuple[int, int]:
    """One request's walk under one score vector (lowest id on ties, NaN above all)."""
    def permitted(_step, tokens):
        beyond = np.flatnonzero(tokens >= len(scores))
        return int(beyond[0]) if len(beyond) else len(tokens)

    def choose(_step, tokens):
        usable = tokens[:np.searchsorted(tokens, len(scores))]
        return int(np.argmax(scores[usable])) if len(usable) else None

    return paths.walk(permitted, choose)


def _with_results(requests: DataFrame, results: Callable[[pa.RecordBatch], list[tuple]]) -> DataFrame:
    """The requests with the columns of ``WALK_FIELDS`` from ``results`` of each batch."""
    names = [f.name for f in WALK_FIELDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(zip(*results(b))) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *(pa.array(c, t) for c, t in zip(cols, _ARROW_TYPES))],
                [*b.schema.names, *names])

    return requests.mapInArrow(run, T.StructType([*requests.schema.fields, *WALK_FIELDS]))


def constrained_walk(requests: DataFrame, catalog: DataFrame, scores_col: str, form: str = "auto") -> DataFrame:
    """Add ``fn_ord, fn_name, walk_steps, walk_unique, walk_failed`` to every request.

    ``scores_col`` is a score vector a request; a null score ranks below all
    others, a null vector permits nothing.  ``form="join"`` walks by joins whatever the catalogue's size.
    """
    paths = None if form == "join" else load_paths(catalog)
    if paths is None:
        return _join_walk_vectors(requests, catalog, scores_col)
    place = requests.columns.index(scores_col)

    def results(b: pa.RecordBatch) -> list[tuple]:
        vectors = b.column(place)
        flat = pc.fill_null(vectors.values.cast(pa.float64()), float("-inf")).to_numpy(
            zero_copy_only=False)
        at, known = vectors.offsets.to_numpy(), vectors.is_valid().to_numpy(zero_copy_only=False)
        return [paths.result(*walk_vector(paths, flat[at[i]:at[i + 1] if known[i] else at[i]]))
                for i in range(b.num_rows)]

    return _with_results(requests, results)


def constrained_walk_table(walkers: DataFrame, catalog: DataFrame, scores: DataFrame,
                           key: str = "req_id") -> DataFrame:
    """K1 prefix mode with step-dependent scores (a model that re-scores after each token).

    ``scores(key, step, token_id, score)`` holds the scores each walker sees
    at each step (0-based); a token without a score row at that step is not
    permitted, like an id beyond the score vector.  Scores of tokens that no
    definition has at that step are dropped first; one shuffle by ``key`` brings a walker and
    the others together (at most the catalogue's distinct tokens a step).  Returns
    ``(key, fn_ord, fn_name, walk_steps, walk_unique, walk_failed)``.
    """
    paths = load_paths(catalog)
    names = [f.name for f in WALK_FIELDS]
    known = scores.select(key, "step", "token_id", F.coalesce(
        F.col("score").cast("double"), F.lit(float("-inf"))).alias("score"))
    if paths is None:
        return _join_walk_table(walkers, catalog, known, key)

    steps = np.arange(len(paths.flat)) - np.repeat(paths.begin[:-1], np.diff(paths.begin))
    on_paths = sorted(set(zip(steps.tolist(), paths.flat.tolist())))
    used = F.broadcast(walkers.sparkSession.createDataFrame(on_paths, "step int, token_id int"))
    own = known.join(used, ["step", "token_id"], "left_semi").groupBy(F.col(key).alias("_of")).agg(
        F.collect_list("step").alias("_steps"), F.collect_list("token_id").alias("_tokens"),
        F.collect_list("score").alias("_scores"))

    def walk(rows_steps: list[int] | None, rows_tokens: list[int] | None, rows_scores: list[float] | None) -> tuple:
        table: dict[tuple[int, int], float] = {}
        for step, token, score in zip(rows_steps or (), rows_tokens or (), rows_scores or ()):
            table[step, token] = max(score, table.get((step, token), score))

        def permitted(step, tokens):
            walked = 0
            while walked < len(tokens) and (step + walked, int(tokens[walked])) in table:
                walked += 1
            return walked

        def choose(step, tokens):
            here = [(table[step, t], -i) for i, t in enumerate(tokens.tolist()) if (step, t) in table]
            return -max(here)[1] if here else None

        return paths.result(*paths.walk(permitted, choose))

    met = walkers.select(key).join(own, F.col(key).eqNullSafe(F.col("_of")), "left").drop("_of")
    return _with_results(met, lambda b: [walk(*r) for r in zip(*(c.to_pylist() for c in b.columns[1:]))]).select(key, *names)


def _asked(scorer, vocab: list[str], texts: pd.Series, ids: list[list[int]]) -> list[np.ndarray | None]:
    """The model's vector for each text and its generated ids; None where it raises or gives none."""
    def ask(some: slice) -> list[np.ndarray]:
        own = texts.iloc[some].reset_index(drop=True)
        given = scorer.vectors(own, pd.Series(ids[some], dtype=object), vocab)
        given = [np.asarray(v, np.float64).reshape(-1) for v in given]
        if len(given) != len(own):
            raise ValueError("the scorer must give one vector a text")
        return given

    try:
        return ask(slice(None))
    except Exception:  # a scorer is user code: only the rows it cannot score fail
        out: list[np.ndarray | None] = []
        for i in range(len(texts)):
            try:
                out += ask(slice(i, i + 1))
            except Exception:
                out.append(None)
        return out


def walk_model(requests: DataFrame, catalog: DataFrame, scorer, text_col: str,
               context: bool = False) -> DataFrame:
    """Add the walk's columns to every request; a live model (``ModelScorer``) gives the scores.

    A batch's walkers go on together from branch to branch.  At each branch with more than
    one edge the model is asked once for all walkers there, with their texts
    and the ids generated so far; where one token is permitted it is not asked.
    A request for which the model raises, or gives no vector, ends with
    ``walk_failed`` and the first function; the others of its batch go on.  With
    ``context`` the model is shown the selection context (F20) instead of the bare text.
    """
    paths = load_paths(catalog)
    if paths is None:
        return _join_walk_model(requests, catalog, scorer, text_col, context)
    place = requests.columns.index(text_col)
    functions = ", ".join(n for _, n in sorted(zip(paths.ords, paths.names)))

    def results(b: pa.RecordBatch) -> list[tuple]:
        texts = b.column(place).to_pylist()
        if context:
            texts = [fixed.SELECTION_CONTEXT.format(functions=functions, prompt=t or "") for t in texts]
        texts = pd.Series(texts, dtype=object)
        out: list = [None] * len(texts)
        at = {i: (0, len(paths.ords)) for i in range(len(texts))}
        ids: list[list[int]] = [[] for _ in range(len(texts))]

        def move(i: int, token: int, to: tuple[int, int]) -> None:
            ids[i].append(token)
            at[i] = to
            if to[1] - to[0] == 1:
                del at[i]
                out[i] = paths.result(to[0], len(ids[i]))

        while at:
            asked = []
            for i in list(at):
                shared, tokens, ranges = paths.branch(*at[i], len(ids[i]))
                if len(tokens) > 1:
                    asked.append((i, shared, tokens, ranges))
                    continue
                ids[i].extend(shared.tolist())
                if len(tokens):
                    move(i, int(tokens[0]), ranges[0])
                else:
                    del at[i]
                    out[i] = paths.result(-1, len(ids[i]))
            for i, shared, _, _ in asked:
                ids[i].extend(shared.tolist())
            rows = [a[0] for a in asked]
            scored = _asked(scorer, paths.vocab, texts.iloc[rows], [ids[i] for i in rows]) if rows else []
            for (i, _, tokens, ranges), v in zip(asked, scored):
                usable = tokens[:np.searchsorted(tokens, len(v))] if v is not None else tokens[:0]
                if len(usable):
                    pick = int(np.argmax(v[usable]))
                    move(i, int(tokens[pick]), ranges[pick])
                else:
                    del at[i]
                    out[i] = paths.result(-1, len(ids[i]), v is None)
        return out

    return _with_results(requests, results)


def constrained_walk_model(requests: DataFrame, catalog: DataFrame, scorer, text_col: str,
                           key: str) -> DataFrame:
    """``walk_model`` for the key alone: ``(key, fn_ord, fn_name, walk_steps, walk_unique)``."""
    return walk_model(requests.select(key, text_col), catalog, scorer, text_col).select(
        key, "fn_ord", "fn_name", "walk_steps", "walk_unique")
