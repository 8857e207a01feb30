"""Prefix index over token sequences (J4, A2-A6, C1, C2, T1) and the masked argmax.

A set of sequences (the tokenised catalogue, or any table of token arrays)
defines a trie.  The reference walks it one prefix at a time; here every
prefix of every sequence is one row, keyed by a running hash of the tokens
before it, and the questions become aggregations:

* ``allowed_next``      — distinct next tokens per prefix (trie edges),
* ``unique_prefixes``   — prefixes shared by exactly one sequence,
* ``shortest_unique_prefix`` — the earliest such prefix per sequence, i.e.
  where a greedy walk along that sequence stops.

Prefix identity is four running sums of 32-bit hash values of (token,
position) — the two halves of two independent 64-bit hashes, 128 bits in all.
Each sum fits a BIGINT exactly for any sequence shorter than 2^31 tokens, so
keys are fixed-width longs, a prefix key is O(1) to extend and the whole index
costs O(total tokens) rather than O(length²).
``prefix_collisions`` checks that no key mixes two different prefixes.

Partitioning: sequences are hash-partitioned by id *before* exploding, so the
running-sum window needs no second shuffle of the (much larger) token rows;
the only other shuffle is the aggregation on the prefix key, which
pre-aggregates map-side, so a hot prefix (every sequence starts the same way)
is never collected in one task.  ``allowed_next`` and the stored index key only the places
1, 2, 4, … of a sequence, and single tokens only where sequences part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOKEN_PATTERN = r"[^\t\n\x0b\f\r ]+"


def word_tokens(text: Column) -> Column:
    """Whitespace-separated tokens (the same class in Java and RE2)."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


_MASK32 = 0xFFFFFFFF
KEYS = ("h1", "h2", "h3", "h4")


def _parts(tok: Column, pos: Column) -> list[Column]:
    """Four 32-bit values (as BIGINT) from two independent 64-bit hashes."""
    a = F.xxhash64(tok, pos)
    b = F.xxhash64(pos, tok, F.lit("#"))
    return [F.shiftrightunsigned(a, 32), a.bitwiseAND(F.lit(_MASK32)),
            F.shiftrightunsigned(b, 32), b.bitwiseAND(F.lit(_MASK32))]


def _tokens(tokens_col) -> Column:
    return tokens_col if isinstance(tokens_col, Column) else F.col(tokens_col)


def prefix_rows(seqs: DataFrame, id_col: str = "seq_id", tokens_col="tokens") -> DataFrame:
    """One row per (sequence, position): ``seq_id, n, tok, p0..p3, k0..k3``.

    ``(p0..p3)`` keys the prefix of the ``n`` tokens before ``tok``;
    ``(k0..k3)`` keys the prefix of ``n + 1`` tokens ending with ``tok``.
    ``tokens_col`` may be a Column expression over the input (e.g. a
    tokenizer over a text column): it is evaluated after the repartition,
    so the (single) shuffle moves raw rows and tokenising runs in parallel.
    """
    parted = seqs.repartition(F.col(id_col)) \
                 .select(F.col(id_col).alias("seq_id"), _tokens(tokens_col).alias("tokens"))
    rows = parted.select("seq_id", F.posexplode_outer("tokens").alias("n", "tok")) \
                 .filter(F.col("tok").isNotNull())
    w = Window.partitionBy("seq_id").orderBy("n").rowsBetween(Window.unboundedPreceding,
                                                              Window.currentRow)
    parts = _parts(F.col("tok"), F.col("n"))
    keyed = rows.select("seq_id", F.col("n").cast("int").alias("n"), "tok",
                        *[g.alias(f"g{i}") for i, g in enumerate(parts)],
                        *[F.sum(g).over(w).alias(f"k{i}") for i, g in enumerate(parts)])
    # (k*) keys the prefix ending with tok; (p*) = (k*) - (g*) keys the one before it.
    return keyed.select("seq_id", "n", "tok",
                        *[(F.col(f"k{i}") - F.col(f"g{i}")).alias(f"p{i}") for i in range(4)],
                        *[F.col(f"k{i}") for i in range(4)])


PARENT = [f"p{i}" for i in range(4)]
SELF = [f"k{i}" for i in range(4)]


# A cut: the tokens of one sequence from 0, 1, 2, 4, … up to the next such place.  It is keyed by the
# tokens before it (h1, h2) and by its own (r1, r2).
CUT = ("n", "h1", "h2", "r1", "r2")


def _holes(tokens: Column) -> Column:
    """Places of null tokens, which the hash of an array passes over (null: none)."""
    return F.when(F.exists(tokens, lambda t: t.isNull()), F.filter(
        F.transform(tokens, lambda t, i: F.when(t.isNull(), i)), lambda i: i.isNotNull()))


def _hashes(n: Column, *parts: Column) -> list[Column]:
    """128 bits of the first ``n`` tokens (the root, without any, has zeros)."""
    return [F.when(n == 0, F.lit(0).cast("bigint")).otherwise(h) for h in (F.xxhash64(*parts), F.xxhash64(F.lit("#"), *parts))]


def _cut_start(n: Column) -> Column:
    """Where the cut begins that holds place ``n``."""
    return F.when(n == 0, 0).otherwise(F.call_function("shiftleft", F.lit(1), F.length(F.bin(n.cast("bigint"))) - 1)).cast("int")


def cut_key(tokens: Column, n: Column) -> list[Column]:
    """``h1, h2`` of the first ``n`` tokens."""
    holes = F.filter(_holes(tokens), lambda i: i < n)
    return _hashes(n, F.slice(tokens, F.lit(1), n), holes)


def _cut_rows(parted: DataFrame, tokens_col) -> DataFrame:
    """``(seq_id, odd, id_key, n, h1, h2, r1, r2)``, one row per cut of each sequence; ``odd``
    where several sequences have the id.  The rows lie together by id, so nothing is shuffled."""
    # No filter before the explode: it would move below the shuffle by id, which then could not serve all uses.
    base = parted.select("seq_id", "id_key", _tokens(tokens_col).alias("tokens")).select(
        "seq_id", "id_key", "tokens", F.size("tokens").alias("size"), _holes(F.col("tokens")).alias("holes"))
    last = F.when(F.col("size") > 1, F.length(F.bin((F.col("size") - 1).cast("bigint")))).otherwise(0)
    levels = F.when(F.exists("tokens", lambda t: t.isNotNull()), F.sequence(F.lit(0), last))
    rows = base.select("*", F.explode_outer(levels).alias("lvl")).filter(F.col("lvl").isNotNull())
    rows = rows.select("*", F.when(F.col("lvl") == 0, 0).otherwise(F.expr("shiftleft(1, lvl - 1)")).cast("int").alias("n"))
    n, width = F.col("n"), F.least(F.greatest(F.col("n"), F.lit(1)), F.col("size") - F.col("n"))
    before = _hashes(n, F.slice("tokens", F.lit(1), n), F.filter("holes", lambda i: i < n))
    own = (F.slice("tokens", n + 1, width), F.filter("holes", lambda i: (i >= n) & (i < n + width)), width)
    keyed = rows.select("seq_id", "id_key", "n", before[0].alias("h1"), before[1].alias("h2"), F.xxhash64(*own).alias("r1"),
                        F.xxhash64(F.lit("#"), *own).alias("r2"))
    times = F.count_if(F.col("n") == 0).over(Window.partitionBy("id_key"))
    return keyed.select("seq_id", (times > 1).alias("odd"), "id_key", *CUT)


def id_key(of: Column) -> Column:
    """The id as a key that is never null, so that joins and windows keep one partitioning."""
    return F.coalesce(F.concat(F.lit("#"), of.cast("string")), F.lit(""))


def _parted(seqs: DataFrame, id_col: str) -> DataFrame:
    """The sequences with ``seq_id`` and ``id_key``, together by id and not yet cut into tokens."""
    keyed = seqs.withColumns({"_seq_id": F.col(id_col), "id_key": id_key(F.col(id_col))})
    return keyed.repartition("id_key").withColumn("seq_id", F.col("_seq_id"))


def _distinct_cuts(cuts: DataFrame) -> DataFrame:
    return cuts.filter(~F.col("odd")).groupBy(*CUT).agg(F.count(F.lit(1)).alias("n_seqs"), F.min("seq_id").alias("child_seq"))


def _odd_edges(parted: DataFrame, cuts: DataFrame, tokens_col) -> DataFrame:
    """Sequences that share their id: their tokens make one running key (as if merged by position), so all but the root
    is their own.  Each edge is a cut of one token."""
    # Read like the other uses of the shuffled rows (the same columns, no semi join, which would move below the shuffle).
    odd = cuts.filter("odd and n = 0").select(id_key(F.col("seq_id")).alias("id_key")).distinct()
    rows = prefix_rows(parted.join(odd, "id_key"), "seq_id", tokens_col)
    root = F.col("n") == 0
    for p in PARENT:
        root = root & (F.col(p) == 0)
    h1, h2 = (F.when(root, F.lit(0).cast("bigint")).otherwise(F.xxhash64(F.lit(mark), *PARENT)) for mark in ("odd", "odd#"))
    one = F.array("tok")
    return rows.select("seq_id", "n", h1.alias("h1"), h2.alias("h2"), "tok").groupBy("n", "h1", "h2", "tok").agg(
        F.count(F.lit(1)).alias("n_seqs"), F.min("seq_id").alias("child_seq")).select(
        "child_seq", "n", "h1", "h2", F.xxhash64(one, F.lit(None).cast("array<int>"), F.lit(1)).alias("r1"),
        F.xxhash64(F.lit("#"), one, F.lit(None).cast("array<int>"), F.lit(1)).alias("r2"), "n_seqs", one.alias("run"))


def _with_runs(parted: DataFrame, cuts: DataFrame, tokens_col, *more: str) -> DataFrame:
    """The distinct cuts ``(child_seq, id_key, n, h1, h2, r1, r2, n_seqs, …)`` with their tokens, from the sequence that
    names each: one join by id, which finds the sequences together by id."""
    own = cuts.groupBy(id_key(F.col("child_seq")).alias("id_key")).agg(F.collect_list(F.struct(*CUT, "n_seqs", *more)).alias("cuts"))
    met = parted.join(own, "id_key").select("seq_id", "id_key", "cuts", _tokens(tokens_col).alias("tokens"))
    met = met.select("seq_id", "id_key", "tokens", F.explode("cuts").alias("c"))
    # An id may also have empty sequences.
    return met.filter(F.size("tokens") > F.col("c.n")).select(
        F.col("seq_id").alias("child_seq"), "id_key", "c.*", F.slice("tokens", F.col("c.n") + 1, F.greatest(F.col("c.n"), F.lit(1))).alias("run"))


def cut_edges(seqs: DataFrame, id_col: str = "seq_id", tokens_col="tokens") -> DataFrame:
    """The trie of the sequences by cuts: ``child_seq, n, h1, h2, r1, r2, n_seqs, run``, one row per distinct cut after a
    prefix.  The rows of two sets of sequences combine: ``n_seqs`` adds up, ``child_seq`` is the lesser."""
    parted = _parted(seqs, id_col)
    cuts = _cut_rows(parted, tokens_col)
    rows = _with_runs(parted, _distinct_cuts(cuts), tokens_col).drop("id_key")
    return rows.unionByName(_odd_edges(parted, cuts, tokens_col))


def with_shared(cuts: DataFrame) -> DataFrame:
    """Distinct cuts with ``shared``: whether another cut follows the same prefix (always at the root)."""
    several = cuts.filter("n > 0").groupBy("n", "h1", "h2").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select(
        F.col("n").alias("_n"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"))
    met = cuts.join(several, (F.col("n") == F.col("_n")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
    return met.select(*cuts.columns, ((F.col("n") == 0) | F.col("_n").isNotNull()).alias("shared"))


def token_edges(cuts: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """The trie edges of ``allowed_next`` from distinct cuts with their tokens and ``shared``.

    All sequences that pass a cut which is not shared pass the whole of it: its edges are ready, without a shuffle.
    Only the tokens of shared cuts (and of ``more``, cuts of one token) are keyed and counted."""
    own = cuts.select("child_seq", "n", "n_seqs", F.posexplode_outer(F.when(~F.col("shared"), F.col("run"))).alias("i", "tok")).filter(
        F.col("tok").isNotNull()).select(
        F.col("child_seq").alias("node_seq"), (F.col("n") + F.col("i")).cast("int").alias("depth"),
        F.col("tok").alias("next_token"), "n_seqs", "child_seq")
    rows = cuts.select("child_seq", "id_key", *CUT, "n_seqs", F.posexplode_outer(F.when(F.col("shared"), F.col("run"))).alias("i", "tok")).filter(
        F.col("tok").isNotNull())
    w = Window.partitionBy("id_key", *CUT).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = _parts(F.col("tok"), F.col("i"))
    summed = rows.select("*", *[g.alias(f"g{j}") for j, g in enumerate(parts)], *[F.sum(g).over(w).alias(f"k{j}") for j, g in enumerate(parts)])
    before = [F.col(f"k{j}") - F.col(f"g{j}") for j in range(4)]
    first = F.col("k0") == F.col("g0")
    for j in range(1, 4):
        first = first & (F.col(f"k{j}") == F.col(f"g{j}"))
    keyed = summed.select("child_seq", "n_seqs", (F.col("n") + F.col("i")).cast("int").alias("n"), "tok", *[
        F.when(first, F.col(h)).otherwise(F.xxhash64(F.col(h), *before)).alias(h) for h in ("h1", "h2")])
    if more is not None:
        keyed = keyed.unionByName(more.select("child_seq", "n_seqs", "n", F.get("run", 0).alias("tok"), "h1", "h2"))
    edges = keyed.groupBy("n", "h1", "h2", "tok").agg(F.sum("n_seqs").alias("n_seqs"), F.min("child_seq").alias("child_seq"))
    # Nodes are named by a second combinable minimum and an equi-join (which the skew-join rule can
    # split), not a window: the root alone has an edge for every distinct first token.
    nodes = edges.groupBy("n", "h1", "h2").agg(F.min("child_seq").alias("node_seq"))
    return own.unionByName(edges.join(nodes, ["n", "h1", "h2"]).select(
        "node_seq", F.col("n").alias("depth"), F.col("tok").alias("next_token"), "n_seqs", "child_seq"))


def allowed_next(seqs: DataFrame, id_col: str = "seq_id", tokens_col="tokens") -> DataFrame:
    """Trie edges ``(node_seq, depth, next_token, n_seqs, child_seq)``.

    A node is the prefix of ``depth`` tokens, named by the smallest id of the
    sequences that continue it (``node_seq``); ``child_seq`` names the node
    reached by ``next_token``.  Grouping by ``(node_seq, depth)`` gives the
    permitted-next-token set of that prefix.

    Each sequence is cut at 1, 2, 4, … tokens.  Only the cuts' hashes (about log2 of its length in rows) are
    grouped; of equal cuts one sequence gives the edges, and only tokens of cuts where sequences part are shuffled.
    """
    parted = _parted(seqs, id_col)
    cuts = _cut_rows(parted, tokens_col)
    return token_edges(_with_runs(parted, with_shared(_distinct_cuts(cuts)), tokens_col, "shared"),
                       _odd_edges(parted, cuts, tokens_col))


def radix_edges(edges: DataFrame) -> DataFrame:
    """Path-compressed trie edges ``(node_seq, depth, token, run, n_seqs, child_seq, next_edges)`` from
    those of ``allowed_next``.

    Along a stretch without a branch the same sequences go on, so its edges have one name and one
    count: one aggregate joins them.  ``run`` holds the tokens that ``token`` forces (none where one
    sequence is left, which needs no further walk), ``next_edges`` the edges of the node at its end.
    """
    runs = edges.groupBy("child_seq", "n_seqs").agg(
        F.min(F.struct("depth", "next_token", "node_seq")).alias("f"),
        F.array_sort(F.collect_list(F.when(F.col("n_seqs") > 1, F.struct("depth", "next_token")))).alias("t")).select(
        "f.node_seq", "f.depth", F.col("f.next_token").alias("token"),
        F.slice(F.col("t.next_token"), F.lit(2), F.greatest(F.size("t") - 1, F.lit(0))).alias("run"), "n_seqs", "child_seq")
    widths = runs.groupBy(F.col("node_seq").alias("of"), F.col("depth").alias("at")).agg(
        F.count(F.lit(1)).alias("next_edges"))
    return runs.join(widths, (F.col("child_seq") == F.col("of"))
                     & (F.col("depth") + 1 + F.size("run") == F.col("at")), "left").select(
        *runs.columns, F.coalesce("next_edges", F.lit(0)).cast("bigint").alias("next_edges"))


def dense_ranks(values: DataFrame, col: str) -> DataFrame:
    """``(col, id)``: the place (from 0) of each distinct value in ascending order, without a one-task window.

    The values are range-partitioned (Spark samples the ranges), counted by range, and
    ranked within theirs; the driver sees one count a range."""
    from callsmith.session import ensure_checkpoint_dir
    spark = values.sparkSession
    ensure_checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = values.select(col).repartitionByRange(n, col).withColumn("_range", F.spark_partition_id()).checkpoint()
    before, offsets = 0, []
    for r in sorted(ranged.groupBy("_range").count().collect(), key=lambda r: r["_range"]):
        offsets.append((r["_range"], before))
        before += r["count"]
    starts = spark.createDataFrame(offsets, "_of int, _before bigint")
    within = F.row_number().over(Window.partitionBy("_range").orderBy(col)) - 1
    return ranged.withColumn("_at", within).join(F.broadcast(starts), F.col("_range") == F.col("_of")).select(
        col, (F.col("_before") + F.col("_at")).alias("id"))


def prefix_key(tokens: Column) -> Column:
    """Key ``struct(n, p0..p3)`` of a whole token array, equal to ``prefix_rows``'
    parent key of a row at position ``n`` (so a generated prefix can be looked
    up by equi-join)."""
    zero = F.lit(0).cast("bigint")
    init = F.struct(F.lit(0).alias("i"), *[zero.alias(f"p{j}") for j in range(4)])

    def step(acc, t):
        parts = _parts(t, acc["i"])
        return F.struct((acc["i"] + 1).alias("i"),
                        *[(acc[f"p{j}"] + parts[j]).alias(f"p{j}") for j in range(4)])

    g = F.aggregate(tokens, init, step)
    return F.struct(F.size(tokens).alias("n"), *[g[f"p{j}"].alias(f"p{j}") for j in range(4)])


def allowed_next_for(prefixes: DataFrame, seqs: DataFrame, key: str = "req_id",
                     prefix_col: str = "prefix", id_col: str = "seq_id",
                     tokens_col="tokens") -> DataFrame:
    """``(key, next_token)`` — the tokens permitted after each generated prefix.

    An equi-join of the prefixes' keys with the trie edges (no theta join);
    a prefix matched by no sequence gets no rows (the walk stops).
    """
    edges = prefix_rows(seqs, id_col, tokens_col).select("n", *PARENT, "tok").distinct()
    k = prefixes.select(F.col(key), prefix_key(F.col(prefix_col)).alias("k"))
    cond = F.col("k.n") == edges["n"]
    for c in PARENT:
        cond = cond & (F.col(f"k.{c}") == edges[c])
    return k.join(edges, cond).select(key, F.col("tok").alias("next_token"))


def unique_prefixes(seqs: DataFrame, id_col: str = "seq_id", tokens_col="tokens") -> DataFrame:
    """A3: ``(seq_id, n)`` for every prefix length ``n`` matched by exactly one sequence."""
    rows = prefix_rows(seqs, id_col, tokens_col)
    return (rows.groupBy("n", *SELF)
            .agg(F.count(F.lit(1)).alias("c"), F.min("seq_id").alias("seq_id"))
            .filter(F.col("c") == 1)
            .select("seq_id", (F.col("n") + 1).alias("n")))


def _doubling_keys(seqs: DataFrame, id_col: str, tokens_col) -> DataFrame:
    """``(seq_id, lvl, len, h1, h2, b1, b2)``: a sequence's prefixes of 1, 2, 4, … tokens and
    the whole sequence, keyed by 128 bits; ``(b1, b2)`` keys the prefix one level shorter."""
    base = seqs.select(F.col(id_col).alias("seq_id"), _tokens(tokens_col).alias("tokens"))
    base = base.select("*", F.size("tokens").alias("size")).filter("size > 0")
    # The least level whose prefix is the whole sequence.
    last = F.length(F.bin((F.col("size") - 1).cast("bigint"))) - (F.col("size") == 1).cast("int")

    def keys(longest: str) -> Column:
        n = F.least(F.expr(longest), F.col("size"))
        head = F.slice("tokens", F.lit(1), n)
        return F.struct(n.alias("len"), F.xxhash64(head).alias("h1"),
                        F.xxhash64(F.lit("#"), head).alias("h2"))

    rows = base.select("*", F.explode(F.sequence(F.lit(0), last)).alias("lvl"))
    rows = rows.select("seq_id", "lvl", keys("shiftleft(1, lvl)").alias("k"),
                       keys("shiftleft(1, greatest(lvl - 1, 0))").alias("b"))
    zero = F.lit(0).cast("bigint")
    return rows.select("seq_id", "lvl", "k.*",
                       F.when(F.col("lvl") > 0, F.col("b.h1")).otherwise(zero).alias("b1"),
                       F.when(F.col("lvl") > 0, F.col("b.h2")).otherwise(zero).alias("b2"))


def shortest_unique_prefix(seqs: DataFrame, id_col: str = "seq_id",
                           tokens_col="tokens") -> DataFrame:
    """A4: ``(seq_id, sup_len)``; sequences that are duplicates or prefixes of others get no row.

    Uniqueness is monotone in the length, so the prefixes of 1, 2, 4, … tokens (a few rows a
    sequence) show between which two of them the answer lies.  Only tokens of such a range are
    then exploded, and only for sequences that share the range's beginning with one whose
    answer lies in it; the counts are combinable, and no token beyond twice an answer is shuffled.
    ``seq_id`` must be unique.
    """
    # One shuffle of raw rows by id, read by all three uses; tokenising runs after it.
    seqs = seqs.repartition(F.col(id_col))
    keys = _doubling_keys(seqs, id_col, tokens_col)
    alone = (keys.groupBy("lvl", "len", "h1", "h2")
             .agg(F.count(F.lit(1)).alias("c"), F.min("seq_id").alias("seq_id"),
                  F.min("b1").alias("b1"), F.min("b2").alias("b2"))
             .filter("c = 1"))
    first = alone.groupBy("seq_id").agg(F.min(F.struct("lvl", "b1", "b2")).alias("f"))
    wanted = first.select("f.*").distinct()
    # Sequences that begin alike, by id, with the levels whose range they are compared in.
    levels = (keys.join(wanted, ["lvl", "b1", "b2"], "left_semi")
              .groupBy("seq_id").agg(F.collect_set(F.struct("lvl", "b1", "b2")).alias("ranges")))
    texts = seqs.select(F.col(id_col).alias("seq_id"), _tokens(tokens_col).alias("tokens"))
    ranged = (texts.join(levels, "seq_id")
              .select("seq_id", "tokens", F.explode("ranges").alias("r"))
              .select("seq_id", "r.*", F.when(F.col("r.lvl") > 0, F.expr("shiftleft(1, r.lvl - 1)"))
                      .otherwise(0).alias("skip"), "tokens")
              .select("seq_id", "lvl", "b1", "b2", "skip", F.posexplode(F.slice(
                  "tokens", F.col("skip") + 1, F.greatest(F.col("skip"), F.lit(1)))).alias("i", "tok")))
    n = (F.col("skip") + F.col("i") + 1).cast("int")
    w = (Window.partitionBy("seq_id", "lvl").orderBy("i")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = ranged.select("seq_id", "lvl", "b1", "b2", n.alias("n"), *[
        F.sum(g).over(w).alias(f"k{j}") for j, g in enumerate(_parts(F.col("tok"), n))])
    return (summed.groupBy("n", "b1", "b2", *SELF)
            .agg(F.count(F.lit(1)).alias("c"), F.min("seq_id").alias("seq_id"))
            .filter("c = 1").groupBy("seq_id").agg(F.min("n").alias("sup_len")))


def prefix_collisions(seqs: DataFrame, id_col: str = "seq_id", tokens_col="tokens") -> DataFrame:
    """Prefix keys that would mix two different prefixes (expected empty).

    By induction on the length, keys are exact iff every key has one parent
    key and one last token.
    """
    rows = prefix_rows(seqs, id_col, tokens_col)
    aggs = [f(c).alias(f"{f.__name__}_{c}") for c in PARENT + ["tok"] for f in (F.min, F.max)]
    mixed = None
    for c in PARENT + ["tok"]:
        d = F.col(f"min_{c}") != F.col(f"max_{c}")
        mixed = d if mixed is None else (mixed | d)
    return rows.groupBy("n", *SELF).agg(*aggs).filter(mixed)


def masked_argmax(scores: Column, permitted: Column) -> Column:
    """A5/T1 in-row: best permitted id by score, lowest id on ties; ids beyond the
    score vector are ignored; NULL when none is left (the walk stops).

    Returns struct(token_id INT, score DOUBLE).
    """
    usable = F.filter(permitted, lambda i: (i >= 0) & (i < F.size(scores)))
    best = F.array_max(F.transform(usable, lambda i: F.struct(
        F.get(scores, i).cast("double").alias("score"), (-i).alias("neg_id"))))
    return F.when(best.isNotNull(), F.struct((-best["neg_id"]).cast("int").alias("token_id"),
                                             best["score"].alias("score")))


def masked_argmax_long(scores: DataFrame, permitted: DataFrame, key: str = "req_id") -> DataFrame:
    """A5 long form: ``scores(key, token_id, score)`` ⋉ ``permitted(key, token_id)`` → best per key.

    Score ties go to the lowest id; keys with no permitted scored id get no row.
    """
    hits = scores.join(permitted, [key, "token_id"], "left_semi")
    best = hits.groupBy(key).agg(F.max(F.struct(F.col("score").cast("double").alias("score"),
                                                (-F.col("token_id")).alias("neg_id"))).alias("b"))
    return best.select(key, (-F.col("b.neg_id")).cast("int").alias("token_id"),
                       F.col("b.score").alias("score"))
