"""Operator 9: nearest neighbours by learned partitions.

Fit, on a bounded sample of distinct vectors: the sample's neighbour graph is cut into balanced
partitions (balanced start along the main directions, then moves to where
most neighbours are, under a size limit), and a small softmax network learns to name
a vector's partition.  A quarter of the sample is held out; on it the probability
that a query's partitions must hold together is set for the wanted recall, so
vectors without clusters are searched in most partitions.  Index: every row goes to
its most probable partition.  Search: a query goes to its most probable
partitions, as many as hold that probability and enough candidates, and their
rows are ranked by the exact inner product.

Skew: a partition is dealt into blocks of at most ``BLOCK`` rows by a hash, and its queries
into blocks of at most ``QUERIES``, so one group is bounded however many rows
a partition holds; each group returns its best ``k`` and these are merged.

Defined cases: vectors that are null, all zero, of another length than most,
or with null or non-finite components take no part; rows with the query's own
vec_id are no candidates; with fewer candidates than k all are returned; equal
scores go to the smaller vec_id; an empty table gives no rows.  Repeated rows: equal
rows (vec_id and vector) ask once and give one list; a vec_id with several
vectors asks with each, and each gives a whole list of its own under that
query_id; as candidates all rows count, so a repeated one takes a place for each row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from callsmith.llm.common import reliable, sampled

BLOCK = 16_384
QUERIES = 2048


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array<double>) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).filter(
        F.col("v").isNotNull() & F.col("vec_id").isNotNull() & ~odd
        & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (common["n"] if common else 0))


@dataclass
class Router:
    hidden: np.ndarray
    output: np.ndarray
    probability: float = 1.0  # of the partitions that a query visits

    @property
    def partitions(self) -> int:
        return self.output.shape[1]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(_biased(x) @ self.hidden, 0)
        z = _biased(h) @ self.output
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def _biased(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.ones(len(x))])


def neighbour_graph(x: np.ndarray, k: int = 10) -> np.ndarray:
    """Indexes of each row's ``k`` largest inner products with other rows."""
    out = []
    for at in range(0, len(x), 512):
        s = x[at:at + 512] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out.append(np.argpartition(-s, min(k, len(x) - 1) - 1, axis=1)[:, :k])
    return np.concatenate(out)


def balanced_partition(x: np.ndarray, near: np.ndarray, parts: int, rounds: int = 15) -> np.ndarray:
    """Partition numbers of near-equal counts with many edges inside."""
    mine = np.zeros(len(x), np.int64)

    def halve(rows: np.ndarray, first: int, n: int) -> None:
        if n == 1:
            mine[rows] = first
            return
        y = x[rows] - x[rows].mean(axis=0)
        along = y @ np.linalg.svd(y, full_matrices=False)[2][0]
        order = rows[np.argsort(along, kind="stable")]
        cut = len(rows) * (n // 2) // n
        halve(order[:cut], first, n // 2)
        halve(order[cut:], first + n // 2, n - n // 2)

    halve(np.arange(len(x)), 0, parts)
    most = int(np.ceil(1.15 * len(x) / parts))
    for _ in range(rounds):
        votes = np.zeros((len(x), parts))
        for j in range(near.shape[1]):
            np.add.at(votes, (np.arange(len(x)), mine[near[:, j]]), 1)
            np.add.at(votes, (near[:, j], mine), 1)
        want = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), want] - votes[np.arange(len(x)), mine]
        sizes = np.bincount(mine, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[want[i]] < most:
                sizes[mine[i]] -= 1
                sizes[want[i]] += 1
                mine[i] = want[i]
                moved += 1
        if not moved:
            break
    return mine


def fit_router(x: np.ndarray, parts: int, hidden: int = 96, epochs: int = 200) -> Router:
    """Softmax network trained towards the share of each vector's neighbours in each partition."""
    rng = np.random.default_rng(7)
    near = neighbour_graph(x)
    mine = balanced_partition(x, near, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.arange(len(x)), mine), 2)
    for j in range(near.shape[1]):
        np.add.at(target, (np.arange(len(x)), mine[near[:, j]]), 1)
    target /= target.sum(axis=1, keepdims=True)
    weights = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1] + 1, hidden)),
               rng.normal(0, np.sqrt(1 / hidden), (hidden + 1, parts))]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    xb = _biased(x)
    for step in range(1, epochs + 1):
        h = np.maximum(xb @ weights[0], 0)
        hb = _biased(h)
        z = hb @ weights[1]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        d = (p - target) / len(x)
        grads = [xb.T @ ((d @ weights[1][:-1].T) * (h > 0)), hb.T @ d]
        for w, m, v, g in zip(weights, first, second, grads):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= 0.02 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Router(*weights)


def calibrate(router: Router, x: np.ndarray, recall: float, k: int = 5) -> float:
    """The least probability (in steps) with which vectors not used for training find their neighbours."""
    near = neighbour_graph(x, k)
    p = router.probabilities(x)
    order = np.argsort(-p, axis=1, kind="stable")
    held = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1)
    place = np.argsort(order, axis=1, kind="stable")  # of each partition in a query's order
    needed = np.take_along_axis(place, p.argmax(axis=1)[near], axis=1)
    for probability in (0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.97, 0.98, 0.99, 0.995, 0.999):
        visited = 1 + (held < probability).sum(axis=1)
        if (needed < visited[:, None]).mean() >= recall:
            return probability
    return 1.0


def fit(rows: DataFrame, sample: int = 6144, per_partition: int = 4096, least: int = 8,
        recall: float = 0.95) -> Router | None:
    """A router from about ``sample`` rows drawn by a hash of their vectors (equal ones count
    once); ``rows`` as of ``usable``.

    A partition for every ``per_partition`` rows, at least ``least``, each learnt from 32 sampled vectors or
    more.  With fewer than 50 vectors to calibrate on, a query visits every partition."""
    total = rows.count()
    if not total:
        return None
    share = min(1.0, sample / total)
    drawn = rows.filter(sampled(F.col("v"), share)).select("v").distinct()
    x = np.unique(np.array([r["v"] for r in drawn.collect()], float), axis=0)
    x = np.random.default_rng(3).permutation(x)
    held, x = x[:len(x) // 4], x[len(x) // 4:]
    parts = int(min(max(least, total // per_partition), len(x) // 32))
    if parts < 2:
        width = rows.select(F.size("v")).first()[0]
        return Router(np.zeros((width + 1, 1)), np.zeros((2, 1)))
    scale = 1 / max(float(np.sqrt((x * x).mean())), 1e-300)
    router = fit_router(x * scale, parts)
    router.hidden[:-1] *= scale
    router.probability = calibrate(router, held, recall) if len(held) >= 50 else 1.0
    return router


def search(vectors: DataFrame, is_query, k: int = 20, router: Router | None = None,
           least_probes: int = 2) -> DataFrame:
    """query_id, rank, vec_id, score of the rows for which the column ``is_query`` (of vec_id) holds."""
    rows = usable(vectors)
    router = router or fit(rows)
    if router is None:
        return vectors.sparkSession.createDataFrame(
            [], "query_id bigint, rank int, vec_id bigint, score double")

    @F.pandas_udf("array<float>")
    def routed(v: pd.Series) -> pd.Series:
        return pd.Series(list(router.probabilities(np.stack(v.to_numpy())).astype(np.float32)))

    placed = reliable(rows.select("vec_id", "v", routed("v").alias("p")).select(
        "vec_id", "v", "p", (F.array_position("p", F.array_max("p")) - 1).cast("int").alias("part")))
    sizes = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
    counts = np.array([sizes.get(i, 0) for i in range(router.partitions)])

    @F.pandas_udf("array<int>")
    def probes(p: pd.Series) -> pd.Series:
        out = []
        for one in p:
            order = np.argsort(-np.asarray(one), kind="stable")
            enough = max(least_probes, 1 + int(np.searchsorted(np.cumsum(np.asarray(one)[order]),
                                                               router.probability)))
            held = np.cumsum(counts[order])
            enough = max(enough, 1 + int(np.searchsorted(held, min(4 * k + 1, held[-1]))))
            out.append(order[:enough].astype(np.int32))
        return pd.Series(out)

    # One query for each distinct (vec_id, vector); its number holds from the checkpoint on.
    distinct = placed.filter(is_query).dropDuplicates(["vec_id", "v"]).select(
        F.monotonically_increasing_id().alias("query"), F.col("vec_id").alias("query_id"),
        F.col("v").alias("q"), "p")
    asked = reliable(distinct.select("query", "query_id", "q", F.explode(probes("p")).alias("part")))
    asked_sizes = {r["part"]: r["count"] for r in asked.groupBy("part").count().collect()}
    # Blocks of each partition (tables of at most ``most`` entries).
    of_rows = F.element_at(F.array(*[F.lit(max(1, -(-int(c) // BLOCK))) for c in counts]), F.col("part") + 1)
    of_asked = F.element_at(F.array(*[F.lit(max(1, -(-int(asked_sizes.get(i, 0)) // QUERIES)))
                                      for i in range(router.partitions)]), F.col("part") + 1)
    right = placed.select("part", "vec_id", "v", F.pmod(F.xxhash64("vec_id"), of_rows).cast("int").alias("block"),
                          F.explode(F.sequence(F.lit(0), of_asked - 1)).alias("asked_block"))
    left = asked.select("part", "query", "query_id", "q", F.explode(F.sequence(F.lit(0), of_rows - 1))
                        .alias("block"),
                        F.pmod(F.xxhash64("query"), of_asked).cast("int").alias("asked_block"))

    def rank(queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(found):
            return pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []})
        found = found.sort_values("vec_id", kind="stable")
        ids, c = found["vec_id"].to_numpy(), np.stack(found["v"].to_numpy())
        # Of equal vectors only the k smallest other ids can be among the k nearest.
        same = pd.Series([x.tobytes() for x in c])
        first = same.groupby(same).cumcount().to_numpy() < k + np.unique(ids, return_counts=True)[1].max()
        ids, c = ids[first], c[first]
        longest = np.sqrt((c * c).sum(axis=1)).max()
        out = []
        for at in range(0, len(queries), 256):
            part = queries.iloc[at:at + 256]
            numbers, asked_ids = part["query"].to_numpy(), part["query_id"].to_numpy()
            q = np.stack(part["q"].to_numpy())
            quick = q @ c.T
            own = zip(np.searchsorted(ids, asked_ids, "left"), np.searchsorted(ids, asked_ids, "right"))
            for i, (lo, hi) in enumerate(own):
                quick[i, lo:hi] = -np.inf
            least = (np.partition(quick, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k
                     else np.full(len(q), -np.inf))
            # Far more than the rounding of a product, so all that may be among the k nearest stay.
            bound = least - 1e-9 * np.sqrt((q * q).sum(axis=1)) * longest
            bound = np.where(np.isnan(bound), -np.inf, bound)
            row, col = np.nonzero((quick >= bound[:, None]) & (quick != -np.inf))
            scores = np.zeros(len(row))
            for d in range(c.shape[1]):  # in order, so equal vectors get equal scores
                scores += q[row, d] * c[col, d]
            order = np.lexsort((ids[col], -scores, row))
            row, col, scores = row[order], col[order], scores[order]
            best = np.arange(len(row)) - np.searchsorted(row, row, "left") < k
            out.append(pd.DataFrame({"query": numbers[row[best]], "query_id": asked_ids[row[best]],
                                     "vec_id": ids[col[best]], "score": scores[best]}))
        return pd.concat(out)

    keys = ["part", "block", "asked_block"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        rank, "query bigint, query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return best.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").filter(
        F.col("rank") <= k)
