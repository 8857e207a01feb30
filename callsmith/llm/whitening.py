"""Operator 11: whitening of embeddings from an exact, bit-sliced scatter.

Each entry c becomes the integer x = floor(64 c) + 1000000.  The fit list holds each
distinct x vector once.  Its cross-products are counted, not multiplied: every dimension is shifted by
its least value, the bit planes of the shifted values are packed across the rows of a block into 64-bit
words, and the cross-product of two dimensions is the sum over plane pairs (p, q) of
2^(p+q) times the set bits of the AND of the two planes.  Blocks add up plane-pair counts; a
task gives its cross-products in base-2^32 digits, which Spark sums without overflow.  The sums are centred as
integers (n T - s s') before they become the covariance, whose eigenvectors (``eigh``) whiten the rows.

Memory: a task holds one block of rows and one count for each pair of planes; the
driver gets one number for each pair of dimensions, whatever the number of rows.  Copies
of a vector are removed before the shuffle as well as after it.

Defined cases: rows whose vector is null or holds null or non-finite entries (or one of 2^56
or more, whose x is no long) are dropped, as are rows of another length than most; an empty
vector is dropped; null and repeated vec_ids stay, row by row; a component without variance
(eigenvalue at most ``least`` of the trace) has no unit scale and gives no rows, so one distinct vector
gives none; an empty table gives none; ``deviation`` is null where it is beyond a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from callsmith.llm.common import reliable

SCALE, SHIFT = 64, 1_000_000
BLOCK = 4096       # rows whose bit planes are packed together
DIGIT = 32         # bits of a digit of the sums that tasks return


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id, x (array<bigint>) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("v"))
    odd = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= float(1 << 56)))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & ~odd)
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (common["n"] if common else 0)).select("vec_id", F.transform(
        "v", lambda c: F.floor(c * float(SCALE)).cast("bigint") + F.lit(SHIFT)).alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def planes(shifted: np.ndarray, bits: list[int]) -> np.ndarray:
    """The bit planes (words of 64 rows each) of non-negative rows, dimension by dimension."""
    rows = -(-len(shifted) // 64) * 64
    padded = np.zeros((shifted.shape[1], rows), np.uint64)
    padded[:, :len(shifted)] = shifted.T
    out = np.empty((sum(bits), rows // 64), np.uint64)
    at = 0
    for j, b in enumerate(bits):
        for p in range(b):
            bit = ((padded[j] >> np.uint64(p)) & np.uint64(1)).astype(np.uint8)
            out[at] = np.packbits(bit, bitorder="little").view(np.uint64)
            at += 1
    return out


def count_pairs(words: np.ndarray, counts: np.ndarray) -> None:
    """Add the set bits of the AND of each pair of planes (upper triangle) to ``counts``."""
    step = max(1, (1 << 21) // max(1, words.size))  # AND results held at once, in whole planes
    for at in range(0, len(words), step):
        some = words[at:at + step, None, :] & words[None, at:, :]
        counts[at:at + step, at:] += np.bitwise_count(some).sum(axis=2, dtype=np.int64)


def cross_products(counts: np.ndarray, bits: list[int]) -> dict[tuple[int, int], int]:
    """Exact sums of products of two dimensions (j <= k) from the counts of their plane pairs."""
    first = np.concatenate([[0], np.cumsum(bits)]).astype(int)
    out = {}
    for j in range(len(bits)):
        for k in range(j, len(bits)):
            part = counts[first[j]:first[j + 1], first[k]:first[k + 1]]
            if k == j:  # only the upper triangle is counted
                part = np.triu(part) + np.triu(part, 1).T
            total = 0
            for p in range(part.shape[0]):
                for q in np.flatnonzero(part[p]).tolist():
                    total += int(part[p, q]) << (p + q)
            out[j, k] = total
    return out


def _digits(total: int) -> list[tuple[int, int]]:
    found, place = [], 0
    while total:
        found.append((place, total & ((1 << DIGIT) - 1)))
        total >>= DIGIT
        place += 1
    return found


@dataclass
class Whitening:
    n: int
    least: list[int]         # of x, by dimension
    sums: list[int]          # of x minus its least
    trace: float
    values: np.ndarray       # eigenvalues, falling
    vectors: np.ndarray      # dims x components
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once: the shift cancels as integers."""
        y = x - np.array(self.least, np.int64)
        mean = [divmod(s, self.n) for s in self.sums]
        whole = np.array([w for w, _ in mean], np.int64)
        return (y - whole).astype(float) - np.array([r / self.n for _, r in mean])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sum of (n x - S)^2 of each row; None beyond a long."""
        y = x - np.array(self.least, np.int64)
        largest = max(self.n * int(y.max(initial=0)), max(self.sums, default=0))
        if largest * largest * x.shape[1] < 1 << 62:
            d = self.n * y - np.array(self.sums, np.int64)
            return (d * d).sum(axis=1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in y.tolist()]
        return [e if e < 1 << 63 else None for e in exact]


def fit(rows: DataFrame, components: int = 16, least: float = 1e-12) -> Whitening | None:
    """``rows`` as of ``integers``; None for an empty table."""
    distinct = reliable(rows.select("x").distinct())
    entries = distinct.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(
        F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"),
        F.sum(F.col("v").cast("decimal(38,0)")).alias("total")).orderBy("j").collect()
    if not entries:
        return None
    dims, n = len(entries), entries[0]["n"]
    low = [r["low"] for r in entries]
    sums = [int(r["total"]) - n * r["low"] for r in entries]
    bits = [(r["high"] - r["low"]).bit_length() for r in entries]

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((sum(bits), sum(bits)), np.int64)
        for b in batches:
            x = _matrix(b.column(0), dims) - np.array(low, np.int64)
            for at in range(0, len(x), BLOCK):
                count_pairs(planes(x[at:at + BLOCK], bits), counts)
        found = [(j, k, place, digit) for (j, k), total in cross_products(counts, bits).items()
                 for place, digit in _digits(total)]
        cols = list(zip(*found)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
            ["j", "k", "place", "digit"])

    products = np.zeros((dims, dims), object)
    for r in distinct.mapInArrow(scatter, "j int, k int, place int, digit bigint").groupBy(
            "j", "k", "place").agg(F.sum("digit").alias("digit")).collect():
        products[r["j"], r["k"]] += r["digit"] << (DIGIT * r["place"])
    products = np.maximum(products, products.T)  # the lower triangle is zero
    s = np.array(sums, object)
    centred = n * products - np.outer(s, s)      # exact integers: n^2 times the covariance
    covariance = np.array([[c / (n * n) for c in row] for row in centred.tolist()], float)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    trace = sum(centred[j, j] for j in range(dims)) / (n * n)
    order = order[values[order] > least * trace]
    found = Whitening(n, low, sums, trace, values[order], vectors[:, order])
    found.identity_error = _identity_error(distinct, found, dims)
    return found


def _identity_error(distinct: DataFrame, model: Whitening, dims: int) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity, by one more pass."""
    c = len(model.values)
    if not c:
        return 0.0

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, product = np.zeros(c), np.zeros((c, c))
        for b in batches:
            w = model.whitened(_matrix(b.column(0), dims))
            total += w.sum(axis=0)
            product += w.T @ w
        j, k = np.divmod(np.arange(c * c), c)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*j.tolist(), *range(c)], pa.int32()), pa.array([*k.tolist(), *[-1] * c], pa.int32()),
             pa.array([*product.reshape(-1).tolist(), *total.tolist()], pa.float64())], ["j", "k", "part"])

    cells = {(r["j"], r["k"]): r["part"] / model.n for r in distinct.mapInArrow(
        moments, "j int, k int, part double").groupBy("j", "k").agg(F.sum("part").alias("part")).collect()}
    return max(abs(cells[j, k] - cells[j, -1] * cells[k, -1] - (j == k)) for j in range(c) for k in range(c))


def whiten(vectors: DataFrame, components: int = 16) -> DataFrame:
    """A row for each remaining row of ``vectors`` and component: vec_id, component (from 1), n,
    deviation, whitened, explained, identity_error."""
    schema = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    rows = integers(vectors)
    model = fit(rows, components)
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    dims, c = len(model.least), len(model.values)
    explained = (model.values / model.trace).tolist()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                x = _matrix(part.column(1), dims)
                m = len(x)
                ids = part.column(0).take(pa.array(np.repeat(np.arange(m), c)))
                deviation = pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), c)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * c, model.n, np.int64)), deviation,
                     pa.array(model.whitened(x).reshape(-1)), pa.array(np.tile(explained, m)),
                     pa.array(np.full(m * c, model.identity_error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)
