"""Operator 11 against plain integers and numpy."""

import math

import numpy as np

from callsmith.llm import whitening
from callsmith.llm.queries import op11_whitening
from conftest import SMALL

VECTORS = "vec_id bigint, embedding array<double>, component int, n string, x int, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "n", 2, "v") for i, v in rows], VECTORS)


def brute(rows):
    """(rows kept, n, deviations, covariance of the fit list) with Python's integers."""
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows
            if v and not any(c is None or not math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(dims)]
    cov = [[sum((n * x[j] - sums[j]) * (n * x[k] - sums[k]) for x in fit) / n ** 3 for k in range(dims)]
           for j in range(dims)]
    return kept, n, sums, np.array(cov)


def check(spark, rows, components=16):
    kept, n, sums, cov = brute(rows)
    values = np.sort(np.linalg.eigvalsh(cov))[::-1]
    got = whitening.whiten(frame(spark, rows), components).collect()
    want = [v for v in values[:components] if v > 1e-12 * np.trace(cov)]
    assert len(got) == len(kept) * len(want)
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    for i, x in kept:
        mine = by[i, sum((n * c - s) ** 2 for c, s in zip(x, sums))]
        assert sorted(mine) == list(range(1, len(want) + 1))
        for c, r in mine.items():
            assert r.n == n and abs(r.explained - values[c - 1] / np.trace(cov)) < 1e-9
            assert r.identity_error < 1e-6
    # The whitened fit list is uncorrelated and of unit variance, and spans the centred vectors.
    first = {}
    for i, x in kept:
        first.setdefault(tuple(x), by[i, sum((n * c - s) ** 2 for c, s in zip(x, sums))])
    w = np.array([[m[c].whitened for c in range(1, len(want) + 1)] for m in first.values()])
    assert np.abs(w.T @ w / n - np.eye(len(want))).max() < 1e-6
    if len(want) == len(cov):
        centred = np.array(list(first), float) - np.array(sums) / n
        assert np.allclose((w ** 2).sum(axis=1), np.einsum("ij,jk,ik->i", centred, np.linalg.inv(cov), centred))


def test_whitening_against_plain_integers(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=5) * [1, 3, 0.2, 7, 1]).tolist()) for i in range(300)]
    rows += [(1, rows[1][1]), (1, rows[2][1]), (400, rows[3][1]), (None, rows[4][1])]
    rows += [(500 + k, rows[5][1]) for k in range(200)]
    rows += [(900, None), (901, [1.0, None, 2.0, 3.0, 4.0]), (902, [math.nan, 1.0, 2.0, 3.0, 4.0]),
             (903, [math.inf, 1.0, 2.0, 3.0, 4.0])]
    check(spark, rows)
    check(spark, rows, components=2)


def test_wide_ranges_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=3) * [1e9, 1e-3, 1e6]).tolist()) for i in range(70)]
    got = whitening.whiten(frame(spark, rows), 3).collect()
    kept, n, sums, cov = brute(rows)
    exact = {i: sum((n * c - s) ** 2 for c, s in zip(x, sums)) for i, x in kept}
    assert all(r.deviation == (exact[r.vec_id] if exact[r.vec_id] < 1 << 63 else None) for r in got)
    assert any(r.deviation is None for r in got)
    values = np.sort(np.linalg.eigvalsh(cov))[::-1]
    assert all(abs(r.explained * np.trace(cov) / values[r.component - 1] - 1) < 1e-6 for r in got
               if r.component < 3)


def test_cross_products_of_bit_planes():
    rng = np.random.default_rng(6)
    y = rng.integers(0, 1 << 40, (131, 4))
    y[:, 2] = 0
    bits = [int(c.max()).bit_length() for c in y.T]
    counts = np.zeros((sum(bits), sum(bits)), np.int64)
    for at in range(0, len(y), 50):
        whitening.count_pairs(whitening.planes(y[at:at + 50], bits), counts)
    found = whitening.cross_products(counts, bits)
    for j in range(4):
        for k in range(j, 4):
            assert found[j, k] == sum(int(a) * int(b) for a, b in zip(y[:, j], y[:, k]))


def test_whitening_without_variance_or_rows(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    flat = [(i, [float(i), 5.0, float(-i)]) for i in range(9)]  # one direction only
    assert {r.component for r in whitening.whiten(frame(spark, flat)).collect()} == {1}
    odd = [(i, [float(i), float(i % 2)]) for i in range(6)] + [(9, [1.0]), (10, [1e300, 0.0])]
    assert whitening.whiten(frame(spark, odd)).select("vec_id").distinct().count() == 6


def test_whitening_of_the_table(spark):
    rows = op11_whitening(spark, SMALL).collect()
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    kept, n, sums, cov = brute([(r.vec_id, [float(c) for c in r.embedding]) for r in table])
    values = np.sort(np.linalg.eigvalsh(cov))[::-1]
    assert len(rows) == 16 * len(kept)
    assert all(abs(r.explained * np.trace(cov) / values[r.component - 1] - 1) < 1e-9 for r in rows)
    assert max(r.identity_error for r in rows) < 1e-6
