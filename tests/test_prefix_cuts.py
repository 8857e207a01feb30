"""Trie edges by cuts at 1, 2, 4, … tokens (allowed_next, the stored index) against brute force."""

import random
from collections import Counter, defaultdict

import pytest

from callsmith.operators import index_store
from callsmith.operators.prefix import _cut_rows, _distinct_cuts, _parted, _with_runs, allowed_next, with_shared


def _brute(seqs):
    count, names = Counter(), defaultdict(list)
    for i, s in seqs:
        for n, t in enumerate(s or []):
            if t is not None:
                count[n, tuple(s[:n]), t] += 1
                names[n, tuple(s[:n]), t].append(i)
    nodes = defaultdict(list)
    for (n, p, _), ids in names.items():
        nodes[n, p] += ids
    return sorted((min(nodes[n, p]), n, t, c, min(names[n, p, t])) for (n, p, t), c in count.items())


def _sequences(letters, seed, n=120):
    rng = random.Random(seed)
    base = [[rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 40]))] for _ in range(n)]
    copies = [list(rng.choice(base)) for _ in range(n // 3)]
    near = [s[:rng.randint(0, len(s))] + [rng.choice(letters)] for s in copies]
    return list(enumerate([*base, None, *copies, *near]))


@pytest.mark.parametrize("letters", [["a"], ["a", "b"], list("abcdef"), ["a", "b", None]])
def test_edges_by_cuts(spark, tmp_path, letters):
    seqs = _sequences(letters, len(letters))
    d = spark.createDataFrame(seqs, "seq_id bigint, tokens array<string>")
    assert sorted(map(tuple, allowed_next(d).collect())) == _brute(seqs)
    path = str(tmp_path / "index")
    index_store.append_batch(d.filter("seq_id % 3 = 0"), path, "a")
    index_store.append_batch(d.filter("seq_id % 3 > 0"), path, "b")
    assert sorted(map(tuple, index_store.stored_allowed_next(spark, path).collect())) == _brute(seqs)


def test_rows_with_one_id_are_kept_apart(spark):
    seqs = [(1, ["x", "y"]), (1, ["x", "y"]), (2, ["x", "y"]), (None, ["x", "z"])]
    d = spark.createDataFrame(seqs, "seq_id bigint, tokens array<string>")
    got = Counter(map(tuple, allowed_next(d).collect()))
    # As a running key over equal ids gives it: one first token at the root, the others under keys of their own.
    assert got == Counter([(1, 0, "x", 3, 1), (1, 0, "x", 1, 1), (1, 1, "y", 1, 1), (1, 1, "y", 1, 1),
                           (2, 1, "y", 1, 2), (2, 1, "z", 1, None)])


def test_few_rows_hold_the_index_and_few_tokens_are_shared(spark, tmp_path):
    rng = random.Random(1)
    long = [[str(rng.random()) for _ in range(3000)] for _ in range(8)]
    seqs = list(enumerate([*long, *long]))
    d = spark.createDataFrame(seqs, "seq_id bigint, tokens array<string>")
    path = str(tmp_path / "index")
    index_store.append_batch(d, path, "all")
    assert spark.read.parquet(path).count() <= 8 * 14  # 24,000 rows, one a token, before
    parted = _parted(d, "seq_id")
    cuts = _with_runs(parted, with_shared(_distinct_cuts(_cut_rows(parted, "tokens"))), "tokens", "shared")
    assert cuts.filter("shared").selectExpr("sum(size(run))").first()[0] == 8
