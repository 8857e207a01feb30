"""Candidate choice by a model (K2, J7, T2, T3 with X1): arguments are bound in declared order, and
where one has several candidates a model chooses among them token by token.

The candidates themselves (F1-F16) are computed in the JVM, once per row.  One Arrow pass then goes through a
batch: for the first argument, then the second, and so on, all rows with several
candidates walk the little trie of their candidates together, and the model is asked once per branch round
for all of them, with the argument's context (F20: its name, the first five candidates, the request) and the token ids generated
so far.  A pick is excluded from the numeric candidates of later arguments, as in the fold.

The walk takes the best-scored permitted token (lowest id on ties, ids beyond the vector are not
permitted; where one token is permitted the model is not asked), ends at the first candidate whose whole
token list is generated, so a shorter candidate wins over a longer one that it begins, and gives
the first candidate where nothing is permitted.  A row for which the model raises, or gives no
vector, is marked and becomes the fallback call; the others of its batch go on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsmith import fixed
from callsmith.operators.bind import PICK_TYPE, candidate_features, candidates

_NUMERIC = ("int", "float")
_STEP = 1 << 20

class _Walk:
    """One row's walk among the candidates of one argument."""

    def __init__(self, row: int, cands: list[str], context: str, tokens: list[list[int]]):
        self.row, self.cands, self.context, self.tokens = row, cands, context, tokens
        self.ids: list[int] = []
        self.result: str | None = None
        self.permitted: list[int] = []
        self._forced()

    def _forced(self) -> None:
        """Walk on while one token is permitted; stop at a result or a branch."""
        while True:
            n = len(self.ids)
            whole = [c for c, t in zip(self.cands, self.tokens) if t == self.ids]
            if n and whole:
                self.result = whole[0]
                return
            self.permitted = sorted({t[n] for t in self.tokens if len(t) > n and t[:n] == self.ids})
            if not self.permitted:
                self.result = self.cands[0]
                return
            if len(self.permitted) > 1:
                return
            self.ids.append(self.permitted[0])

    def take(self, scores: np.ndarray) -> None:
        usable = [t for t in self.permitted if t < len(scores)]
        if not usable:
            self.result = self.cands[0]
            return
        best = scores[usable]
        self.ids.append(usable[int(np.argmax(np.where(np.isnan(best), np.inf, best)))])
        self._forced()


def choose(scorer, batch: list[tuple[int, list[str], str]], tokenize: Callable[[str], list[str]]) -> dict[int, str | None]:
    """The chosen candidate of each ``(row, candidates, context)``; None where the model failed."""
    from callsmith.operators.walk import _asked
    cut = [[tokenize(c) for c in cands] for _, cands, _ in batch]
    vocab = sorted({t for cands in cut for tokens in cands for t in tokens})
    number = {t: i for i, t in enumerate(vocab)}
    walks = [_Walk(row, cands, context, [[number[t] for t in tokens] for tokens in each])
             for (row, cands, context), each in zip(batch, cut)]
    found = {}
    while walks:
        going = []
        for w in walks:
            if w.result is None:
                going.append(w)
            else:
                found[w.row] = w.result
        walks = going
        if not walks:
            break
        vectors = _asked(scorer, vocab, pd.Series([w.context for w in walks], dtype=object), [list(w.ids) for w in walks])
        for w, v in zip(walks, vectors):
            if v is None:
                found[w.row] = None
            else:
                w.take(v)
        walks = [w for w in walks if w.row not in found]
    return found


def bind_with_model(df: DataFrame, scorer, text_col: str = "prompt", fn_col: str = "fn_name",
                    args_col: str = "fn_args", tokenize: Callable[[str], list[str]] = list) -> DataFrame:
    """Add ``picks`` (as ``bind_arguments``) and ``choice_failed``; ``scorer`` is a ``ModelScorer``.

    ``tokenize`` cuts a candidate into the model's tokens (default: characters); the vocabulary that the
    model sees is the sorted list of the tokens of a batch's candidates."""
    text, fn, args = F.col(text_col), F.col(fn_col), F.col(args_col)
    feats = candidate_features(text, fn, args)
    none = F.array().cast("array<string>")
    listed = "array<struct<arg_ord:int,arg_name:string,arg_type:string,cands:array<string>>>"
    # The features ride in the accumulator, as in the fold, so they are computed once per row.
    init = F.struct(F.array().cast(listed).alias("out"), F.struct(*[c.alias(k) for k, c in feats.items()]).alias("f"))

    def step(acc, a):
        cands = candidates({k: acc["f"][k] for k in feats}, fn, a, none)
        one = F.struct(a["arg_ord"].cast("int").alias("arg_ord"), a["arg_name"].alias("arg_name"),
                       a["arg_type"].alias("arg_type"), cands.alias("cands"))
        return F.struct(F.concat(acc["out"], F.array(one)).alias("out"), acc["f"].alias("f"))

    packed = df.select(F.struct(*df.columns).alias("request"), text.alias("text"),
                       F.aggregate(args, init, step)["out"].alias("listed"))
    picks_type = pa.list_(pa.struct([("arg_ord", pa.int32()), ("arg_name", pa.string()), ("arg_type", pa.string()),
                                     ("raw", pa.string()), ("n_cands", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, lists = b.column(1).to_pylist(), b.column(2).to_pylist()
            picks: list[list[dict]] = [[] for _ in texts]
            used: list[set[str]] = [set() for _ in texts]
            failed = [False] * len(texts)
            for k in range(max((len(x) for x in lists if x), default=0)):
                asked, single = [], {}
                for i, args in enumerate(lists):
                    if not args or len(args) <= k:
                        continue
                    a = args[k]
                    cands = [c for c in a["cands"] if a["arg_type"] not in _NUMERIC or c not in used[i]]
                    single[i] = (a, cands)
                    if len(cands) > 1 and not failed[i]:
                        shown = ", ".join(f'"{c}"' for c in cands[:5])
                        asked.append((i, cands, fixed.ARGUMENT_CONTEXT % (a["arg_name"], shown, texts[i] or "")))
                chosen = choose(scorer, asked, tokenize) if asked else {}
                for i, (a, cands) in single.items():
                    value = chosen.get(i, cands[0] if cands else "")
                    if value is None:
                        failed[i], value = True, cands[0]
                    used[i].add(value)
                    picks[i].append({"arg_ord": a["arg_ord"], "arg_name": a["arg_name"], "arg_type": a["arg_type"],
                                     "raw": value, "n_cands": len(cands)})
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(picks, picks_type), pa.array(failed, pa.bool_())],
                                             ["request", "picks", "choice_failed"])

    schema = T.StructType([packed.schema["request"], *T.StructType.fromDDL(
        f"picks array<{PICK_TYPE}>, choice_failed boolean").fields])
    return packed.mapInArrow(run, schema).select(*[F.col("request")[c].alias(c) for c in df.columns],
                                                 "picks", "choice_failed")


def bigram_model(texts: DataFrame, text_col: str = "text", name: str = "bigram"):
    """A ``ModelScorer`` over characters learnt from a text column: a token's score is how often its
    character follows the last generated one (a space, at the start) in ``texts``.

    Only printable ASCII is counted, so the table has 95 x 95 counts at most, whatever the texts."""
    from callsmith.operators.scorer import ModelScorer

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 14, np.int64)
        for b in batches:
            for t in b.column(0).cast(pa.binary()):
                raw = np.frombuffer(t.as_py() or b"", np.uint8)
                for at in range(0, len(raw), _STEP):  # steps overlap by one character
                    part = raw[at:at + _STEP + 1].astype(np.uint16)
                    ok = (part >= 0x20) & (part <= 0x7E)
                    total += np.bincount((part[:-1] << 7 | part[1:])[ok[:-1] & ok[1:]], minlength=1 << 14)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], ["pair", "n"])

    pairs = texts.select(F.col(text_col).cast("string")).mapInArrow(counted, "pair int, n bigint").groupBy("pair").agg(
        F.sum("n").alias("n"))
    counts = {chr(r["pair"] >> 7) + chr(r["pair"] & 127): r["n"] for r in pairs.collect()}

    def score(_model, asked, generated, vocab):
        out = []
        for ids in generated:
            last = vocab[ids[-1]][-1] if len(ids) else " "
            out.append(np.array([counts.get(last + t[0], 0) for t in vocab], float))
        return out

    return ModelScorer(lambda: None, score, name=name, per_step=True)
