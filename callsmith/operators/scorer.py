"""Pluggable model scorer (X1, X2): requests → a score vector per request.

A model is two callables: ``load()`` runs once per Python worker (the result
is cached in the worker), ``score(model, texts, vocab)`` maps a pandas Series
of texts to one float vector per text, indexed by token id of ``vocab``.
Batches arrive through Arrow, so the model sees whole batches, never single
rows, and Spark partitions the work.  The scores column feeds
``constrained_walk`` (prefix mode) or ``masked_argmax``; given to
``propose_calls`` or ``run_job`` a scorer walks the catalogue itself.

``substring_count_model`` is the deterministic test double: the score of a
vocabulary token is how often it occurs in the lower-cased text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_WORKER_MODELS: dict[str, object] = {}


class ModelScorer:
    name = "model"

    def __init__(self, load: Callable[[], object], score: Callable, name: str = "model",
                 per_step: bool = False):
        self.load = load
        self.score = score
        self.name = name
        self.per_step = per_step

    def scores(self, requests: DataFrame, text_col: str, vocab: list[str],
               out_col: str = "scores") -> DataFrame:
        """Add ``out_col ARRAY<FLOAT>`` (one entry per vocabulary id)."""
        load, score, key = self.load, self.score, self.name
        schema = T.StructType(requests.schema.fields + [
            T.StructField(out_col, T.ArrayType(T.FloatType()), True)])

        def run(batches):
            model = _WORKER_MODELS.get(key)
            if model is None:
                model = _WORKER_MODELS[key] = load()
            for pdf in batches:
                pdf[out_col] = score(model, pdf[text_col], vocab)
                yield pdf

        return requests.mapInPandas(run, schema)

    def vectors(self, texts, generated, vocab: list[str]) -> list:
        """In a worker: one score vector a text.  With ``per_step`` the model also sees
        the token ids generated so far (the logits-from-input-ids hook)."""
        model = _WORKER_MODELS.get(self.name)
        if model is None:
            model = _WORKER_MODELS[self.name] = self.load()
        if self.per_step:
            return list(self.score(model, texts, generated, vocab))
        return list(self.score(model, texts, vocab))

    def walk(self, requests: DataFrame, catalog: DataFrame, text_col: str) -> DataFrame:
        """K1 prefix mode: the model scores the selection context at every branch."""
        from callsmith.operators.walk import walk_model
        return walk_model(requests, catalog, self, text_col, context=True)


class TableScorer:
    """Scores from a column of the requests: one vector each, indexed by token id."""

    name = "table"

    def __init__(self, scores_col: str):
        self.scores_col = scores_col

    def walk(self, requests: DataFrame, catalog: DataFrame, text_col: str) -> DataFrame:
        from callsmith.operators.walk import constrained_walk
        return constrained_walk(requests, catalog, self.scores_col)


def _count_scores(_model, texts, vocab):
    import numpy as np
    out = []
    for t in texts:
        low = (t or "").lower()
        out.append(np.array([low.count(v.lower()) for v in vocab], dtype=np.float32))
    return out


def substring_count_model() -> ModelScorer:
    return ModelScorer(lambda: None, _count_scores, name="substring_count")


def _prefix_aware_scores(_model, texts, generated, vocab):
    """Substring counts minus 0.5 for every time the token was already generated."""
    import numpy as np
    base = _count_scores(None, texts, vocab)
    out = []
    for vec, g in zip(base, generated):
        v = vec.copy()
        for t in (g if g is not None else []):
            if 0 <= t < len(v):
                v[t] -= 0.5
        out.append(v.astype(np.float32))
    return out


def prefix_aware_model() -> ModelScorer:
    """Test double whose scores change with the generated prefix."""
    return ModelScorer(lambda: None, _prefix_aware_scores, name="prefix_aware", per_step=True)
