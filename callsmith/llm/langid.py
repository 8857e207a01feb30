"""Operator 7: language ID by nearest centroids.

A text's vector: character 1- to 3-grams of the lower-cased text (all that is not a
letter is one space), hashed to ``BINS`` bins, weighted by tf-idf and
normalised.  Document frequencies come from every training document; each language has
several centroids.  They start from a clustering of a few texts, in one task
a language, and are then moved by every training document in ``ROUNDS`` passes of k-means, which add up
vectors by partition.  A text gets the language of the nearest centroid by cosine.  It is
rejected where it has no letter, or where its cosine is below a floor: a quarter of all training texts is held out of
centroids of the rest, windows of many lengths are cut from each, and the floor of a language at a length
is ``margin`` times a low quantile of their cosines, since short texts are far from every centroid.
The centroids are then those of all training documents.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
without training rows every text is ``und``; equal cosines go to the language
that sorts first; rows with a null doc_id train and are not held out; repeated
rows repeat.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BINS = 8192
_STEP = 1 << 20

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool))
    return _LETTERS[0]


def _gram_bins(x: np.ndarray) -> list[np.ndarray]:
    """The bins of the 1-, 2- and 3-grams of code points, by where they begin."""
    mixed = x * np.uint32(2654435761)
    grams = mixed
    hashed = [grams]
    for _ in range(2):
        grams = (grams[:-1] * np.uint32(16777619)) ^ mixed[len(mixed) - len(grams) + 1:]
        hashed.append(grams)
    return [(h * np.uint32(2246822519)) >> np.uint32(19) for h in hashed]


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed 1- to 3-grams; None for a text without a letter."""
    raw = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    counts = np.zeros(BINS, np.int64)
    any_letter = False
    for at in range(0, len(raw), _STEP):  # bounded memory; steps overlap by two characters
        part = raw[max(0, at - 2):at + _STEP]
        letter = _letters()[part]
        any_letter = any_letter or bool(letter.any())
        x = np.where(letter, part, 32).astype(np.uint32)
        x = x[np.concatenate([[True], (x[1:] != 32) | (x[:-1] != 32)])]
        for h in _gram_bins(x):
            counts += np.bincount(h, minlength=BINS)
    return counts if any_letter else None


def _unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    return v / max(np.linalg.norm(v), 1e-12)


def cluster(vectors: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means from a farthest-first start."""
    chosen = [int(np.argmax(vectors @ vectors.mean(axis=0)))]
    nearest = vectors @ vectors[chosen[0]]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centres = vectors[chosen]
    for _ in range(rounds):
        mine = np.argmax(vectors @ centres.T, axis=1)
        sums = np.stack([vectors[mine == c].sum(axis=0) if (mine == c).any() else centres[c]
                         for c in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


@dataclass
class Model:
    languages: list[str]      # of each centroid
    centres: np.ndarray       # centroids x BINS, unit length
    floors: dict[str, list[float]]  # by size class: a low quantile of held-out windows' cosines
    idf: np.ndarray

    def floor(self, lang: str, counts: np.ndarray) -> float:
        known = self.floors[lang]
        return known[min(size_class(counts), len(known) - 1)]


CLASSES = 14       # size classes: powers of two of a text's grams, the last for all beyond
QUANTILE = 0.01
STEPS = 10_000     # of the cosines that are counted for a floor
ROUNDS = 2         # passes of k-means over all training documents
OUT = 4            # a text of so many is held out of the centroids that the floors are measured on
WINDOWS = 6        # cut from each held-out text for each size class


def size_class(counts: np.ndarray) -> int:
    return int(counts.sum()).bit_length()


def window_cosines(text: str, centres: np.ndarray, idf: np.ndarray) -> Iterator[tuple[int, float]]:
    """(size class, cosine) of windows of many lengths: that of the nearest centroid."""
    low = (text or "").lower()
    for c in range(2, CLASSES):
        size = max(1, (1 << c) // 4)  # characters of about 3 grams each, in the middle of the class
        starts = {(len(low) - size) * k // (WINDOWS - 1) for k in range(WINDOWS)} if len(low) > size else {0}
        if c == 2:
            # Runs of non-letters are one space, so a window of the text is a stretch of what is left.
            raw = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")
            x = np.where(_letters()[raw], raw, 32).astype(np.uint32)
            kept = np.concatenate([[True], (x[1:] != 32) | (x[:-1] != 32)])[:len(x)]
            place, x = np.cumsum(kept) - 1, x[kept]
            bins = _gram_bins(x)
        for at in starts:
            if not len(x):
                break
            i, j = int(place[at]), int(place[min(at + size, len(low)) - 1]) + 1
            if not (x[i:j] != 32).any():
                continue
            found, counts = np.unique(np.concatenate([b[i:max(i, j - k)] for k, b in enumerate(bins)]), return_counts=True)
            v = np.log1p(counts) * idf[found]
            yield (min(int(counts.sum()).bit_length(), CLASSES - 1),
                   float((v @ centres[:, found].T).max() / max(np.linalg.norm(v), 1e-12)))
        if len(low) <= size:
            break


def floors_of(steps: dict[int, dict[int, int]]) -> list[float]:
    """The floor of each size class from counts of its windows' cosines in steps of 1/``STEPS``; a class without any
    has that of the next smaller one."""
    out: list[float] = []
    for c in range(CLASSES):
        left = QUANTILE * (sum(steps.get(c, {}).values()) - 1)
        found = None
        for step, n in sorted(steps.get(c, {}).items()):
            found, left = step / STEPS, left - n
            if left < 0:
                break
        out.append(found if found is not None else out[-1] if out else 0.0)
    return out


def held_out(doc_id) -> "F.Column":
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _out(text: str) -> bool:
    """Whether a training text is held out of the centroids that the floors are measured on."""
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % OUT == 0


def _moved(rows: DataFrame, languages: np.ndarray, kinds: np.ndarray, centres: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """One pass of k-means: each centroid becomes the direction of the sum of the documents nearest to it among those of
    its language and kind (0: of all documents, 1: of those that are not held out).  Partitions add up their own."""
    block = 512

    known = set(languages.tolist())

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centres), BINS))
        groups = {(lang, kind): np.flatnonzero((languages == lang) & (kinds == kind)) for lang in known for kind in (0, 1)}
        for b in batches:
            for text, lang in zip(*(c.to_pylist() for c in b.columns)):
                counts = gram_counts(text)
                if counts is None or lang not in known:
                    continue
                v = _unit(counts, idf)
                bins = np.flatnonzero(counts)
                for kind in (0, 1) if not _out(text) else (0,):
                    mine = groups[lang, kind]
                    if len(mine):
                        best = mine[int(np.argmax(centres[np.ix_(mine, bins)] @ v[bins]))]
                        total[best, bins] += v[bins]
        for c, at in zip(*np.nonzero(total.reshape(len(centres), -1, block).any(axis=2))):
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([at], pa.int32()), pa.array(
                [total[c, at * block:(at + 1) * block].tolist()], pa.list_(pa.float64()))], ["c", "at", "part"])

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        # In an order that does not hang on the shuffle.
        return pd.DataFrame({"c": pdf["c"].iloc[:1], "at": pdf["at"].iloc[:1], "part": [np.sort(np.stack(pdf["part"]), axis=0).sum(axis=0).tolist()]})

    out = np.zeros_like(centres)
    form = "c int, at int, part array<double>"
    for r in rows.select("text", "lang").mapInArrow(sums, form).groupBy("c", "at").applyInPandas(added, form).collect():
        out[r["c"], r["at"] * block:(r["at"] + 1) * block] = r["part"]
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return np.where(norms > 0, out / np.maximum(norms, 1e-12), centres)  # one that no text is near stays


def _floors(rows: DataFrame, languages: np.ndarray, centres: np.ndarray, idf: np.ndarray) -> dict[str, list[float]]:
    """The floors of each language from the windows of all held-out texts."""
    known = set(languages.tolist())

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int, int], int] = {}
        for b in batches:
            for text, lang in zip(*(c.to_pylist() for c in b.columns)):
                if text is None or lang not in known or not _out(text):
                    continue
                for c, cosine in window_cosines(text, centres[languages == lang], idf):
                    key = lang, c, int(cosine * STEPS)
                    found[key] = found.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.int32()),
             pa.array([k[2] for k in found], pa.int32()), pa.array(list(found.values()), pa.int64())], ["lang", "c", "step", "n"])

    counted: dict[str, dict[int, dict[int, int]]] = {}
    for r in rows.select("text", "lang").mapInArrow(steps, "lang string, c int, step int, n bigint").groupBy(
            "lang", "c", "step").agg(F.sum("n").alias("n")).collect():
        counted.setdefault(r["lang"], {}).setdefault(r["c"], {})[r["step"]] = r["n"]
    return {lang: floors_of(counted.get(lang, {})) for lang in known}


def train(docs: DataFrame, sample: int = 300, centroids: int = 4) -> Model:
    """Fit on (doc_id, text, lang) rows with a non-null lang.  ``sample`` distinct texts with
    a letter a language (all where it has fewer), those with the least hashes, give the first centroids; all rows
    move them, and all rows give idf and the floors."""
    rows = docs.select(F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang")).filter("lang is not null")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BINS, np.int64), 0
        for b in batches:
            for t in b.column(0):
                counts = gram_counts(t.as_py())
                if counts is not None:
                    total, n = total + (counts > 0), n + 1
        bins = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*bins.tolist(), -1], pa.int32()), pa.array([*total[bins].tolist(), n], pa.int64())],
            ["bin", "df"])

    df = dict(rows.select("text").mapInArrow(frequencies, "bin int, df bigint")
              .groupBy("bin").agg(F.sum("df")).collect())
    n = df.pop(-1, 0)
    idf = np.full(BINS, np.log(1 + n) + 1)
    for b, c in df.items():
        idf[b] = np.log((1 + n) / (1 + c)) + 1

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        found = sorted(((t, c) for t, c in zip(pdf["text"], map(gram_counts, pdf["text"])) if c is not None),
                       key=lambda p: p[0])
        texts, counts = [t for t, _ in found], [c for _, c in found]
        if not counts:
            return pd.DataFrame({"lang": [], "kind": [], "centre": []}, dtype=object)
        vectors = np.stack([_unit(c, idf) for c in counts])
        rest = vectors[[not _out(t) for t in texts]] if len(texts) >= 8 else vectors[:0]
        kinds = [(kind, c.tolist()) for kind, of in ((0, vectors), (1, rest)) if len(of) for c in cluster(of, centroids)]
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "kind": [k for k, _ in kinds], "centre": [c for _, c in kinds]})

    # Distinct texts are counted, so copies thin no language out.  Twice the sample by share
    # holds the least hashes; only these few are sorted.
    lettered = rows.filter(F.col("text").rlike(r"\p{L}")).withColumn(
        "h", F.pmod(F.xxhash64("text"), F.lit(1 << 53)))
    hashes = lettered.select("lang", "h").distinct()
    share = hashes.groupBy("lang").count().select(
        F.col("lang").alias("of"), (F.lit(2.0 * sample * (1 << 53)) / F.col("count")).alias("below"))
    least = hashes.join(F.broadcast(share), F.col("lang") == F.col("of")).filter("h < below").groupBy(
        "of").agg(F.slice(F.array_sort(F.collect_list("h")), 1, sample).alias("hs")).select(
        "of", F.explode("hs").alias("of_h"))
    drawn = lettered.join(F.broadcast(least), (F.col("lang") == F.col("of")) & (F.col("h") == F.col("of_h"))
                          ).select("lang", "text").distinct()
    fitted = drawn.groupBy("lang").applyInPandas(
        fit, "lang string, kind int, centre array<double>").orderBy("lang", "kind").collect()
    languages, kinds = np.array([r["lang"] for r in fitted], dtype=object), np.array([r["kind"] for r in fitted], dtype=int)
    centres = np.array([r["centre"] for r in fitted]).reshape(len(fitted), BINS)
    for _ in range(ROUNDS if len(fitted) else 0):
        centres = _moved(rows, languages, kinds, centres, idf)
    # A few texts hold none out: their language has no floor.
    floors = {lang: [0.0] for lang in languages.tolist()}
    if (kinds == 1).any():
        floors |= _floors(rows, languages[kinds == 1], centres[kinds == 1], idf)
    return Model(languages[kinds == 0].tolist(), centres[kinds == 0], floors, idf)


def _predict(model: Model, margin: float):
    centres = model.centres.T

    @F.pandas_udf("lang string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            counts = gram_counts(t)
            if counts is None or not model.languages:
                out.append(("und", 0.0, True))
                continue
            cosines = _unit(counts, model.idf) @ centres
            best = int(np.argmax(cosines))
            lang, score = model.languages[best], float(np.clip(cosines[best], 0.0, 1.0))
            out.append((lang, score, score < margin * model.floor(lang, counts)))
        return pd.DataFrame(out, columns=["lang", "score", "rejected"])

    return predict(F.col("text").cast("string"))


def identify(docs: DataFrame, model: Model, margin: float = 0.75) -> DataFrame:
    """Per row of ``docs``: doc_id, lang_pred, lang_score, lang_rejected; only the text is read."""
    return docs.select("doc_id", _predict(model, margin).alias("found")).select(
        "doc_id", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("lang_score"),
        F.col("found.rejected").alias("lang_rejected"))


def accepted(docs: DataFrame, model: Model, margin: float = 0.75) -> DataFrame:
    """``docs`` without the rows that are rejected."""
    return docs.withColumn("_langid_found", _predict(model, margin)).filter(
        ~F.col("_langid_found.rejected")).select(*docs.columns)
