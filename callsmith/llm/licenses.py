"""Operator 5: license notices by fuzzy short-notice search.

Texts are taken as their words, joined by one space.  A notice of at most e
edits is cut into e + 1 seeds: one of them must occur exactly (pigeonhole).  One
Aho-Corasick automaton finds all seeds of all notices; around each hit the
``regex`` library matches the whole notice with at most e edits and reports its
span.  Base phrases (exact, at word boundaries) are found in the same text and
always stay.

Defined cases: null and empty texts have no words, labels or spans and score 0;
the score is 1 with a base place, else 1 - edits / length of the best fuzzy
match, else 0; overlapping places all count; repeated rows repeat; an empty
table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

# Base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by",
        "mit license": "mit"}
# Short public notices, their labels and the edits allowed.
NOTICES = [
    ("gnu general public license", "gpl", 2),
    ("gnu lesser general public license", "lgpl", 3),
    ("licensed under the apache license", "apache", 3),
    ("released under the mit license", "mit", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    ("licensed under cc by", "cc-by", 1),
    ("creative commons attribution", "cc-by", 2),
    ("redistribution and use in source and binary forms", "bsd", 4),
    ("mozilla public license", "mpl", 2),
    ("permission to use copy modify and or distribute this software", "isc", 5),
]

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def seeds(notice: str, edits: int) -> list[tuple[str, int]]:
    """``edits`` + 1 pieces of near-equal length with their places in the notice."""
    cuts = [len(notice) * k // (edits + 1) for k in range(edits + 2)]
    return [(notice[a:z], a) for a, z in zip(cuts, cuts[1:])]


class Scanner:
    """Built once in a worker."""

    def __init__(self, notices=NOTICES, base=BASE):
        import ahocorasick
        import regex

        self.notices, self.base = notices, base
        self.automaton = ahocorasick.Automaton()
        at: dict[str, list[tuple[int, int]]] = {}
        for k, (notice, _, edits) in enumerate(notices):
            for piece, place in seeds(notice, edits):
                at.setdefault(piece, []).append((k, place))
        for piece, places in at.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()
        self.fuzzy = [regex.compile(rf"(?e)(?:{regex.escape(n)}){{e<={e}}}") for n, _, e in notices]

    def fuzzy_spans(self, text: str) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, edits) of the notices, by start."""
        windows: dict[int, list[list[int]]] = {}
        for last, (size, places) in self.automaton.iter(text):
            for k, place in places:
                notice, _, edits = self.notices[k]
                begin = last + 1 - size - place
                a, z = max(0, begin - edits), min(len(text), begin + len(notice) + edits)
                mine = windows.setdefault(k, [])
                if mine and a <= mine[-1][1]:
                    mine[-1] = [min(mine[-1][0], a), max(mine[-1][1], z)]
                else:
                    mine.append([a, z])
        found = set()
        for k, spans in windows.items():
            for a, z in spans:
                for m in self.fuzzy[k].finditer(text, a, z):
                    found.add((m.start(), m.end(), k, sum(m.fuzzy_counts)))
        return sorted(found)

    def scan(self, raw: str | None) -> dict:
        words = _WORDS.findall((raw or "").encode("utf-8", "surrogatepass").lower())
        text = b" ".join(words).decode("utf-8", "surrogatepass")
        padded = f" {text} "
        spaces: list[int] = []

        def word_at(place: int) -> int:
            if not spaces:
                spaces.extend(m.start() for m in re.finditer(" ", padded))
            return bisect_right(spaces, place) - 1

        spans = []  # (first word, last word, label, edits, base)
        for phrase, label in self.base.items():
            at = padded.find(f" {phrase} ")
            while at >= 0:
                first = word_at(at)
                spans.append((first, first + phrase.count(" "), label, 0, True))
                at = padded.find(f" {phrase} ", at + 1)
        best = 1.0 if spans else 0.0
        for a, z, k, edits in self.fuzzy_spans(text):
            notice, label, _ = self.notices[k]
            # Places in ``padded`` are one further; a match may begin or end with a space.
            spans.append((word_at(a + 1), word_at(z), label, edits, False))
            best = max(best, 1.0 - edits / len(notice))
        own = [s for s in spans if s[4]]
        return {"n_words": len(words), "n_base": len(own),
                "first_word": min((s[0] for s in own), default=None),
                "last_word": max((s[0] for s in own), default=None),
                "base_labels": ",".join(sorted({s[2] for s in own})),
                "labels": ",".join(sorted({s[2] for s in spans})), "score": best,
                "spans": [{"first": s[0], "last": s[1], "label": s[2], "edits": s[3], "base": s[4]}
                          for s in sorted(spans)]}


_SCANNER: list[Scanner] = []

SCANNED = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
           "base_labels string, labels string, score double, "
           "spans array<struct<first:bigint,last:bigint,label:string,edits:int,base:boolean>>")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, counts, labels, score and spans (word indexes, last inclusive)."""

    @F.pandas_udf(SCANNED)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if not _SCANNER:
            _SCANNER.append(Scanner())
        names = [c.split()[0] for c in SCANNED.split(", ")[:7]] + ["spans"]
        for texts in batches:
            out = pd.DataFrame([_SCANNER[0].scan(t) for t in texts], columns=names)
            for c in ("first_word", "last_word"):
                out[c] = out[c].astype("Int64")
            yield out

    return docs.select("doc_id", scan(F.col("text").cast("string")).alias("x")).select("doc_id", "x.*")
