"""Column builders for text: regex flags, whitespace, candidate extraction.

Every builder takes and returns ``Column``s, so it runs inside Catalyst
(whole-stage codegen where Spark supports it) with no Python per row.

Regex dialect: the patterns in ``callsmith.fixed`` are Python ``re``
patterns.  Java needs ``(?U)`` for Unicode ``\\w``/``\\s``/``\\b`` and
``(?d)`` so that ``.`` stops only at ``\\n`` as Python's does.  Number
extraction runs without ``U``: its digits are ASCII (Spark's double cast
rejects other digits anyway).
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from callsmith import fixed


def rx(pattern: str, ignore_case: bool = False, unicode: bool = True) -> str:
    """Java regex text with Python-compatible flags."""
    flags = ("i" if ignore_case else "") + ("U" if unicode else "") + "d"
    return f"(?{flags}){pattern}"


def first_match(text: Column, pattern: str, group: int, ignore_case: bool = False,
                unicode: bool = True) -> Column:
    """Group of the leftmost match, NULL when nothing matches.

    ``regexp_extract`` gives '' both for "no match" and "matched empty";
    ``regexp_like`` tells them apart.
    """
    p = rx(pattern, ignore_case, unicode)
    return F.when(F.regexp_like(text, F.lit(p)), F.regexp_extract(text, p, group))


def all_matches(text: Column, pattern: str, group: int, ignore_case: bool = False,
                unicode: bool = True) -> Column:
    return F.regexp_extract_all(text, F.lit(rx(pattern, ignore_case, unicode)), F.lit(group))


def as_array(value: Column) -> Column:
    """0- or 1-element array<string> from a nullable string."""
    return F.when(value.isNull(), F.array().cast("array<string>")).otherwise(F.array(value))


# --- P2: strip like Python's str.strip() ------------------------------------
# Every code point whose str.isspace() is true (the highest is U+3000).
PY_WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip_ws(text: Column) -> Column:
    """Remove leading and trailing Python whitespace.

    Spark's one-argument ``trim`` removes only U+0020; with an explicit
    character set it strips like ``str.strip()``, without a regex.
    """
    return F.trim(text, F.lit(PY_WHITESPACE))


def is_blank(text: Column) -> Column:
    return strip_ws(text) == ""


# --- F1: signed decimal literals ---------------------------------------------
def ascii_digits(text: Column) -> Column:
    """Every decimal digit of any script as the ASCII digit of its value."""
    found = [(chr(c), unicodedata.decimal(chr(c))) for c in range(128, sys.maxunicode + 1)
             if unicodedata.category(chr(c)) == "Nd"]
    return F.translate(text, "".join(c for c, _ in found), "".join(str(d) for _, d in found))


def extract_numbers(text: Column, unicode_digits: bool = False) -> Column:
    """All matches of ``-?\\d+\\.?\\d*`` in order (ASCII digits).

    With ``unicode_digits`` the digits of other scripts count too and are given as ASCII digits."""
    if unicode_digits:
        text = ascii_digits(text)
    return all_matches(text, fixed.NUMBER_PATTERN, 0, unicode=False)


# --- F3/F4: source text of a substitution ------------------------------------
def extract_sub_source(text: Column) -> Column:
    return F.coalesce(first_match(text, fixed.SUB_SOURCE_IN_WITH, 2, ignore_case=True),
                      first_match(text, fixed.SUB_SOURCE_WITH_IN, 2, ignore_case=True))


def _contains_any(lowered: Column, words: Iterable[str]) -> Column:
    cond = None
    for w in words:
        c = lowered.contains(w)
        cond = c if cond is None else (cond | c)
    return cond


# --- F5/F6/P17: phrase -> regex literal --------------------------------------
def classify_pattern_phrase(text: Column) -> Column:
    """First phrase class that occurs (case-insensitive substring) → regex; NULL if none."""
    low = F.lower(text)
    out = None
    for words, regex in fixed.PATTERN_PHRASES:
        cond = _contains_any(low, words)
        out = F.when(cond, F.lit(regex)) if out is None else out.when(cond, F.lit(regex))
    word = first_match(text, fixed.WORD_IN_QUOTES, 1, ignore_case=True)
    return out.when(low.contains(fixed.WORD_PHRASE),
                    F.concat(F.lit(r"\b"), word, F.lit(r"\b")))


# --- F7: replacement text ------------------------------------------------------
def classify_replacement_phrase(text: Column) -> Column:
    low = F.lower(text)
    quoted = first_match(text, fixed.REPLACEMENT_IN_QUOTES, 1, ignore_case=True)
    out = F.when(quoted.isNotNull(), quoted)
    for words, repl in fixed.REPLACEMENT_PHRASES:
        out = out.when(_contains_any(low, words), F.lit(repl))
    return out


# --- F8/F9/F10: quoted pair ---------------------------------------------------
def extract_quoted_pair(text: Column, which: int) -> Column:
    """``which`` = 1 or 2.  Verb form, else any pair, else the n-th quoted string."""
    return F.coalesce(first_match(text, fixed.PAIR_AFTER_VERB, which, ignore_case=True),
                      first_match(text, fixed.PAIR_ANYWHERE, which, ignore_case=True),
                      F.get(all_matches(text, fixed.ANY_QUOTED, 1), which - 1))


# --- F11/F12/A7: quoted strings and the longest one ---------------------------
def extract_quoted(text: Column) -> Column:
    """Single-quoted then double-quoted strings, each in order; may be empty strings."""
    return F.concat(all_matches(text, fixed.SINGLE_QUOTED, 1),
                    all_matches(text, fixed.DOUBLE_QUOTED, 1))


def longest_of(arr: Column) -> Column:
    """Longest element, the first one on ties; '' for an empty array."""
    return F.aggregate(arr, F.lit(""),
                       lambda acc, x: F.when(F.length(x) > F.length(acc), x).otherwise(acc))


def extract_longest_quoted(text: Column) -> Column:
    return F.nullif(longest_of(extract_quoted(text)), F.lit(""))


# --- F13: name after a verb -----------------------------------------------------
def extract_after_keyword(text: Column) -> Column:
    return first_match(text, fixed.NAME_AFTER_GREET, 1, ignore_case=True)


# --- F14: generic quoted strings -----------------------------------------------
def extract_any_quoted(text: Column) -> Column:
    return all_matches(text, fixed.ANY_QUOTED, 1)


# --- J8/U3: drop every copy of an already used value ---------------------------
def exclude_used(values: Column, used: Column) -> Column:
    """Keep order and duplicates of the rest (``array_except`` would de-duplicate)."""
    return F.filter(values, lambda x: ~F.array_contains(used, x))


def kth_distinct(values: Column, k: int) -> Column:
    """k-th (0-based) distinct value in first-occurrence order, NULL if none.

    Closed form of the used-value recurrence when every argument is numeric:
    the k-th argument takes the first number that equals none of the k
    earlier picks.
    """
    return F.get(F.array_distinct(values), k)
