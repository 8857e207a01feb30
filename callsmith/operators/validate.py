"""Request validation.

A request must hold a string of at least one character that is not only
whitespace; valid requests are stripped like Python's ``str.strip()``.  Bad
rows are kept, with the reason, in a rejects table rather than dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsmith.functions.text import is_blank, strip_ws


def request_issue(text: Column, is_string: Column | None = None) -> Column:
    """First failed rule, NULL when the request is valid."""
    is_string = F.lit(True) if is_string is None else is_string
    return (F.when(text.isNull(), F.lit("missing_prompt"))
            .when(~is_string, F.lit("not_string"))
            .when(F.length(text) < 1, F.lit("empty_prompt"))
            .when(is_blank(text), F.lit("blank_prompt")))


def validate_requests(df: DataFrame, text_col: str = "prompt",
                      is_string_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Split requests into (valid with stripped text, rejects with ``issue``)."""
    is_str = F.col(is_string_col) if is_string_col else None
    checked = df.withColumn("issue", request_issue(F.col(text_col), is_str))
    valid = (checked.filter(F.col("issue").isNull()).drop("issue")
             .withColumn(text_col, strip_ws(F.col(text_col))))
    rejects = checked.filter(F.col("issue").isNotNull())
    return valid, rejects


def validation_report(checked: DataFrame, issue_col: str = "issue") -> DataFrame:
    """One row per outcome with its count (``valid`` for rows without an issue)."""
    return (checked.groupBy(F.coalesce(F.col(issue_col), F.lit("valid")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n_rows")))
