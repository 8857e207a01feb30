"""Typed conversion of argument values (M1-M7) as Column expressions.

Output of every converter is a struct
``(v_int BIGINT, v_float DOUBLE, v_bool BOOLEAN, v_str STRING, issue STRING, fatal BOOLEAN)``
where exactly one value field is set, according to the declared type.
``fatal`` marks values that make the whole call fall back (an infinite value
converted to int raises ``OverflowError`` in the behaviour being matched).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from callsmith.functions.text import strip_ws

VALUE_FIELDS = ("v_int", "v_float", "v_bool", "v_str")
KNOWN_TYPES = ("int", "float", "bool", "str")

# Python float() syntax: optional sign, digits with single underscores, optional
# fraction and exponent, or inf/infinity/nan.  Java's parser also takes hex and
# 'd'/'f' suffixes, which Python rejects, so the text is checked first.
_DIGITS = r"\d(?:_?\d)*"
_PY_FLOAT = (rf"(?i)^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})"
             rf"(?:e[+-]?{_DIGITS})?|inf|infinity|nan)$")


# Characters where Java's double syntax and Python's differ (hex, d/f suffixes,
# digit separators).  Text without them that Spark parses, Python parses too.
_SUSPECT = "xXpPdDfF_"


def py_float(text: Column) -> Column:
    """``float(text)`` or NULL where Python raises ``ValueError``.

    Fast path: a plain cast when the text has none of the suspect characters;
    otherwise (or when the cast fails) the full Python-syntax check.
    """
    fast = F.when(F.length(F.translate(text, _SUSPECT, "")) == F.length(text), text.try_cast("double"))
    t = strip_ws(text)
    slow = F.when(F.regexp_like(t, F.lit(_PY_FLOAT)), F.regexp_replace(t, "_", "").try_cast("double"))
    return F.coalesce(fast, slow)


def default_for_type(arg_type: Column) -> Column:
    """M4: 0, 0.0, False, '' by type; unknown types get ''."""
    return _struct(
        F.when(arg_type == "int", F.lit(0).cast("bigint")),
        F.when(arg_type == "float", F.lit(0.0).cast("double")),
        F.when(arg_type == "bool", F.lit(False)),
        F.when(~arg_type.isin("int", "float", "bool"), F.lit("")),
        F.when(~arg_type.isin(*KNOWN_TYPES), F.lit("unknown_type")),
        F.lit(False),
    )


def _struct(v_int, v_float, v_bool, v_str, issue, fatal) -> Column:
    return F.struct(v_int.cast("bigint").alias("v_int"),
                    v_float.cast("double").alias("v_float"),
                    v_bool.cast("boolean").alias("v_bool"),
                    v_str.cast("string").alias("v_str"),
                    issue.cast("string").alias("issue"),
                    fatal.cast("boolean").alias("fatal"))


def _int_from_double(d: Column):
    """int(d) truncating; (value, issue, fatal)."""
    inf = F.isnotnull(d) & (F.abs(d) == F.lit(float("inf")))
    # The cast takes 2^63 itself, one beyond BIGINT, for the largest BIGINT.
    as_long = F.when(d < F.lit(2.0 ** 63), d.try_cast("bigint")).when(
        F.isnan(d), F.lit(0).cast("bigint"))
    value = F.when(inf, F.lit(None)).otherwise(F.coalesce(as_long, F.lit(0)))
    issue = (F.when(d.isNull(), F.lit("bad_int"))
             .when(inf, F.lit("int_overflow_fatal"))
             .when(F.isnan(d), F.lit("bad_int"))
             .when(as_long.isNull(), F.lit("int_overflow")))
    return value, issue, F.coalesce(inf, F.lit(False))


def convert_text(value: Column, arg_type: Column) -> Column:
    """Convert an extracted candidate string to its declared type.

    int: ``int(float(v)) if v else 0``; float: ``float(v) if v else 0.0``;
    bool: ``v.lower() == 'true'``; str: ``v``; other types: ``''`` with an issue.
    Failed conversions give the default and an issue.
    """
    v = F.coalesce(value, F.lit(""))
    empty = v == ""
    d = py_float(v)
    i_val, i_issue, i_fatal = _int_from_double(d)
    return (F.when(arg_type == "int",
                   F.when(empty, _struct(F.lit(0), F.lit(None), F.lit(None), F.lit(None),
                                         F.lit(None), F.lit(False)))
                   .otherwise(_struct(i_val, F.lit(None), F.lit(None), F.lit(None),
                                      i_issue, i_fatal)))
            .when(arg_type == "float",
                  F.when(empty, _struct(F.lit(None), F.lit(0.0), F.lit(None), F.lit(None),
                                        F.lit(None), F.lit(False)))
                  .otherwise(_struct(F.lit(None), F.coalesce(d, F.lit(0.0)), F.lit(None),
                                     F.lit(None), F.when(d.isNull(), F.lit("bad_float")),
                                     F.lit(False))))
            .when(arg_type == "bool",
                  _struct(F.lit(None), F.lit(None), F.lower(v) == "true", F.lit(None),
                          F.lit(None), F.lit(False)))
            .when(arg_type == "str",
                  _struct(F.lit(None), F.lit(None), F.lit(None), v, F.lit(None), F.lit(False)))
            .otherwise(default_for_type(arg_type)))


def convert_known(value: Column, number: Column, kinds: dict[str, Column | None]) -> Column:
    """``convert_text`` where the type is known by conditions, not by a column: ``kinds`` has one for each of
    ``KNOWN_TYPES`` and for ``other``, the types without a conversion (None: never).  ``number`` is the value's ``py_float``.
    One field, one expression, so the generated code stays small."""
    def fields(branches):
        out = None
        for kind, result in branches:
            if kinds[kind] is not None:
                out = F.when(kinds[kind], result) if out is None else out.when(kinds[kind], result)
        return out

    def or_null(column):
        return F.lit(None) if column is None else column

    i_val, i_issue, i_fatal = _int_from_double(number)
    text = or_null(fields([("str", value)]))
    issue = or_null(fields([("int", F.when(value != "", i_issue)),
                            ("float", F.when((value != "") & number.isNull(), F.lit("bad_float")))]))
    if kinds["other"] is not None:
        text = F.when(kinds["other"], F.lit("")).otherwise(text)
        issue = F.when(kinds["other"], F.lit("unknown_type")).otherwise(issue)
    return _struct(or_null(fields([("int", i_val)])), or_null(fields([("float", F.coalesce(number, F.lit(0.0)))])),
                   or_null(fields([("bool", F.lower(value) == "true")])), text, issue,
                   F.coalesce(or_null(fields([("int", i_fatal)])).cast("boolean"), F.lit(False)))


_NUMERIC_KINDS = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")


def read_variant(v: Column) -> Column:
    """struct(v, kind, s): a raw JSON value with its kind and, for a string, its text."""
    kind = F.schema_of_variant(v)
    return F.struct(v.alias("v"), kind.alias("kind"),
                    F.when(kind == "STRING", F.try_variant_get(v, "$", "string")).alias("s"))


def read_number(r: Column) -> Column:
    """struct(r, d) of a ``read_variant``: the value as a double where it has one."""
    kind = r["kind"]
    is_num = kind.isin(*_NUMERIC_KINDS) | kind.startswith("DECIMAL")
    d = (F.when(is_num, F.try_variant_get(r["v"], "$", "double"))
         .when(kind == "BOOLEAN", F.try_variant_get(r["v"], "$", "boolean").cast("double"))
         .when(kind == "STRING", py_float(r["s"])))
    return F.struct(r.alias("r"), d.alias("d"))


def convert_variant(v: Column, arg_type: Column) -> Column:
    """Convert one raw JSON value (VARIANT)."""
    return convert_read(read_number(read_variant(v)), arg_type)


def convert_read(n: Column, arg_type: Column) -> Column:
    """Convert a raw JSON value, staged by ``read_variant`` and ``read_number`` so that each part
    is read once, as the call decoder does (M6).

    NULL/missing → default.  int: ``int(float(v))``; float: ``float(v)``;
    bool: bool kept, strings in (true, 1, yes), other values by truthiness;
    str: the string, or the value's text.  Objects and arrays cannot be
    numbers → default with an issue.
    """
    v, kind, s, d = n["r"]["v"], n["r"]["kind"], n["r"]["s"], n["d"]
    is_num = kind.isin(*_NUMERIC_KINDS) | kind.startswith("DECIMAL")
    is_str = kind == "STRING"
    is_bool = kind == "BOOLEAN"
    is_nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    missing = v.isNull() | (kind == "VOID")
    i_val, i_issue, i_fatal = _int_from_double(d)
    nested_size = F.coalesce(F.size(F.try_variant_get(v, "$", "array<variant>")),
                             F.size(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))))
    as_bool = (F.when(is_bool, F.try_variant_get(v, "$", "boolean"))
               .when(is_str, F.lower(s).isin("true", "1", "yes"))
               .when(is_num, F.coalesce(d != 0, F.lit(True)))
               .when(is_nested, nested_size > 0))
    as_str = (F.when(is_str, s)
              .when(is_bool, F.when(F.try_variant_get(v, "$", "boolean"), "True").otherwise("False"))
              # A JSON number with a fraction part is a float: 5.0 is "5.0", not "5"; beyond
              # BIGINT a whole number is kept in the same way as one with a fraction part.
              .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"),
                    F.when(F.to_json(v).rlike("[.eE]") | (F.abs(d) >= F.lit(2.0 ** 63)), F.to_json(v))
                    .otherwise(F.concat(F.to_json(v), F.lit(".0"))))
              .otherwise(F.to_json(v)))
    converted = (F.when(arg_type == "int",
                        _struct(i_val, F.lit(None), F.lit(None), F.lit(None), i_issue, i_fatal))
                 .when(arg_type == "float",
                       _struct(F.lit(None), F.coalesce(d, F.lit(0.0)), F.lit(None), F.lit(None),
                               F.when(d.isNull(), F.lit("bad_float")), F.lit(False)))
                 .when(arg_type == "bool",
                       _struct(F.lit(None), F.lit(None), as_bool, F.lit(None), F.lit(None),
                               F.lit(False)))
                 .when(arg_type == "str",
                       _struct(F.lit(None), F.lit(None), F.lit(None), as_str, F.lit(None),
                               F.lit(False)))
                 .otherwise(default_for_type(arg_type)))
    missing_default = default_for_type(arg_type)
    return F.when(missing, F.struct(
        *[missing_default[f].alias(f) for f in VALUE_FIELDS],
        F.coalesce(missing_default["issue"], F.lit("missing_arg")).alias("issue"),
        F.lit(False).alias("fatal"))).otherwise(converted)
