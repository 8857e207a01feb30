"""Raw call → validated call.

A raw call is ``(fn_name STRING, args VARIANT)`` — for example produced by a
model, or read from a log.  The decoder resolves the name against the
catalogue (unknown or missing → the first function, flagged), reads every
declared argument (missing → typed default, extra keys ignored), converts it,
and replaces a call that cannot be built with the fallback call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsmith.functions.convert import (VALUE_FIELDS, convert_read, default_for_type,
                                         read_number, read_variant)

PICK_TYPE = ("struct<arg_ord:int,arg_name:string,arg_type:string,raw:string,n_cands:int,"
             "c:struct<v_int:bigint,v_float:double,v_bool:boolean,v_str:string,issue:string,"
             "fatal:boolean>>")
from callsmith.operators.catalog import (MAX_BROADCAST_CATALOG, arg_specs_column,
                                         bounded_count, collect_entries, dedupe_catalog,
                                         entry_literal, first_definition)


def maybe_broadcast(df: DataFrame, limit: int = MAX_BROADCAST_CATALOG) -> DataFrame:
    """Broadcast hint only behind a bounded row count."""
    return F.broadcast(df) if bounded_count(df, limit) <= limit else df


def _catalog_side(catalog: DataFrame, side: DataFrame) -> DataFrame:
    """A projection of the catalogue, broadcast when the catalogue passed the size
    check (``collect_entries``, read once per catalogue, so no extra job)."""
    return F.broadcast(side) if collect_entries(catalog) is not None else side


def fallback_picks(definition) -> Column:
    """K6: every declared argument of a definition with its typed default, as a constant."""
    def pick(i, name):
        arg_type = F.lit((definition["args_types"] or {}).get(name)).cast("string")
        return F.struct(F.lit(i).alias("arg_ord"), F.lit(name).alias("arg_name"), arg_type.alias("arg_type"),
                        F.lit(None).cast("string").alias("raw"), F.lit(0).alias("n_cands"),
                        default_for_type(arg_type).alias("c"))

    return F.array(*[pick(i, a) for i, a in enumerate(definition["args_names"] or [])]).cast(f"array<{PICK_TYPE}>")


def with_first_function(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Attach the fallback call (W1, K6) as a constant column ``_first``: one row read on the driver."""
    first = first_definition(catalog)
    entry = entry_literal(first)
    return df.withColumn("_first", F.struct(entry["ord"].alias("ord"), entry["fn_name"].alias("fn_name"),
                                            entry["args"].alias("args"), fallback_picks(first).alias("picks")))


def apply_fallback(df: DataFrame, fatal_col: str = "call_fatal") -> DataFrame:
    """Replace calls flagged fatal by the first function with default arguments.

    Needs ``_first`` (see ``with_first_function``); drops it afterwards.
    """
    fatal = F.coalesce(F.col(fatal_col), F.lit(False))
    return (df.withColumn("fn_name", F.when(fatal, F.col("_first.fn_name")).otherwise(F.col("fn_name")))
            .withColumn("fn_ord", F.when(fatal, F.col("_first.ord")).otherwise(F.col("fn_ord")))
            .withColumn("picks", F.when(fatal, F.col("_first.picks")).otherwise(F.col("picks")))
            .withColumn("is_fallback", fatal | F.coalesce(F.col("is_fallback"), F.lit(False)))
            .drop("_first"))


def resolve_function(raw_calls: DataFrame, catalog: DataFrame, name_col: str = "raw_fn") -> DataFrame:
    """Add ``fn_ord, fn_name, fn_args, fn_unknown``; unknown/missing names → first function."""
    # One row per name (A1), so a repeated definition never multiplies calls.
    cat = _catalog_side(catalog, dedupe_catalog(catalog).select(
        F.col("fn_name").alias("_name"), F.col("ord").alias("_ord"), arg_specs_column().alias("_args")))
    joined = with_first_function(raw_calls.join(cat, F.col(name_col) == F.col("_name"), "left"),
                                 catalog)
    unknown = F.col("_name").isNull()
    return (joined
            .withColumn("fn_unknown", unknown)
            .withColumn("fn_ord", F.when(unknown, F.col("_first.ord")).otherwise(F.col("_ord")))
            .withColumn("fn_name", F.when(unknown, F.col("_first.fn_name")).otherwise(F.col("_name")))
            .withColumn("fn_args", F.when(unknown, F.col("_first.args")).otherwise(F.col("_args")))
            .drop("_name", "_ord", "_args", "_first"))


def unknown_calls(raw_calls: DataFrame, catalog: DataFrame, name_col: str = "raw_fn") -> DataFrame:
    """Calls whose name is not in the catalogue (anti-join)."""
    cat = _catalog_side(catalog, catalog.select(F.col("fn_name").alias("_name")))
    return raw_calls.join(cat, F.col(name_col) == F.col("_name"), "left_anti")


def known_calls(raw_calls: DataFrame, catalog: DataFrame, name_col: str = "raw_fn") -> DataFrame:
    """Calls whose name is in the catalogue (semi-join)."""
    cat = _catalog_side(catalog, catalog.select(F.col("fn_name").alias("_name")))
    return raw_calls.join(cat, F.col(name_col) == F.col("_name"), "left_semi")


def decode_calls(raw_calls: DataFrame, catalog: DataFrame, name_col: str = "raw_fn",
                 args_col: str = "raw_args", text_col: str | None = None) -> DataFrame:
    """K5: validated calls with ``picks`` (typed values) and ``is_fallback``.

    ``args_col`` is a VARIANT holding an object (or NULL = no arguments).  A
    non-object payload cannot be read and turns the call into the fallback (a
    JSON null only where the function declares arguments to look up),
    as does a blank request text when ``text_col`` is given (P12, P13), which comes back stripped.
    """
    resolved = resolve_function(raw_calls, catalog, name_col)
    kind = F.schema_of_variant(F.col(args_col))
    bad_payload = (F.col(args_col).isNotNull() & ~kind.startswith("OBJECT")
                   & ((kind != "VOID") | (F.size("fn_args") > 0)))
    if text_col is not None:
        from callsmith.functions.text import is_blank, strip_ws
        bad_payload = bad_payload | F.coalesce(is_blank(F.col(text_col)), F.lit(True))
        resolved = resolved.withColumn(text_col, strip_ws(F.col(text_col)))
    staged = with_first_function(resolved.withColumn("_bad", bad_payload), catalog)
    # The parsed payload rides in the fold's accumulator so it is parsed once
    # per call; each value is then read once (kind and text, then number).
    read = F.struct(F.lit(None).cast("variant").alias("v"), F.lit("").alias("kind"),
                    F.lit(None).cast("string").alias("s"))
    init = F.struct(F.try_variant_get(F.col(args_col), "$", "map<string,variant>").alias("m"),
                    F.slice(F.array(read), 1, 0).alias("vals"))

    def step(acc, a):
        value = read_variant(F.try_element_at(acc["m"], a["arg_name"]))
        return F.struct(acc["m"].alias("m"), F.concat(acc["vals"], F.array(value)).alias("vals"))

    values = F.transform(F.aggregate(F.col("fn_args"), init, step)["vals"], read_number)
    picks = F.zip_with("fn_args", values, lambda a, n: F.struct(
        a["arg_ord"].cast("int").alias("arg_ord"), a["arg_name"].alias("arg_name"),
        a["arg_type"].alias("arg_type"), F.lit(None).cast("string").alias("raw"),
        F.lit(1).alias("n_cands"), convert_read(n, a["arg_type"]).alias("c")))
    out = (staged.withColumn("picks", picks)
           .withColumn("is_fallback", F.lit(False))
           .withColumn("call_fatal", F.col("_bad") |
                       F.exists(F.col("picks"), lambda p: p["c"]["fatal"])))
    return apply_fallback(out).drop("fn_args", "_bad")


def json_scalar(x: Column) -> Column:
    """JSON text of one scalar (string escaping, number and null forms as Spark writes them)."""
    s = F.to_json(F.array(x))
    return s.substr(F.lit(2), F.length(s) - 2)


def pack_arguments(picks: Column) -> Column:
    """The call's arguments as one JSON object text, in declared order."""
    def entry(p):
        c = p["c"]
        value = (F.when(p["arg_type"] == "int", json_scalar(c["v_int"]))
                 .when(p["arg_type"] == "float", json_scalar(c["v_float"]))
                 .when(p["arg_type"] == "bool", json_scalar(c["v_bool"]))
                 .otherwise(json_scalar(c["v_str"])))
        return F.concat(json_scalar(p["arg_name"]), F.lit(":"), value)

    return F.concat(F.lit("{"), F.array_join(F.transform(picks, entry), ","), F.lit("}"))


def long_columns() -> list[str]:
    return ["arg_ord", "arg_name", "arg_type", *VALUE_FIELDS, "issue"]
