"""Catalogue operators: validation (P4-P9), de-duplication (A1), argument specs
(W3, J6), the fallback definition (W1, K6), fingerprints (T7) and the size
check that every broadcast of the catalogue goes through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsmith import fixed

CATALOG_SCHEMA = T.StructType([
    T.StructField("ord", T.LongType(), False),
    T.StructField("fn_name", T.StringType(), True),
    T.StructField("args_names", T.ArrayType(T.StringType()), True),
    T.StructField("args_types", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("return_type", T.StringType(), True),
])

# Largest catalogue that is shipped whole to every task.  Beyond it selection
# switches to an equi-join on keywords.
MAX_BROADCAST_CATALOG = 10_000


class CatalogError(ValueError):
    """Raised when the catalogue gate fails (the whole run stops)."""


def catalog_from_rows(spark: SparkSession, rows=None) -> DataFrame:
    """Catalogue DataFrame from ``(fn_name, [(arg, type), ...], return_type)`` tuples."""
    rows = fixed.REFERENCE_CATALOG if rows is None else rows
    data = [(i, name, [a for a, _ in args], {a: t for a, t in args}, ret)
            for i, (name, args, ret) in enumerate(rows)]
    return spark.createDataFrame(data, CATALOG_SCHEMA)


def bounded_count(df: DataFrame, limit: int) -> int:
    """Row count, reading at most ``limit + 1`` rows."""
    return df.limit(limit + 1).count()


def catalog_issue() -> Column:
    """First failed rule of a definition, NULL when valid."""
    missing_types = F.filter(F.coalesce(F.col("args_names"), F.array().cast("array<string>")),
                             lambda a: ~F.coalesce(F.map_contains_key(
                                 F.coalesce(F.col("args_types"),
                                            F.create_map().cast("map<string,string>")), a),
                                 F.lit(False)))
    return (F.when(F.col("fn_name").isNull(), F.lit("missing_fn_name"))
            .when(F.length("fn_name") < 1, F.lit("empty_fn_name"))
            .when(~F.col("fn_name").startswith(fixed.FN_PREFIX), F.lit("bad_fn_prefix"))
            .when(F.col("return_type").isNull(), F.lit("missing_return_type"))
            .when(F.length("return_type") < 1, F.lit("empty_return_type"))
            .when(F.size(missing_types) > 0,
                  F.concat(F.lit("missing_arg_type:"), F.array_join(missing_types, ","))))


def validate_catalog(catalog: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """Split a catalogue into (valid, rejects).

    ``strict`` (the reference behaviour) aborts on any bad definition or an
    empty catalogue; the check reads one row of the small rejects table.
    Missing list/map fields default to empty.
    """
    # A loader's own finding (a field of the wrong type) comes before the rules on values.
    loaded = F.col("type_issue") if "type_issue" in catalog.columns else F.lit(None).cast("string")
    checked = (catalog
               .withColumn("args_names", F.coalesce("args_names", F.array().cast("array<string>")))
               .withColumn("args_types", F.coalesce("args_types",
                                                    F.create_map().cast("map<string,string>")))
               .withColumn("issue", F.coalesce(loaded, catalog_issue())))
    valid = checked.filter(F.col("issue").isNull()).drop("issue", "type_issue")
    rejects = checked.filter(F.col("issue").isNotNull()).select("ord", "fn_name", "issue")
    if strict:
        bad = rejects.limit(1).collect()
        if bad:
            raise CatalogError(f"invalid function definition at {bad[0]['ord']}: {bad[0]['issue']}")
        if valid.limit(1).count() == 0:
            raise CatalogError("function catalogue is empty")
    return valid, rejects


def dedupe_catalog(catalog: DataFrame) -> DataFrame:
    """A1: one row per ``fn_name``; the last definition wins, at the first one's position."""
    cols = [c for c in catalog.columns if c not in ("fn_name", "ord")]
    return (catalog.groupBy("fn_name")
            .agg(F.min("ord").alias("ord"),
                 F.max_by(F.struct(*cols), F.col("ord")).alias("d"))
            .select("ord", "fn_name", *[F.col(f"d.{c}").alias(c) for c in cols]))


def arg_specs_column() -> Column:
    """array<struct(arg_ord, arg_name, arg_type)> in declared order."""
    return F.transform(F.col("args_names"),
                       lambda a, i: F.struct(i.alias("arg_ord"), a.alias("arg_name"),
                                             F.element_at(F.col("args_types"), a).alias("arg_type")))


ARG_SPEC_TYPE = "array<struct<arg_ord:int,arg_name:string,arg_type:string>>"


def collect_entries(catalog: DataFrame, limit: int = MAX_BROADCAST_CATALOG) -> list | None:
    """The catalogue as driver-side rows in ``ord`` order, or None if it exceeds ``limit``.

    Only a size-checked catalogue is ever collected; the requests never are.
    A repeated name is one entry: the last definition at the first one's position (A1).
    The rows are read once per catalogue DataFrame and kept on that object.
    """
    held = getattr(catalog, "_entries", None)
    if held is not None and held[0] == limit:
        return held[1]
    rows = catalog.select("ord", "fn_name", "args_names", "args_types").limit(limit + 1).collect()
    entries = None
    if len(rows) <= limit:
        by_name: dict[str, dict] = {}
        for r in sorted(rows, key=lambda r: r["ord"]):
            first = by_name.get(r["fn_name"], r)
            by_name[r["fn_name"]] = {**r.asDict(), "ord": first["ord"]}
        entries = list(by_name.values())
    catalog._entries = (limit, entries)
    return entries


def args_literal(args_names, args_types) -> Column:
    specs = [F.struct(F.lit(i).alias("arg_ord"), F.lit(a).alias("arg_name"),
                      F.lit((args_types or {}).get(a)).cast("string").alias("arg_type"))
             for i, a in enumerate(args_names or [])]
    return F.array(*specs).cast(ARG_SPEC_TYPE)


def entry_literal(row, kws=None) -> Column:
    """One catalogue entry as a constant struct (ord, fn_name, kws, args)."""
    return F.struct(F.lit(row["ord"]).cast("bigint").alias("ord"), F.lit(row["fn_name"]).alias("fn_name"),
                    F.array(*[F.lit(k) for k in sorted(kws or [])]).cast("array<string>").alias("kws"),
                    args_literal(row["args_names"], row["args_types"]).alias("args"))


def first_definition(catalog: DataFrame):
    """The lowest-``ord`` definition (one row read on the driver)."""
    entries = collect_entries(catalog)
    row = entries[0] if entries else \
        fallback_definition(catalog).select("ord", "fn_name", "args_names", "args_types").first()
    if row is None:
        raise CatalogError("function catalogue is empty")
    return row


def explode_arg_specs(catalog: DataFrame) -> DataFrame:
    """Long table ``(ord, fn_name, arg_ord, arg_name, arg_type)``."""
    return (catalog.select("ord", "fn_name", F.posexplode("args_names").alias("arg_ord", "arg_name"),
                           "args_types")
            .select("ord", "fn_name", "arg_ord", "arg_name",
                    F.element_at("args_types", F.col("arg_name")).alias("arg_type")))


def fallback_definition(catalog: DataFrame) -> DataFrame:
    """The first definition (lowest ``ord``) as a one-row DataFrame."""
    cols = [c for c in catalog.columns if c != "ord"]
    return (catalog.agg(F.min("ord").alias("ord"),
                        F.min_by(F.struct(*cols), F.col("ord")).alias("d"))
            .select("ord", *[F.col(f"d.{c}").alias(c) for c in cols]))


def definition_fingerprint() -> Column:
    """sha2 of the definition with argument types in canonical key order."""
    canon = F.to_json(F.struct(F.col("fn_name"), F.col("args_names"),
                               F.array_sort(F.map_entries(F.col("args_types"))).alias("args_types"),
                               F.col("return_type")))
    return F.sha2(canon, 256)
