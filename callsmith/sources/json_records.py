"""JSON-array files as record tables (S1-S9), with a rejects table instead of prints.

A file holds one JSON array; each element becomes a row ``(source, ord, v)``
with ``v`` a VARIANT.  Objects are kept, bare strings become
``{"prompt": s}``, anything else is a reject.  A file that is not JSON, or
not an array, becomes one reject row; other files still load.  A missing
path gives empty tables and one ``missing_path`` reject.

Each array file is read whole by one task; many files are read in parallel.  A large array
is read in parallel by ``form="split"`` (``json_split``).  Inputs may also come as JSON Lines (one
value a line, ``form="lines"``, split like any text) or as a DataFrame of a
parquet file or table, which ``load_catalog`` and ``load_requests`` also take.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callsmith.operators.catalog import CATALOG_SCHEMA, CatalogError
from callsmith.operators.validate import validate_requests

RECORDS_SCHEMA = "source string, ord bigint, v variant"
REJECTS_SCHEMA = "source string, ord bigint, issue string"


_END = "end of the text"


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row: the planner copies no expression through an explode, while a
    plain column's goes to wherever it is used, and a parse's copies outgrow what Java compiles."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def json_pair(text: Column) -> Column:
    """The text's JSON value and an end mark as an array of VARIANTs, for ``sole_json``."""
    return F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]'))), "$", "array<variant>")


def sole_json(pair: Column) -> Column:
    """The one JSON value of ``json_pair``'s text as a VARIANT, else null."""
    return F.when((F.size(pair) == 2) & (F.try_variant_get(F.get(pair, 1), "$", "string") == _END), F.get(pair, 0))


def strict_json(text: Column) -> Column:
    """The text's one JSON value as a VARIANT, else null.  ``try_parse_json`` alone takes a value that other
    text follows; as the first of two elements it must end where the mark after it begins."""
    return sole_json(json_pair(text))


def load_json_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(records(source, ord, v), rejects(source, ord, issue))``."""
    try:
        raw = spark.read.format("binaryFile").load(path).select(
            F.col("_metadata.file_path").alias("source"), F.col("content").cast("string").alias("bytes"))
        raw = raw.select("source", F.try_validate_utf8("bytes").alias("value"))
        raw.schema  # resolve the path now
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        empty = spark.createDataFrame([], RECORDS_SCHEMA)
        rej = spark.createDataFrame([(path, None, "missing_path")], REJECTS_SCHEMA)
        return empty, rej
    doc = strict_json(F.col("value"))
    arr = F.try_variant_get(doc, "$", "array<variant>")
    files = raw.select("source", arr.alias("arr"),
                       F.when(F.col("value").isNull(), F.lit("bad_utf8"))
                       .when(doc.isNull(), F.lit("bad_json"))
                       .when(arr.isNull(), F.lit("not_array")).alias("issue"))
    elements = (files.filter(F.col("issue").isNull())
                .select("source", F.posexplode_outer("arr").alias("ord", "v"))
                .filter(F.col("ord").isNotNull()))
    records, skipped = _as_records(elements)
    return records, skipped.unionByName(
        files.filter(F.col("issue").isNotNull())
        .select("source", F.lit(None).cast("bigint").alias("ord"), "issue"))


def load_json_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``load_json_records`` for one JSON value a line.  ``ord`` is unique and grows in file
    order within a split; blank lines are skipped; a line that is not JSON is one reject."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source"), F.monotonically_increasing_id().alias("ord"),
        F.try_validate_utf8("value").alias("value")).filter("value is null or trim(value) <> ''")
    parsed = lines.select("source", "ord", strict_json(F.col("value")).alias("v"),
                          F.when(F.col("value").isNull(), F.lit("bad_utf8")).otherwise(F.lit("bad_json"))
                          .alias("issue"))
    records, skipped = _as_records(parsed.filter("v is not null"))
    return records, skipped.unionByName(parsed.filter("v is null").select("source", "ord", "issue"))


def _as_records(elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(source, ord, v)`` elements → records and rejects by shape."""
    kind = F.col("kind")
    as_record = (F.when(kind.startswith("OBJECT"), F.col("v"))
                 .when(kind == "STRING", F.to_variant_object(
                     F.struct(F.variant_get(F.col("v"), "$", "string").alias("prompt")))))
    typed = once(once(elements.select("source", F.col("ord").cast("bigint").alias("ord"), "v"),
                      "kind", F.schema_of_variant(F.col("v"))), "rec", as_record)
    records = typed.filter(F.col("rec").isNotNull()).select("source", "ord", F.col("rec").alias("v"))
    rejects = (typed.filter(F.col("rec").isNull())
               .select("source", "ord", F.concat(F.lit("skipped_"), F.lower(
                   F.regexp_extract("kind", r"^([A-Z]+)", 1))).alias("issue")))
    return records, rejects


def load_report(spark: SparkSession, path: str, form: str = "array") -> DataFrame:
    """Per file, records kept, elements skipped, whether it could not be read, and whether a
    non-empty file kept none.  One aggregate over both outputs of the loader."""
    records, rejects = _loader(form)(spark, path)
    seen = records.select("source", F.lit(1).alias("kept"), F.lit(0).alias("skipped"), F.lit(0).alias("unread")).unionByName(
        rejects.select("source", F.lit(0).alias("kept"), F.col("ord").isNotNull().cast("int").alias("skipped"),
                       F.col("ord").isNull().cast("int").alias("unread")))
    return (seen.groupBy("source").agg(F.sum("kept").alias("n_records"), F.sum("skipped").alias("n_skipped"),
                                       (F.max("unread") > 0).alias("unread"))
            .withColumn("no_valid_items", (F.col("n_records") == 0) & (F.col("n_skipped") > 0)))


def records_to_catalog(records: DataFrame, unique_ord: bool = False) -> DataFrame:
    """Definitions projected from the records (unknown fields ignored); ``unique_ord`` says that
    ``ord`` does not restart in each file."""
    v = F.col("v")

    def str_field(name):
        f = F.try_variant_get(v, f"$.{name}", "variant")
        return F.when(F.schema_of_variant(f) == "STRING", F.try_variant_get(v, f"$.{name}", "string"))

    if not unique_ord:  # files follow each other in path order
        files = records.select("source").distinct().select(
            F.col("source").alias("_source"),
            (F.row_number().over(Window.orderBy("source")) - 1).cast("bigint").alias("_file"))
        records = records.join(files, F.col("source") == F.col("_source")).withColumn(
            "ord", F.col("_file") * F.lit(1 << 32) + F.col("ord"))

    def kind(name):
        return F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant"))

    # Wrong types are findings, not missing fields; a present null is a wrong type.
    types = F.try_variant_get(v, "$.args_types", "map<string,variant>")
    wrong = (F.when(kind("fn_name").isNotNull() & (kind("fn_name") != "STRING"), F.lit("fn_name"))
             .when(kind("return_type").isNotNull() & (kind("return_type") != "STRING"), F.lit("return_type"))
             .when(kind("args_names").isNotNull()
                   & ~kind("args_names").isin("ARRAY<STRING>", "ARRAY<VOID>"), F.lit("args_names"))
             .when(kind("args_names").eqNullSafe("ARRAY<VOID>") & (F.size(F.try_variant_get(
                 v, "$.args_names", "array<variant>")) > 0), F.lit("args_names"))
             .when(kind("args_types").isNotNull() & ~kind("args_types").startswith("OBJECT"),
                   F.lit("args_types"))
             .when(F.exists(F.map_values(types), lambda t: F.schema_of_variant(t) != "STRING"),
                   F.lit("args_types")))
    return records.select(
        F.col("ord").cast("bigint").alias("ord"),
        str_field("fn_name").alias("fn_name"),
        F.try_variant_get(v, "$.args_names", "array<string>").alias("args_names"),
        F.try_variant_get(v, "$.args_types", "map<string,string>").alias("args_types"),
        str_field("return_type").alias("return_type"),
        F.concat(F.lit("wrong_type:"), wrong).alias("type_issue")).select(
        *CATALOG_SCHEMA.fieldNames(), "type_issue")


def table_to_catalog(definitions: DataFrame) -> DataFrame:
    """Definitions from a typed table (parquet, a catalogue table, ...); a column of
    another type than the catalogue's raises.  Without ``ord`` rows keep the order they are read in."""
    for f in CATALOG_SCHEMA.fields[1:]:
        if f.name in definitions.columns and (
                definitions.schema[f.name].dataType.simpleString() != f.dataType.simpleString()):
            raise CatalogError(f"column {f.name} is {definitions.schema[f.name].dataType.simpleString()}, "
                               f"not {f.dataType.simpleString()}")
    ord_ = F.col("ord").cast("bigint") if "ord" in definitions.columns else F.monotonically_increasing_id()
    return definitions.select(ord_.alias("ord"), *[
        (F.col(f.name) if f.name in definitions.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in CATALOG_SCHEMA.fields[1:]])


def _loader(form: str):
    """The loader of a form of files."""
    from callsmith.sources.json_split import load_json_splits
    loaders = {"array": load_json_records, "lines": load_json_lines, "split": load_json_splits}
    if form not in loaders:
        raise ValueError(f"unknown form {form!r}: one of {', '.join(loaders)}")
    return loaders[form]


def load_catalog(spark: SparkSession, source: str | DataFrame, strict: bool = True,
                 form: str = "array") -> DataFrame:
    """S8 + P4-P9: a validated catalogue (aborts when strict) from a path to JSON arrays (``form="split"``:
    large ones, read in parallel), to JSON Lines (``form="lines"``), or from a DataFrame."""
    from callsmith.operators.catalog import dedupe_catalog, validate_catalog
    if isinstance(source, DataFrame):
        definitions = table_to_catalog(source)
    else:
        records, rejects = _loader(form)(spark, source)
        unread = rejects if form == "lines" else rejects.filter(F.col("ord").isNull())
        if strict and unread.limit(1).count():
            raise ValueError(f"cannot read function definitions from {source}")
        definitions = records_to_catalog(records, unique_ord=form == "lines")
    valid, _ = validate_catalog(definitions, strict=strict)
    return dedupe_catalog(valid).select(*CATALOG_SCHEMA.fieldNames())


def load_requests(spark: SparkSession, source: str | DataFrame, form: str = "array",
                  text_col: str = "prompt") -> tuple[DataFrame, DataFrame]:
    """S9 + P1/P2/P16: ``(valid(source, req_id, prompt), rejects)``; ``req_id`` is 1-based.

    From a path to JSON arrays (``form="split"``: large ones, read in parallel), to JSON Lines
    (``form="lines"``, ``req_id`` unique only), or from a DataFrame, whose other columns stay and whose rejects keep them with their ``issue``."""
    if isinstance(source, DataFrame):
        return validate_requests(source.withColumnRenamed(text_col, "prompt"), "prompt")
    records, load_rejects = _loader(form)(spark, source)
    p = F.try_variant_get(F.col("v"), "$.prompt", "variant")
    reqs = once(records, "asked", F.struct(F.try_variant_get(F.col("v"), "$.prompt", "string").alias("prompt"),
                                           (F.schema_of_variant(p) == "STRING").alias("is_string")))
    text, is_string = F.col("asked.prompt"), F.col("asked.is_string")
    reqs = once(reqs, "prompt", F.when(is_string | text.isNull(), text).otherwise(F.lit(""))).select(
        "source", (F.col("ord") + 1).alias("req_id"), "prompt", is_string.alias("is_string"))
    valid, bad = validate_requests(reqs, "prompt", is_string_col="is_string")
    rejects = (bad.select("source", F.col("req_id").alias("ord"), "issue")
               .unionByName(load_rejects))
    return valid.drop("is_string"), rejects
