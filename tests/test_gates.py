"""Catalogue gate, repeated names, folders of definitions, odd payloads, session settings."""

import json

import pytest
from pyspark.sql import functions as F

from callsmith.operators.catalog import (CatalogError, catalog_from_rows, collect_entries,
                                         validate_catalog)
from callsmith.operators.decode import decode_calls
from callsmith.operators.select import select_function
from callsmith.operators.tokens import EmptyTokenTable, invert_token_table, load_token_table
from callsmith.session import ensure_parallelism, get_spark
from callsmith.sources.json_records import load_catalog

GOOD = {"fn_name": "fn_pay", "args_names": ["n"], "args_types": {"n": "int"}, "return_type": "int"}


@pytest.mark.parametrize("field, value", [
    ("args_names", "n"), ("args_names", None), ("args_names", [1]), ("args_types", {"n": 3}),
    ("args_types", None), ("fn_name", None), ("return_type", 5), ("args_names", [None])])
def test_gate_rejects_wrong_types(spark, tmp_path, field, value):
    path = tmp_path / "d.json"
    path.write_text(json.dumps([GOOD, {**GOOD, "fn_name": "fn_odd", field: value}]))
    with pytest.raises(CatalogError):
        load_catalog(spark, str(path))
    assert [r.fn_name for r in load_catalog(spark, str(path), strict=False).collect()] == ["fn_pay"]


def test_gate_takes_missing_lists(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text(json.dumps([{"fn_name": "fn_now", "return_type": "str"}, {**GOOD, "args_names": [], "args_types": {}}]))
    assert load_catalog(spark, str(path)).count() == 2


def test_folder_of_definitions_and_repeated_names(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{**GOOD, "fn_name": "fn_alpha"}, {**GOOD, "fn_name": "fn_beta"}]))
    (tmp_path / "b.json").write_text(json.dumps([
        {**GOOD, "fn_name": "fn_gamma"}, {**GOOD, "fn_name": "fn_alpha", "args_types": {"n": "str"}}]))
    catalog = load_catalog(spark, str(tmp_path))
    rows = catalog.orderBy("ord").collect()
    assert [r.fn_name for r in rows] == ["fn_alpha", "fn_beta", "fn_gamma"]
    assert rows[0].args_types == {"n": "str"} and len({r.ord for r in rows}) == 3
    asked = spark.createDataFrame([("use gamma",), ("use beta",), ("use alpha",), ("none",)], "prompt string")
    for method in ("inrow", "join"):
        got = {r.prompt: r.fn_name for r in select_function(asked, catalog, method=method).collect()}
        assert got == {"use gamma": "fn_gamma", "use beta": "fn_beta", "use alpha": "fn_alpha", "none": "fn_alpha"}


def test_repeated_name_gives_one_call(spark):
    catalog = catalog_from_rows(spark, [("fn_a", [("x", "int")], "int"), ("fn_b", [], "int"),
                                        ("fn_a", [("y", "str")], "int")])
    assert [(e["ord"], e["fn_name"], e["args_names"]) for e in collect_entries(catalog)] == \
        [(0, "fn_a", ["y"]), (1, "fn_b", [])]
    raw = spark.createDataFrame([(1, "fn_a", '{"y": 5.0}'), (2, "fn_a", "null"), (3, "fn_b", "null"),
                                 (4, "fn_a", '{"y": 5}'), (5, "fn_zzz", '{"y": 2.50}')],
                                "id int, raw_fn string, j string").withColumn("raw_args", F.try_parse_json("j"))
    out = {r.id: r for r in decode_calls(raw, catalog).collect()}
    assert len(out) == 5
    assert out[1].picks[0].c.v_str == "5.0" and out[4].picks[0].c.v_str == "5"
    assert out[2].is_fallback and not out[3].is_fallback and out[3].fn_name == "fn_b"
    assert out[5].fn_unknown and out[5].picks[0].c.v_str in ("2.5", "2.50")


def test_large_catalogue_needs_no_key(spark):
    catalog = catalog_from_rows(spark, [(f"fn_item{i}", [], "int") for i in range(10_050)])
    asked = spark.createDataFrame([("take item10049 now",), ("take item3",), ("take item3",), ("nothing",)],
                                  "prompt string")
    got = sorted(r.fn_name for r in select_function(asked, catalog).collect())
    assert got == ["fn_item0", "fn_item10049", "fn_item3", "fn_item3"]


def test_broken_vocabulary_raises(spark, tmp_path):
    (tmp_path / "v.json").write_text("{broken")
    with pytest.raises(EmptyTokenTable):
        load_token_table(spark, str(tmp_path / "v.json"))
    pairs = spark.createDataFrame([("9000000000", "big", 0), ("x", "no", 1)], "key string, value string, ord int")
    assert [tuple(r) for r in invert_token_table(pairs).collect()] == [(9_000_000_000, "big")]


def test_session_keeps_its_settings_and_planning_runs_no_job(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert get_spark().conf.get("spark.sql.adaptive.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    path = str(tmp_path / "t")
    spark.range(100).coalesce(1).write.parquet(path)
    frame = spark.read.parquet(path).groupBy((F.col("id") % 3).alias("k")).count()
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        split = ensure_parallelism(frame)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert split.count() == 3


def test_validation_without_loader_findings(spark):
    valid, rejects = validate_catalog(catalog_from_rows(spark, [("fn_a", [], "int"), ("bad", [], "int")]), strict=False)
    assert valid.count() == 1 and rejects.count() == 1


def test_bad_utf8_is_rejected(spark, tmp_path):
    from callsmith.sources.json_records import load_json_records
    (tmp_path / "a.json").write_bytes(b'[{"prompt": "caf\xff"}]')
    records, rejects = load_json_records(spark, str(tmp_path / "a.json"))
    assert records.count() == 0 and [r.issue for r in rejects.collect()] == ["bad_utf8"]


def test_lines_and_tables_as_sources(spark, tmp_path):
    from callsmith.operators.catalog import CatalogError, catalog_from_rows
    from callsmith.sources.json_records import load_catalog, load_requests
    (tmp_path / "r.jsonl").write_text('{"prompt": " one "}\n\n"two"\n3\n{bad\n{"prompt": ""}\n')
    valid, rejects = load_requests(spark, str(tmp_path / "r.jsonl"), form="lines")
    assert sorted(r.prompt for r in valid.collect()) == ["one", "two"]
    assert sorted(r.issue for r in rejects.collect()) == ["bad_json", "empty_prompt", "skipped_bigint"]
    (tmp_path / "c.jsonl").write_text(
        '{"fn_name": "fn_a", "args_names": ["x"], "args_types": {"x": "int"}, "return_type": "int"}\n')
    assert [r.fn_name for r in load_catalog(spark, str(tmp_path / "c.jsonl"), form="lines").collect()] == ["fn_a"]
    (tmp_path / "c.jsonl").write_text("{bad\n")
    with pytest.raises(ValueError):
        load_catalog(spark, str(tmp_path / "c.jsonl"), form="lines")
    table = catalog_from_rows(spark, [("fn_a", [("x", "int")], "int"), ("fn_a", [("y", "str")], "str")])
    table.write.parquet(str(tmp_path / "c"))
    loaded = load_catalog(spark, spark.read.parquet(str(tmp_path / "c"))).collect()
    assert [(r.ord, r.fn_name, r.args_names) for r in loaded] == [(0, "fn_a", ["y"])]
    with pytest.raises(CatalogError):
        load_catalog(spark, table.selectExpr("ord", "fn_name", "args_types as args_names", "args_types", "return_type"))
    texts = spark.createDataFrame([(1, " hi "), (2, " ")], "k int, body string")
    valid, rejects = load_requests(spark, texts, text_col="body")
    assert [(r.k, r.prompt) for r in valid.collect()] == [(1, "hi")] and rejects.count() == 1
