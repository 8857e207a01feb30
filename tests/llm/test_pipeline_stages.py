"""The pipeline's stages, each against its operator or brute force on its own input."""

import corpus_pipeline
from callsmith.llm import simhash
from callsmith.session import table
from conftest import SMALL
from test_operators import base_spans


def test_stages_take_effect(spark, tmp_path):
    docs = table(spark, SMALL, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "packed":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
    ids = {n: {r.doc_id for r in rows} for n, rows in kept.items()}
    assert ids["packed"] == ids["personal_data"] == ids["decontamination"] < ids["near_duplicates"]
    prints = [simhash.simhash(r.text) for r in kept["near_duplicates"]]
    assert len(set(prints)) == len(prints)
    before = {r.doc_id: r.text for r in kept["decontamination"]}
    for r in kept["personal_data"]:
        assert not base_spans(r.text) and r.n_chars == len(r.text)
        if not base_spans(before[r.doc_id]):
            assert r.text == before[r.doc_id]


def test_stages_take_odd_tables(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, "x", None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.selectExpr("*", "'c' as row", "'c' as words", "'c' as fp", "'c' as spans", "1 as _langid")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SMALL)
            assert out.collect() is not None
            if name != "packed":
                assert out.columns == docs.columns
