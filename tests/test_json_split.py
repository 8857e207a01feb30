"""The parallel JSON-array loader against the one that reads each file whole."""

import json
import random

import pytest

from callsmith.sources.json_records import load_json_records
from callsmith.sources.json_split import load_json_splits


@pytest.fixture
def tiny_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def rows(frames):
    records, rejects = frames
    return (sorted((r.source.split("/")[-1], r.ord, r.v) for r in
                   records.selectExpr("source", "ord", "to_json(v) AS v").collect()),
            sorted((r.source.split("/")[-1], -1 if r.ord is None else r.ord, r.issue) for r in rejects.collect()))


def values(rng, depth=0):
    kind = rng.randrange(9 if depth < 3 else 6)
    if kind < 3:
        return "".join(rng.choices(['a', 'é', '中', '"', "\\", ",", "]", "[", "{", "}", " ", "\n", ":", "😀"], k=rng.randint(0, 14)))
    if kind < 6:
        return rng.choice([0, -1.5, True, None, 12345678901])
    if kind < 8:
        return {values(rng, 9) if rng.random() < 0.2 else f"k{i}": values(rng, depth + 1) for i in range(rng.randint(0, 4))
                } if rng.random() < 0.99 else {}
    return [values(rng, depth + 1) for _ in range(rng.randint(0, 4))]


def test_same_records_and_rejects_over_many_splits(spark, tmp_path, tiny_splits):
    rng = random.Random(8)
    folder = tmp_path / "arrays"
    folder.mkdir()
    for i in range(8):
        data = [{"prompt": values(rng, 9)} if rng.random() < 0.3 else values(rng) for _ in range(rng.randint(0, 25))]
        text = json.dumps(data, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, None, 1]), default=str)
        (folder / f"good{i:02}.json").write_text(" \n" * (i % 3) + text + "\n" * (i % 2))
    broken = ['[{"a": 1}, {"b": 2}', '[1, 2] tail', '[1, 2],', '[1,, 2]', '[1, 2,]', '[,]', '{"a": [1, 2]}', '"text, more"',
              "7", "", "  ", "[]", " [ ] ", '[1][2]', '[{]}', '["open]', 'x[1]', '[{"a": 1}}', '[1, {"a": tru}]', '{"a": 1, ',
              "]", "[", '["\\\\", "\\"", "a,b\\\\\\""]', '[[1, [2, {"x": [3, "]"]}]], "[,"]', '[1]\n,\n', "[1 2]"]
    for i, text in enumerate(broken):
        (folder / f"odd{i:02}.json").write_text(text)
    (folder / "bytes.json").write_bytes(b'["fine", "\xff\xfe", 3]')
    want = rows(load_json_records(spark, str(folder)))
    for chunk in (24, 1 << 20):
        got = rows(load_json_splits(spark, str(folder), chunk))
        assert [set(g) ^ set(w) for g, w in zip(got, want)] == [set(), set()], chunk
        assert got == want


def test_joined_states_give_the_same(spark, tmp_path, monkeypatch):
    from callsmith.sources import json_split
    path = tmp_path / "one.json"
    path.write_text(json.dumps([{"prompt": f"sum of {i}, and {i + 1}"} for i in range(500)]))
    want = rows(load_json_records(spark, str(path)))
    monkeypatch.setattr(json_split, "MAX_SHIPPED_CHUNKS", 3)
    assert rows(load_json_splits(spark, str(path), 256)) == want


def test_one_file_is_read_by_as_many_tasks_as_splits(spark, tmp_path):
    path = tmp_path / "big.json"
    path.write_text("[" + ", ".join(json.dumps({"prompt": f"request number {i} " + "x" * 50}) for i in range(20_000)) + "]")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 17))
    try:
        splits = spark.read.text(str(path), lineSep=",").rdd.getNumPartitions()
        records, rejects = load_json_splits(spark, str(path), 1 << 15)
        assert splits >= 8
        got = records.selectExpr("ord", "try_variant_get(v, '$.prompt', 'string') AS p").orderBy("ord").collect()
        assert [r.ord for r in got] == list(range(20_000))
        assert all(r.p.startswith(f"request number {r.ord} ") for r in got) and rejects.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_missing_path(spark):
    records, rejects = load_json_splits(spark, "/tmp/never-there.json")
    assert records.count() == 0 and [r.issue for r in rejects.collect()] == ["missing_path"]


def test_folder_of_json_lines_keeps_each_definition(spark, tmp_path):
    from callsmith.operators.select import select_function
    from callsmith.sources.json_records import load_catalog
    names = []
    for f in range(5):
        lines = []
        for i in range(3 * f + 1):
            name = f"fn_{'abcde'[f]}{i}"
            names.append(name)
            lines.append(json.dumps({"fn_name": name, "args_names": ["x"], "args_types": {"x": "int"}, "return_type": "int"}))
        (tmp_path / f"{f}.jsonl").write_text("\n".join(lines))
    catalog = load_catalog(spark, str(tmp_path), form="lines")
    loaded = catalog.collect()
    assert sorted(r.fn_name for r in loaded) == sorted(names) and len({r.ord for r in loaded}) == len(names)
    requests = spark.createDataFrame([(i, f"call {n[3:]} now") for i, n in enumerate(names)], "k int, prompt string")
    for method in ("inrow", "join"):
        chosen = select_function(requests, catalog, key_cols=["k"], method=method).collect()
        assert {(r.k, r.fn_name) for r in chosen} == set(enumerate(names)) and len(chosen) == len(names)


def test_text_after_the_array_is_rejected_and_reported(spark, tmp_path):
    from callsmith.sources.json_records import load_report
    for name, text in (("a", '[{"x": 1}] tail'), ("b", '[{"x": 1}, 3]'), ("c", "[3, 4]"), ("d", "[]"), ("e", '[{"x": 1}],')):
        (tmp_path / f"{name}.json").write_text(text)
    for form in ("array", "split"):
        got = {r.source[-6]: (r.n_records, r.n_skipped, r.unread, r.no_valid_items)
               for r in load_report(spark, str(tmp_path), form).collect()}
        assert got == {"a": (0, 0, True, False), "b": (1, 1, False, False), "c": (0, 2, False, True),
                       "e": (0, 0, True, False)}


def test_text_is_cut_and_parsed_once(spark, tmp_path):
    from callsmith.sources.json_records import load_requests
    (tmp_path / "one.json").write_text(json.dumps([{"prompt": f"sum of {i}, and {i + 1}"} for i in range(300)] + [7, {"prompt": 3}]))
    (tmp_path / "two.json").write_text('[{"prompt": "x"},, 2]')
    for frame in (*load_json_splits(spark, str(tmp_path), 256), *load_requests(spark, str(tmp_path), form="split")):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" not in plan
        # Only the elements put together from the edges of chunks are still to be parsed.
        assert 0 < plan.count("parseJson") <= plan.count("array_join(")
    valid, rejects = load_requests(spark, str(tmp_path), form="split")
    assert sorted(r.req_id for r in valid.collect()) == list(range(1, 301))
    assert sorted((r.ord or 0, r.issue) for r in rejects.collect()) == sorted(
        (r.ord or 0, r.issue) for r in load_requests(spark, str(tmp_path))[1].collect())


def test_chunks_do_not_depend_on_batches():
    import pyarrow as pa
    from callsmith.sources.json_split import _chunks
    rng = random.Random(5)
    rows = [(f, start, f",{'x' * rng.randint(0, 9)}".encode()) for f in (1, 2) for start in (0, 90, 300) for _ in range(rng.randint(1, 30))]
    want = None
    for size in (1, 4, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i:i + size])], ["file", "start", "text"])
                   for i in range(0, len(rows), size)]
        got = list(_chunks(iter([b.slice(0, 0) for b in batches[:1]] + batches), 25))
        want = want or got
        assert got == want
    for file in (1, 2):
        assert b"".join(c[3] for c in want if c[0] == file) == b"".join(t for f, _, t in rows if f == file)[1:]
    assert all(len(c[3]) < 25 + 10 for c in want) and len(want) > 6


def test_joined_lines_write_the_same_file(spark, tmp_path):
    from callsmith.sources.sink import joined_lines
    lines = spark.range(500, numPartitions=3).selectExpr("IF(id = 7, NULL, IF(id = 8, '', concat('é, ', id))) AS line")
    joined = joined_lines(lines)
    assert joined.count() <= 3
    for name, frame in (("a", lines), ("b", joined)):
        frame.coalesce(1).write.text(str(tmp_path / name))
    a, b = (next((tmp_path / n).glob("*.txt")).read_bytes() for n in "ab")
    assert a == b and a.count(b"\n") == 500
