"""Catalogue tables kept under the fingerprint of the set."""

import pytest
from pyspark.sql import functions as F

from callsmith.operators import walk
from callsmith.operators.artefacts import STORE, set_fingerprint
from callsmith.operators.catalog import catalog_from_rows

CATALOG = [("fn_add", [("a", "float"), ("b", "float")], "float"), ("fn_greet", [("name", "str")], "str"),
           ("fn_add_all", [("a", "float")], "float")]


def vectors(spark):
    return spark.createDataFrame([(i, [float((t * 7 + i * 3) % 11) for t in range(40)]) for i in range(12)],
                                 "k int, s array<double>")


def walked(spark, rows, form):
    return sorted(map(tuple, walk.constrained_walk(vectors(spark), catalog_from_rows(spark, rows), "s", form=form).drop("s").collect()))


def test_fingerprint_of_a_set(spark):
    cat = catalog_from_rows(spark, CATALOG)
    one = set_fingerprint(cat)
    assert one == set_fingerprint(cat.orderBy(F.desc("ord")).repartition(3))
    assert one != set_fingerprint(catalog_from_rows(spark, CATALOG[:2]))
    assert one != set_fingerprint(catalog_from_rows(spark, [CATALOG[1], CATALOG[0], CATALOG[2]]))
    assert set_fingerprint(cat.limit(0)) == "0-0-0-0-0"


@pytest.mark.parametrize("form", ["auto", "join"])
def test_second_job_builds_nothing(spark, tmp_path, monkeypatch, form):
    plain, other = walked(spark, CATALOG, form), walked(spark, CATALOG[:2], form)
    spark.conf.set(STORE, str(tmp_path / "store"))
    try:
        assert walked(spark, CATALOG, form) == plain
        build = walk.catalog_sequences
        calls = []
        monkeypatch.setattr(walk, "catalog_sequences", lambda c: calls.append(1) or build(c))
        monkeypatch.setattr(walk, "radix_edges", lambda e, f=walk.radix_edges: calls.append(2) or f(e))
        assert walked(spark, CATALOG, form) == plain and not calls
        # A write that was not committed is not read, and a changed set is built anew.
        for marker in (tmp_path / "store").glob("*/sequences/*/_SUCCESS"):
            marker.rename(marker.with_name("_STARTED"))
        assert walked(spark, CATALOG, form) == plain and calls
        calls.clear()
        assert walked(spark, CATALOG[:2], form) == other and calls
    finally:
        spark.conf.unset(STORE)
