"""Tables derived from a catalogue, kept under its fingerprint and used again by later jobs.

The setting ``spark.callsmith.catalogStore`` names a shared folder; unset, nothing is kept between jobs.  A table lies in
``<store>/<fingerprint>/<name>/<attempt>``.  An attempt has a folder of its own and counts once its write is
committed (``_SUCCESS``), so a job that dies, or two jobs that build the same table at once, leave nothing half written.
A changed catalogue has another fingerprint and never sees the tables of the old one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsmith.operators.catalog import definition_fingerprint
from callsmith.session import ensure_checkpoint_dir

STORE = "spark.callsmith.catalogStore"
_PARTS = 4


def set_fingerprint(catalog: DataFrame) -> str:
    """One fingerprint of the definitions and their ``ord``, whatever the order of the rows: the count and the sums of
    four 60-bit parts of the definitions' digests, by one aggregate with map-side combine."""
    # The order of the argument types counts here, as the sequences spell them out in that order.
    exact = F.sha2(F.concat_ws("\n", F.col("ord").cast("string"), definition_fingerprint(),
                               F.to_json(F.map_entries("args_types"))), 256)
    digests = catalog.select(exact.alias("d"))
    parts = [F.sum(F.conv(F.substring("d", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")) for i in range(_PARTS)]
    row = digests.agg(F.count(F.lit(1)), *parts).first()
    return "-".join(str(v or 0) for v in row)


def kept(catalog: DataFrame, tables: dict[str, Callable[[dict[str, DataFrame]], DataFrame]]) -> dict[str, DataFrame]:
    """The named tables, read from the store where they lie there, else built in order (each may use those before it)
    and stored; without a store they are checkpointed."""
    spark = catalog.sparkSession
    store = spark.conf.get(STORE, None)
    found: dict[str, DataFrame] = {}
    if not store:
        ensure_checkpoint_dir(spark)
        for name, build in tables.items():
            found[name] = build(found).checkpoint()
        return found
    root = f"{store.rstrip('/')}/{set_fingerprint(catalog)}"
    for name, build in tables.items():
        path = _committed(spark, f"{root}/{name}")
        if path is None:
            path = f"{root}/{name}/{uuid.uuid4().hex}"
            build(found).write.parquet(path)
        found[name] = spark.read.parquet(path)
    return found


def _committed(spark, folder: str) -> str | None:
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*/_SUCCESS")
    listed = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    paths = sorted(s.getPath().getParent().toString() for s in listed or [])
    return paths[0] if paths else None
