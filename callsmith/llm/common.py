"""Small helpers of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.column import Column

from callsmith.session import ensure_checkpoint_dir, shared_path  # noqa: F401 (for the operators)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII texts take the fast built-in ``lower``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def reliable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sampled(key: Column, share: Column | float) -> Column:
    """Whether ``key``'s hash falls into the first ``share`` (0 to 1) of the hash range, which is
    fine enough for a small sample of any table."""
    whole = 1 << 53
    return F.pmod(F.xxhash64(key), F.lit(whole)) < (F.lit(share) if isinstance(share, float) else share) * whole


def text_hash(text: Column) -> Column:
    """A hash of a text (null: empty) that tells rows with one doc_id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
