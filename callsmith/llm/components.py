"""Connected components of an undirected edge table (large-star / small-star).

Each round is two combinable minimum aggregations and two equi-joins, so a hub
is pre-aggregated before the shuffle and split by the skew-join rule after it.
Every round is cut with a reliable checkpoint; the loop ends when a round
changes nothing, which the driver sees from two numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callsmith.llm.common import reliable


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (u, v): link u's larger (smaller) neighbours to the least of u's neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.filter("v < u")
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    far = both.filter("v > u") if large else near
    moved = far.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.union(least.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the component's least node.

    Self-loops and repeated edges are allowed; an empty table gives no rows."""
    edges = reliable(edges.select("u", "v").filter("u <> v").distinct())
    mark = None
    while True:
        now = edges.agg(F.count("*").alias("n"),
                        F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if now == mark or now["n"] == 0:
            break
        mark = now
        edges = reliable(_star(_star(edges, True), False))
    # Now every edge is (node, root).
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
