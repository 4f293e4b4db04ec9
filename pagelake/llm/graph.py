"""Connected components of an edge table, by alternating star contraction.

Nothing is collected: each round is two partial aggregations and joins over the
edges, written to the shared folder.  Rounds grow with the logarithm of the
longest chain, edges never grow beyond the first count of distinct ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _stars(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Large star (every larger neighbour to the smallest neighbour or itself) or small star."""
    if larger_only:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(low, "u")
    if larger_only:
        out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (u, v of one orderable type); root is the smallest node reachable."""
    now = materialize(edges.select("u", "v").where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while mark[0]:
        now = materialize(_stars(_stars(now, True), False), "components")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
