"""Connected components of an edge table, by alternating large and small stars.

Every round rewrites the edges so that they point to smaller nodes; the
rounds stop when the edges form stars around each component's smallest
node (a few rounds, growing with the logarithm of the number of nodes).
Each round is two aggregations with map-side combining and two equi-joins,
so a hub with many links is never gathered in one task, and each round's
edges are written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import saved


def _with_min(e: DataFrame) -> DataFrame:
    """Edges (u, v) with ``m``, the smallest neighbour of ``u``."""
    low = e.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
    return e.join(low, F.col("u") == F.col("w")).drop("w")


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_with_min(both).where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    x = _with_min(e)
    return (x.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .union(x.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component, for every node of ``edges`` (a, b).

    Self-links and repeated links do no harm; an empty table gives no rows.
    """
    e = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
              "edges")
    mark = None
    while True:
        stars = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if stars == mark or not stars[0]:
            break
        mark = stars
        e = saved(_small_star(_large_star(e)), "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
