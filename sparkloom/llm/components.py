"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.workspace import written


def _starred(edges: DataFrame, larger: bool) -> DataFrame:
    """One step over edges (u, v): with `larger`, each node links its larger neighbours to the smallest node it
    knows; otherwise it links its smaller neighbours and itself to that node."""
    if larger:
        known = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        known = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = known.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = known.join(least, "u")
    if larger:
        made = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        made = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                               F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
    return made.where("u <> v").distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node that has a link; the component is its smallest node.

    The number of steps grows with the logarithm of the longest path. Each step is written to the shared folder, so
    the plan stays short and a lost executor costs one step. Runs until a step changes nothing.
    """
    edges = written(links.select(F.col(left).cast("long").alias("u"), F.col(right).cast("long").alias("v"))
                    .where("u <> v").distinct(), "edges")
    mark = None
    while True:
        edges = written(_starred(_starred(edges, True), False), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
