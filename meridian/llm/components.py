"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the smallest node of its component.

    Every round is two aggregations and joins over the edges, written to the shared
    folder; rounds grow with the logarithm of the longest path. No adjacency list is
    ever gathered, so a hub of any degree is only many rows.
    """
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    nodes = now.select(F.col("u").alias("node")).unionByName(now.select(F.col("v").alias("node"))).distinct()
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialise(least.select("u", F.col("m").alias("v")).unionByName(small).distinct(), "edges")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
