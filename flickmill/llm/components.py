"""Connected components of a link table, by rounds of joins with their results written between."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flickmill.llm.scratch import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each end of the edges (a, b): the least node that it is linked with.

    Alternates large-star and small-star rounds (every node's neighbours are linked to the least of them) until
    nothing changes; a round groups and joins on node ids, and no node's links meet in one task as a list.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: larger neighbours go to the least one
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours and the node itself go to the least smaller one
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u")
        new = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small_least.select("u", F.col("m").alias("v"))).distinct()
        new = written(new, "edges")
        was, now = (e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first() for e in (edges, new))
        edges = new
        if was == now:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
