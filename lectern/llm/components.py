"""Connected components of an edge list by alternating large-star and small-star steps, each written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import staged


def _settled(edges: DataFrame) -> bool:
    """Whether each edge leads from a node of one edge to a root that leads nowhere."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(edges.select("v", F.lit(0), F.lit(1)))
    each = ends.groupBy("n").agg(F.sum("down").alias("down"), F.sum("up").alias("up"))
    return each.where("down > 1 or (down > 0 and up > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the undirected edges (a, b) but the roots; a root is the least node of its component.

    Null ends and loops link nothing; repeated edges count once; no edges give no rows. The number of rounds grows with
    the logarithm of the longest path. No node's neighbours are gathered: minima are pre-aggregated, and the joins
    are plain equi-joins whose large keys adaptive execution splits.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = staged(edges, "edges")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
