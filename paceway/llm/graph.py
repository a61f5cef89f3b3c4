"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceway.runtime import written


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)`` that is not the root; the root is the least node of its component.

    Alternating large-star and small-star steps: each links neighbours to the least node seen around them, until every component is a star. Minima are folded before
    the shuffle, and the joins on a node of very many edges can be split.
    """
    now = written(edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).where("node <> root").distinct(), "edges")
    mark = None
    while True:
        both = now.union(now.select("root", "node"))
        least = both.groupBy("node").agg(F.min("root").alias("least")).select("node", F.least("node", "least").alias("least"))
        large = both.where("root > node").join(least, "node").select(F.col("root").alias("node"), F.col("least").alias("root"))
        large = large.union(least.where("least < node").select("node", "least")).distinct()
        lowest = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(lowest, "node").where("root <> least").select(F.col("root").alias("node"), F.col("least").alias("root"))
        now = written(small.union(lowest.select("node", "least")).distinct(), "stars")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now
        mark = seen
