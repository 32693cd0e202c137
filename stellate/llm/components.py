"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a grouped minimum (combined before the shuffle) and a join, and never gathers a node's
neighbours; a hot centre only makes its join key frequent, which AQE splits. Rounds grow with the
logarithm of the longest path; each is staged, so lineage stays short and lost executors cost one
round's re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.staging import stage


def _state(edges: DataFrame) -> tuple[int, int]:
    """Number of links and a digest of them that does not depend on their order."""
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v); root is the smallest node reachable. Self links
    and repeated links are allowed."""
    edges = stage(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
                 .unionByName(least.select("u", F.col("m").alias("v")))).distinct()
        edges = stage(small, "links")
        if (new := _state(edges)) == state:
            break
        state = new
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
