"""Connected components of an edge table by alternating large-star and small-star steps.

Each step joins every node to the smallest node it can see, in one shuffle of the edges; the
edge table is written to the shared folder between rounds, so no lineage grows and a lost
executor re-reads files. A node with very many neighbours is never gathered: minima are partial
aggregates and the join back to the neighbours is one that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actimetry.llm.common import materialise


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a != b").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    links = down.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return links.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it can reach.
    Null ends and loops are ignored; an empty edge table gives no rows."""
    e = materialise(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "edges")
    seen = None
    while True:
        e = materialise(_small_star(_large_star(e)), "edges")
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == seen:
            break
        seen = state
    return (e.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())
