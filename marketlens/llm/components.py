"""Connected components of an edge list by alternating star contraction.

Each round joins every edge with the smallest neighbour of its end (a grouped
minimum, so a hub is folded on the map side) and writes the new edges to the
shared folder. Nothing but one row count per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import keep


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over edges (a, b), a > b."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if large:
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        out = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        out = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); root: the smallest node reachable.

    An empty edge list gives no rows; loops and repeated edges change nothing.
    """
    edges = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), "edges")
    last = None
    while True:
        edges = keep(_star(_star(edges, True), False), "edges")
        # converged: every edge leads to a root, and a root has no edge of its own
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if last == state or not state["n"]:
            break
        last = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
