"""Connected components of a large graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retinue.llm.common import written

#: The least neighbours of a graph of at most so many edges are broadcast.
BROADCAST_EDGES = 100_000


def _state(stars: DataFrame) -> tuple[int, bool]:
    """The number of edges (u, v), and whether each u has one v only, which is nobody's u."""
    ends = stars.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")
                        ).unionByName(stars.select(F.col("v").alias("node"), F.lit(0).alias("up"),
                                                   F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    edges, open_nodes = nodes.agg(F.sum("up"), F.count_if(F.col("up") + F.col("down") > 1)).first()
    return edges or 0, not open_nodes


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) for the nodes of ``edges`` (a, b); the label is the least node reached.

    Large star and small star in turn, until every node but the least of its component has
    the one edge to that: every node links its neighbours to the least one it knows. Rounds
    grow with the logarithm of the longest path; edges that are stars already take none.
    Edges are written after each round; a hub's edges are never gathered, only its
    least neighbour is, and the join that follows can be split where it is skewed. That join
    moves no edge once few are left.
    """
    ordered = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    stars = written(ordered, name)
    while True:
        count, done = _state(stars)
        if done:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                stars.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
        few = count <= BROADCAST_EDGES
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(F.broadcast(least) if few else least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        large = large if few else large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(F.broadcast(least) if few else least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(),
                        name)
