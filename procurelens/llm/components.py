"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import saved


def components(links: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """``links(a, b)``: undirected links of long ids. Returns ``(id, component)`` for every linked id,
    the component being its smallest id.

    Alternates two star contractions until all links are stars round their smallest node: first every larger
    neighbour of a node is linked to the node's smallest neighbour, then every smaller one.
    Only sums and joins by node are used, merged at any size: links are as many as the input, and a broadcast passes
    through the driver. A node with very many links is a skewed join key, which adaptive execution splits.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = saved(edges, f"{name}-links")
    for _ in range(rounds):
        if _settled(edges):
            break
        for larger in (True, False):
            both = edges
            if larger:
                both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select(
                F.col("u").alias("w"), F.least("u", "m").alias("m"))
            met = both.join(least.hint("merge"), both.u == least.w)
            if larger:
                edges = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            else:
                new = met.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                 F.col("m").alias("v"))
                edges = new.where("u <> v").distinct()
        edges = saved(edges, f"{name}-star")
    else:
        raise RuntimeError("links did not settle")
    nodes = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, which has none itself: nothing would change any more."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or up = 1 and down = 1").isEmpty()
