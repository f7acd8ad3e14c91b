"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.session import forget, stored


#: Edges in one file and task of a round.
EDGES = 200_000


def connected_components(edges: DataFrame) -> DataFrame:
    """``src``, ``dst`` (long) to ``node``, ``component``: the smallest node
    that a node reaches.  Nodes without an edge to another node don't appear.

    Each round hangs every node's larger neighbours, then its smaller ones, on
    the smallest neighbour, until each component is a star around its smallest
    node (which one aggregate over the nodes tells; edges that are stars from the
    start take no round).  Every round is a written table, so lineage stays short
    and nothing is collected.  The smallest neighbours are written before they are
    joined, so that Spark can broadcast them by their size or split the partition
    of a hub; no table outgrows the edges, and each gets a file for EDGES of them.
    """
    current = stored(edges.select(F.greatest("src", "dst").alias("a"),
                                  F.least("src", "dst").alias("b"))
                     .filter("a != b").distinct(), "edges")
    parts = max(1, -(-current.count() // EDGES))

    def small(df: DataFrame, name: str) -> DataFrame:
        return stored(df.coalesce(parts), name)

    while not _stars(current):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = small(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "low")
        larger = small(both.filter("b > a").join(low, "a")
                        .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "larger")
        least = small(larger.groupBy("a").agg(F.min("b").alias("m")), "least")
        smaller = (larger.join(least, "a").filter("b != m")
                   .select(F.col("b").alias("a"), F.col("m").alias("b"))
                   .unionByName(least.withColumnRenamed("m", "b")).distinct())
        following = small(smaller, "edges")
        for old in (current, low, larger, least):
            forget(old)
        current = following
    roots = current.select(F.col("b").alias("a"), "b").distinct()
    return current.unionByName(roots).toDF("node", "component")


def _stars(edges: DataFrame) -> bool:
    """Each larger node has one edge, and no node is larger in one edge and
    smaller in another."""
    ends = edges.selectExpr("stack(2, a, 1, 0, b, 0, 1) as (node, larger, smaller)")
    return (ends.groupBy("node").agg(F.sum("larger").alias("larger"),
                                     F.max("smaller").alias("smaller"))
            .filter("larger > 1 or (larger = 1 and smaller = 1)").isEmpty())
