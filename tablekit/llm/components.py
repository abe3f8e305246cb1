"""Connected components of a distributed edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.store import Shelf


def _digest(edges: DataFrame) -> tuple:
    """A fingerprint of an edge set: its size and the sum of its rows' hashes."""
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Rows ``(node, root)`` for every node of ``edges(a, b)``; the root is the component's least node.

    Nodes may be of any type that Spark orders. Loops, repeated and reversed edges are allowed; edges with a
    null end are left out. Each round replaces edges by edges to smaller nodes, so the work a round does is
    in proportion to the edges; minima are combined before the shuffle and written, so that the join back to a
    node with very many edges can be split. Rounds grow with the logarithm of the longest chain. Nothing is
    collected but one fingerprint of each round.
    """
    shelf = Shelf(edges.sparkSession, label)
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = shelf.put(edges, "e0")
    before = _digest(edges)
    turn = 0
    while before[0]:
        turn += 1
        # Large star: each larger neighbour of a node goes to the least neighbour (or the node itself).
        pairs = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        least = shelf.put(least, f"l{turn}")
        large = pairs.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = shelf.put(large.where("u <> v").distinct(), f"s{turn}")
        # Small star: a node and its smaller neighbours go to the least of these.
        least = shelf.put(large.groupBy("u").agg(F.min("v").alias("m")), f"m{turn}")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = shelf.put(small, f"e{turn}")
        shelf.drop(f"e{turn - 1}", f"l{turn}", f"s{turn}", f"m{turn}")
        after = _digest(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(edges.select(F.col("u").alias("node"), F.col("v").alias("root")))
