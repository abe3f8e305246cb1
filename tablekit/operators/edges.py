"""Lineage over an edge table ``(src, dst)``: ``dst`` is built from ``src``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.errors import InvalidSpec
from tablekit.session import materialize

# Layers of visited pairs before the old ones are written as one, so the plan stays short.
_COMPACT_EVERY = 10
#: Rounds by single edges before jumps are made: most graphs are done by then.
STEPS = 4
#: Jumps are doubled while that makes at most so many pairs for each edge.
GROWTH = 4


def neighbors(edges: DataFrame, node: str | None = None) -> DataFrame:
    """Direct dependencies as rows ``(node, dependency, dependencies)``, for one node or all.

    Rows, not lists: a node may have any number of dependencies. The count comes with them.
    """
    links = edges.select(F.col("dst").alias("node"), F.col("src").alias("dependency")).distinct()
    if node is not None:
        links = links.where(F.col("node") == node)
    counts = links.groupBy("node").agg(F.count(F.lit(1)).alias("dependencies"))
    return links.join(counts, "node")


def _doubled(jumps: DataFrame, most: int) -> DataFrame | None:
    """Two jumps as one, if that makes at most ``most`` pairs before duplicates go; else None."""
    out = jumps.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("out"))
    into = jumps.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("into"))
    # The pairs of two jumps, counted at the node between them.
    pairs = out.join(into, "node").agg(F.sum(F.col("out").cast("double") * F.col("into"))).first()[0] or 0
    if pairs > most:
        return None
    far = jumps.select(F.col("src").alias("mid"), F.col("dst").alias("far"))
    two = jumps.join(far, jumps.dst == far.mid).select("src", F.col("far").alias("dst")).distinct()
    return materialize(two, "jumps")


def _reach(edges: DataFrame, starts: DataFrame | None, max_depth: int | None) -> DataFrame:
    """``(start, node, depth)``: every node on a directed path from ``start``, with its distance.

    A round extends the pairs of the last ``length`` distances by jumps of exactly that length: a shortest path of
    d steps is one of d - length steps and a jump. The jumps are doubled after each round while they stay few, so a
    long path takes as many rounds as its length has binary digits; in a bushy graph, where double jumps would be many,
    rounds go on with the jumps there are. Pairs already known are dropped, so cycles end.
    """
    links = materialize(edges.select("src", "dst").where("src <> dst").distinct(), "links")
    known = links.select(F.explode(F.array("src", "dst")).alias("start")) if starts is None else starts
    layers = [(0, materialize(known.where("start IS NOT NULL").distinct().select("start", F.col("start").alias("node"), F.lit(0).alias("depth")), "reach"))]
    most = GROWTH * links.count()
    jumps, length, depth = links, 1, 1  # all nodes nearer than ``depth`` are known
    while max_depth is None or depth <= max_depth:
        recent = reduce(DataFrame.unionByName, [df for last, df in layers if last >= depth - length])
        recent = recent.where(F.col("depth") >= depth - length)
        step = recent.join(jumps, recent.node == jumps.src).groupBy("start", F.col("dst").alias("node"))
        step = step.agg((F.min("depth") + length).cast("int").alias("depth"))
        visited = reduce(DataFrame.unionByName, [df for _, df in layers])
        fresh = materialize(step.join(visited, ["start", "node"], "left_anti"), "reach")
        if fresh.isEmpty():
            break
        depth += length
        layers.append((depth - 1, fresh))
        if depth >= max(2 * length, STEPS) and (max_depth is None or depth <= max_depth):
            two = _doubled(jumps, most)
            if two is None:
                most = 0
            else:
                jumps, length = two, 2 * length
        if len(layers) >= _COMPACT_EVERY and length < depth // 2:
            old = [df for last, df in layers if last < depth - length]
            if len(old) > 1:
                rest = [(last, df) for last, df in layers if last >= depth - length]
                layers = [(depth - length - 1, materialize(reduce(DataFrame.unionByName, old), "visited")), *rest]
    found = reduce(DataFrame.unionByName, [df for _, df in layers]).where("depth > 0")
    return found if max_depth is None else found.where(F.col("depth") <= max_depth)


def closure(
    edges: DataFrame,
    nodes: list[str] | DataFrame | None = None,
    direction: str = "both",
    max_depth: int | None = None,
) -> DataFrame:
    """Everything upstream and/or downstream of some nodes, with the distance.

    Without ``nodes`` all nodes are starts, and then ``max_depth`` must bound the pairs, whose number would
    otherwise be that of all ancestors of all nodes.

    Each round extends the pairs found last and drops pairs already known, so cycles end; see :func:`_reach` for how
    long paths are cut short. Rounds are written to the shared folder, which cuts the lineage.
    """
    if direction not in ("both", "upstream", "downstream"):
        raise InvalidSpec(f"direction {direction!r}")
    if nodes is None and max_depth is None:
        raise InvalidSpec("give nodes to start from, or max_depth")
    starts = None
    if isinstance(nodes, DataFrame):
        starts = nodes.toDF("start")
    elif nodes is not None:
        starts = edges.sparkSession.createDataFrame([(n,) for n in nodes], "start string")

    def shaped(pairs: DataFrame, node: str, related: str, label: str) -> DataFrame:
        return pairs.select(
            F.col(node).alias("node"), F.col(related).alias("related"), F.lit(label).alias("direction"), "depth"
        )

    parts = []
    if starts is None:
        # Upstream pairs of all nodes are the downstream pairs read backwards.
        pairs = _reach(edges, None, max_depth)
        if direction != "upstream":
            parts.append(shaped(pairs, "start", "node", "downstream"))
        if direction != "downstream":
            parts.append(shaped(pairs, "node", "start", "upstream"))
    else:
        if direction != "upstream":
            parts.append(shaped(_reach(edges, starts, max_depth), "start", "node", "downstream"))
        if direction != "downstream":
            back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
            parts.append(shaped(_reach(back, starts, max_depth), "start", "node", "upstream"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
