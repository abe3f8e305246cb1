"""Several models that read each other's tables: their order, a selection of them, and what each has to load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.errors import InvalidSpec
from tablekit.operators import models
from tablekit.operators.edges import closure
from tablekit.operators.models import IntervalLog, Model
from tablekit.operators.runs import RunLog
from tablekit.session import materialize


class CycleFound(InvalidSpec):
    """Models that need each other have no order."""


def levels(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """``node``, ``level``: 0 for nodes that need nothing, else one more than the highest of those they need.

    Sources are removed from the edge table ``(src, dst)`` again and again; ``nodes`` adds some that may have no
    edge. A round is one anti join and one semi join over what is left, written to the shared folder: as many rounds as
    the longest path has nodes. If a round finds no source the rest holds a cycle, which is an error.
    """
    left = edges.select(F.explode(F.array("src", "dst")).alias("node"))
    if nodes is not None:
        left = left.unionByName(nodes.select("node"))
    left = materialize(left.where("node IS NOT NULL").distinct(), "nodes")
    links = materialize(edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct(), "links")
    placed, level = None, 0
    while not left.isEmpty():
        needing = links.select(F.col("dst").alias("node")).distinct()
        ready = materialize(left.join(needing, "node", "left_anti"), "ready")
        if ready.isEmpty():
            some = [r.node for r in left.orderBy("node").limit(10).collect()]
            raise CycleFound(f"no order for {some}: a cycle, or behind one")
        own = ready.withColumn("level", F.lit(level))
        placed = own if placed is None else placed.unionByName(own)
        left = materialize(left.join(ready, "node", "left_anti"), "nodes")
        links = materialize(links.join(ready.select(F.col("node").alias("src")), "src", "left_anti"), "links")
        level += 1
    return left.withColumn("level", F.lit(0)) if placed is None else placed


def select(edges: DataFrame, nodes: Sequence[str], selection: str = "*") -> set[str]:
    """The nodes that a selection names: parts between commas, each ``*`` or a node; ``+`` before it adds all it needs,
    after it all that need it."""
    known, chosen = set(nodes), set()
    for part in (p.strip() for p in selection.split(",")):
        name = part.strip("+")
        if name == "*":
            chosen |= known
            continue
        if name not in known:
            raise InvalidSpec(f"selection {part!r}: no model {name!r}")
        chosen.add(name)
        for mark, direction in ((part.startswith("+"), "upstream"), (part.endswith("+"), "downstream")):
            if mark:
                chosen |= {r.related for r in closure(edges, [name], direction).collect()} & known
    return chosen


@dataclass(frozen=True)
class Step:
    """One job of a plan: a model's days from ``start`` to ``end``, both included, and the rows written."""

    level: int
    model: str
    start: date
    end: date
    rows: int = field(default=0, compare=False)


@dataclass(frozen=True)
class Node:
    """A model, its table, the models it reads, and for how many days after a day it reads that day (``reach``)."""

    model: Model
    table: str
    needs: tuple[str, ...] = ()
    reach: int = 0
    path: str | None = None


def edge_table(spark: SparkSession, nodes: Mapping[str, Node]) -> DataFrame:
    """``(src, dst)`` of models: ``dst`` reads ``src``. Names that are no models of the plan are tables from elsewhere."""
    links = [(need, name) for name, node in nodes.items() for need in node.needs if need in nodes]
    return spark.createDataFrame(links, "src string, dst string")


def _ranges(days: set[date]) -> list[tuple[date, date]]:
    out: list[tuple[date, date]] = []
    for day in sorted(days):
        if out and day - out[-1][1] == timedelta(days=1):
            out[-1] = out[-1][0], day
        else:
            out.append((day, day))
    return out


def apply(
    spark: SparkSession,
    nodes: Sequence[Node],
    start: str | date,
    end: str | date,
    intervals: IntervalLog,
    selection: str = "*",
    log: RunLog | None = None,
) -> list[Step]:
    """Bring the selected models up to date for the days ``start`` to ``end``; returns the jobs run, in order.

    Models run level by level. A model loads the days that its log lacks, and again those that a model it reads
    loaded in this plan, with the ``reach`` days after them; a run of such days is one job. A day that no model lacks
    costs nothing, so applying again does nothing. A job that fails ends the plan; applying again goes on from there,
    and what the finished jobs made stale for later ones is recorded before they run.
    """
    first, last = models._day(start), models._day(end)
    by_name = {n.model.name: n for n in nodes}
    if len(by_name) != len(nodes):
        raise InvalidSpec("two models have one name")
    edges = edge_table(spark, by_name)
    order = levels(edges, spark.createDataFrame([(n,) for n in by_name], "node string"))
    placed = sorted((r.level, r.node) for r in order.collect())  # a plan's models, not data
    chosen = select(edges, list(by_name), selection)
    missing = models.missing_days(intervals.read(), first, last, sorted(chosen)).collect()  # days of the plan
    todo: dict[str, set[date]] = {name: set() for name in chosen}
    for row in missing:
        todo[row.model].add(row.day)
    # What becomes stale is known before anything runs: the days that models above will load, passed down.
    for _, name in placed:
        for need in by_name[name].needs if name in chosen else ():
            for day in todo.get(need, ()):
                after = (day + timedelta(days=k) for k in range(by_name[name].reach + 1))
                todo[name] |= {d for d in after if first <= d <= last}
    lacking = {(row.model, row.day) for row in missing}
    for name in sorted(chosen):
        intervals.forget(name, _ranges({d for d in todo[name] if (name, d) not in lacking}))
    steps = []
    for level, name in placed:
        node = by_name[name]
        for low, high in _ranges(todo[name]) if name in chosen else ():
            rows = models.run(spark, node.model, low, high, node.table, node.path, intervals, log)
            steps.append(Step(level, name, low, high, int(rows)))
    return steps
