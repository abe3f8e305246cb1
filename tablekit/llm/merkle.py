"""Merkle manifests of tables: every few levels are stored, the levels between are computed again for proofs."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablekit.llm.store import Shelf

#: One level in so many is stored; a stored node stands for an aligned subtree of 2 ** STRIDE nodes of the stored level below.
STRIDE = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def combine(*digests: str) -> str:
    """The digest of a run of digests: lowercase hex sha256 of their hex texts, one after the other."""
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row: of each value ``-`` if null, else its length in bytes, ``:`` and its text."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def subtree(nodes: list[str], levels: int) -> list[list[str]]:
    """The levels of a subtree from its lowest nodes up; the last node of an uneven level is hashed alone."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([combine(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return out


def siblings(tree: list[list[str]], at: int) -> list[str]:
    """What node ``at`` of the lowest level meets on its way up: ``L`` or ``R`` and the sibling on that side, ``-`` if none."""
    path = []
    for level in tree[:-1]:
        other = at ^ 1
        path.append("-" if other >= len(level) else ("L" if other < at else "R") + level[other])
        at >>= 1
    return path


def fold(digest: str, path: Sequence[str]) -> str:
    """The root that a digest and its siblings lead to."""
    for step in path:
        if step == "-":
            digest = combine(digest)
        elif step[0] == "L":
            digest = combine(step[1:], digest)
        else:
            digest = combine(digest, step[1:])
    return digest


_NODE = "part string, idx bigint, digest string, height int"
_NODE_ARROW = pa.schema([("part", pa.string()), ("idx", pa.int64()), ("digest", pa.string()), ("height", pa.int32())])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Runs of rows with the same part and block (the first two columns); rows arrive in that order."""
    run: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if run and run[0][:2] != row[:2]:
                yield run
                run = []
            run.append(row)
    if run:
        yield run


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)

    for row in rows:
        part.append(row)
        if len(part) == most:
            yield batch()
            part = []
    if part:
        yield batch()


def _raise(level: int, stride: int) -> Callable:
    """From the nodes of a stored level those of the next one."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for run in _blocks(batches):
                part, block, _, _, height = run[0]
                yield part, block, subtree([r[3] for r in run], min(stride, height - level))[-1][0], height

        return _batches(rows(), _NODE_ARROW)

    return apply


_PATH = "part string, idx bigint, height int, path string, subroot string, root string"
_PROOF = "id bigint, leaf string, subroot string, root string, proof string, folded string"


def _descend(level: int, stride: int, schema: pa.Schema, last: bool, whole: bool) -> Callable:
    """Below a head row with the path of the block's upper node: the path of each node of the block.

    The levels between are computed from the block's nodes and given up with the block.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for head, *nodes in _blocks(batches):
                part, _, _, _, height, above, subroot, root, _, _ = head
                tree = subtree([r[3] for r in nodes], min(stride, height - level))
                above = above.split(",") if above else []
                for at, (_, _, idx, digest, _, _, _, _, ident, other) in enumerate(nodes):
                    path = siblings(tree, at) + above
                    if last:
                        proof = ",".join(path) if whole else combine(*(s[1:] for s in path))
                        yield ident, digest, subroot, root, proof, fold(other or digest, path)
                    else:
                        yield part, idx, height, ",".join(path), subroot, root

        return _batches(rows(), schema)

    return apply


@dataclass
class Manifest:
    """Stored levels from the leaves up (``part, idx, digest, height``; leaves with ``id`` and ``other``) and the roots.

    ``tops`` has a row for each part: its subroot, the root, and the path between them.
    """

    shelf: Shelf
    layers: list[DataFrame]
    tops: DataFrame
    stride: int


def _place(shelf: Shelf, rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Rows with their place ``idx`` in their part and the ``height`` of the part's tree.

    Rows are dealt by ranges of part and order, so a part may have any number of tasks. A task's rows of a part
    follow those of the tasks before it, whose numbers are added up: a row for each task and part.
    """
    keys = [F.col("part"), *(F.col(c).asc_nulls_first() for c in order)]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = shelf.put(dealt.withColumn("seq", F.monotonically_increasing_id()), f"{name}-sorted")
    task = F.shiftright("seq", 33)
    runs = dealt.groupBy("part", task.alias("task")).agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("part")
    before = F.coalesce(F.sum("n").over(own.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(own)
    runs = runs.select(
        "part", "task", (before - F.col("first")).alias("shift"),
        F.when(total > 1, F.length(F.bin(total - 1))).otherwise(0).cast("int").alias("height"),
    )
    placed = dealt.withColumn("task", task).join(runs, ["part", "task"])
    placed = placed.withColumn("idx", F.col("seq") + F.col("shift")).drop("seq", "task", "shift")
    placed = shelf.put(placed, f"{name}-0")
    shelf.drop(f"{name}-sorted")
    return placed


def _grow(shelf: Shelf, leaves: DataFrame, name: str, stride: int) -> list[DataFrame]:
    """The stored levels above placed leaves, until every part has one node."""
    layers = [leaves]
    most = leaves.agg(F.max("height")).first()[0] or 0
    for level in range(0, most, stride):
        below = layers[-1].where(F.col("height") > level)
        keyed = below.select("part", F.shiftright("idx", stride).alias("block"), "idx", "digest", "height")
        dealt = keyed.repartition("part", "block").sortWithinPartitions("part", "block", "idx")
        layers.append(shelf.put(dealt.mapInArrow(_raise(level, stride), _NODE), f"{name}-{level + stride}"))
    return layers


def _finished(layers: list[DataFrame], stride: int) -> DataFrame:
    """Each part's last node: its subroot."""
    found = None
    for k, layer in enumerate(layers):
        low, high = (k - 1) * stride if k else -1, k * stride
        own = layer.where((F.col("height") > low) & (F.col("height") <= high)).select("part", "digest")
        found = own if found is None else found.unionByName(own)
    return found


def _paths(shelf: Shelf, layers: list[DataFrame], tops: DataFrame, name: str, stride: int, whole: bool) -> DataFrame:
    """Proofs of the leaves from the stored levels, from the top down.

    ``tops``: part, height, path, subroot, root. Each block of a stored level meets one head row, its upper node's.
    """
    above = None
    for k in range(max(len(layers) - 2, 0), -1, -1):
        level, last = k * stride, k == 0
        low = -1 if last else level
        ends = tops.where((F.col("height") > low) & (F.col("height") <= level + stride)).withColumn("idx", F.lit(0).cast("long"))
        heads = ends if above is None else ends.unionByName(above)
        nothing = F.lit(None).cast("string")
        heads = heads.select(
            "part", F.col("idx").alias("block"), F.lit(-1).cast("long").alias("idx"), nothing.alias("digest"), "height",
            "path", "subroot", "root", F.lit(None).cast("long").alias("id"), nothing.alias("other"),
        )
        nodes = layers[k].where(F.col("height") > low).select(
            "part", F.shiftright("idx", stride).alias("block"), "idx", "digest", "height", nothing.alias("path"),
            nothing.alias("subroot"), nothing.alias("root"), *(["id", "other"] if last else [F.lit(None).cast("long").alias("id"), nothing.alias("other")]),
        )
        dealt = heads.unionByName(nodes).repartition("part", "block").sortWithinPartitions("part", "block", "idx")
        kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
        ddl = _PROOF if last else _PATH
        schema = pa.schema([(n, kinds[t]) for n, t in (c.split() for c in ddl.split(", "))])
        above = dealt.mapInArrow(_descend(level, stride, schema, last, whole), ddl)
        if not last:
            above = shelf.put(above, f"{name}-paths-{level}")
    return above


def build(
    docs: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", part_col: str = "lang",
    altered: dict[str, Column] | None = None, where: Column | None = None, stride: int = STRIDE,
) -> Manifest:
    """The manifest of a table: a tree for each value of ``part_col``, and a tree over their roots.

    A leaf is a row's digest over ``columns``. Leaves of a part ascend by id, a null id first and equal ids by
    digest, so the manifest does not depend on the order of the input; equal rows are leaves of their own. Null is a
    part like any other and comes first; parts ascend bytewise. ``altered`` gives other expressions for some columns
    of the rows ``where`` holds: their digests are kept beside the true ones, to be checked against the manifest.

    Stored are the leaves and every ``stride``-th level above, so little more than the leaves; texts are read once
    and never move. Places come from counts for each task, and a level's nodes are dealt by aligned blocks of
    2 ** ``stride``: no step has more than one block in hand, however large a part is.
    """
    shelf = Shelf(docs.sparkSession, "merkle")
    plain = {c: F.col(f"`{c}`") for c in columns}
    other = F.lit(None).cast("string")
    if altered:
        other = leaf([altered.get(c, plain[c]) for c in columns])
        other = other if where is None else F.when(where, other)
    name = F.col(f"`{part_col}`").cast("string")
    leaves = docs.select(
        F.when(name.isNull(), "").otherwise(F.concat(F.lit("="), name)).alias("part"),
        F.col(f"`{id_col}`").cast("long").alias("id"), leaf(list(plain.values())).alias("digest"), other.alias("other"),
    )
    leaves = shelf.put(leaves, "leaves")  # dealing by ranges reads its input twice: these rows, not the texts
    layers = _grow(shelf, _place(shelf, leaves, ["id", "digest", "other"], "leaf"), "leaf", stride)
    shelf.drop("leaves")
    heights = layers[0].where("idx = 0").select("part", "height")
    roots = _finished(layers, stride).withColumnRenamed("part", "name")
    upper = roots.select(F.lit("").alias("part"), "name", "digest")
    upper = _grow(shelf, _place(shelf, upper, ["name"], "top"), "top", stride)
    root = _finished(upper, stride).select("part", F.col("digest").alias("root"))
    start = upper[0].where("idx = 0").select("part", "height").join(root, "part")
    start = start.select("part", "height", F.lit("").alias("path"), F.lit("").alias("subroot"), "root")
    numbered = [upper[0].withColumn("id", F.col("idx")).withColumn("other", F.lit(None).cast("string")), *upper[1:]]
    found = _paths(shelf, numbered, start, "top", stride, whole=True)
    found = found.select(F.col("id").alias("idx"), F.col("leaf").alias("subroot"), "root", F.col("proof").alias("path"))
    tops = upper[0].select("idx", F.col("name").alias("part")).join(found, "idx").drop("idx").join(heights, "part")
    return Manifest(shelf, layers, shelf.put(tops, "tops"), stride)


def prove(manifest: Manifest, whole: bool = True) -> DataFrame:
    """For each leaf id, ``leaf``, ``subroot``, ``root``, ``proof`` and ``folded``: the root that the row leads to.

    A proof lists the siblings from the leaf to the root, each after ``L`` or ``R`` for its side, ``-`` where a node
    has none, joined by commas; without ``whole`` it is the digest of the siblings in that order.
    """
    return _paths(manifest.shelf, manifest.layers, manifest.tops, "leaf", manifest.stride, whole)


def audit(
    docs: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", part_col: str = "lang",
    altered: dict[str, Column] | None = None, where: Column | None = None, stride: int = STRIDE,
) -> DataFrame:
    """Build the manifest of ``docs`` and verify every row, or what ``altered`` makes of it, against it.

    One row per input row: id, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``. Of
    rows that are equal one may not be told from the other; an empty table gives no rows. See :func:`build`.
    """
    proved = prove(build(docs, columns, id_col, part_col, altered, where, stride), whole=False)
    return proved.select(
        F.col("id").alias(id_col), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )
