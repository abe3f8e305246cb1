"""Near-duplicate embeddings: spherical k-means cells and blocked cosine products within them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.components import components
from tablekit.llm.store import Shelf

#: Least cosine of a link.
THRESHOLD = 0.9
#: Vectors for each cell on average; cells and training vectors are bounded by the next two.
PER_CELL = 2000
MOST_CELLS = 8192
SAMPLE = 65_536
#: A vector is a guest in its nearest cells, at most so many, whose cosine is within the margin of its own cell's.
PROBES = 6
MARGIN = 0.2
#: Rows of a block; a pair of blocks is one task's unit of work.
BLOCK = 4096


def normalised(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are usable, and these with length 1 in double precision.

    Null and empty vectors, those with null or non-finite components, those of length 0 and those whose number of
    components differs from the first usable one's are not usable.
    """
    rows, good = [], np.zeros(len(column), bool)
    width = None
    for k, value in enumerate(column):
        if not value.is_valid or not len(value.values) or value.values.null_count:
            continue
        row = np.asarray(value.values, np.float64)
        if not np.isfinite(row).all() or not row.any() or (width is not None and len(row) != width):
            continue
        width, good[k] = len(row), True
        rows.append(row / np.abs(row).max())
    matrix = np.array(rows).reshape(len(rows), width or 0)
    return good, matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)


def kmeans(x: np.ndarray, cells: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Spherical k-means: unit centroids that are the directions of their members' sums; empty cells are reseeded."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(cells, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([(part @ centres.T).argmax(1) for part in np.array_split(x, max(1, len(x) // 4096))])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        empty = np.linalg.norm(sums, axis=1) < 1e-9
        sums[empty] = x[rng.choice(len(x), int(empty.sum()))]
        centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centres


def _read(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Usable vectors with a digest of their direction; others with a null digest."""
    for batch in batches:
        good, x = normalised(batch.column(1))
        if x.shape[1] != width:
            good[:] = False
        keys, vectors, at = [], [], 0
        for ok in good:
            if ok:
                raw = (x[at] + 0.0).tobytes()
                keys.append(hashlib.blake2b(raw, digest_size=16).digest())
                vectors.append(raw)
                at += 1
            else:
                keys.append(None)
                vectors.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())], names=["id", "key", "x"]
        )


def _cells(batches: Iterator[pa.RecordBatch], centres: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for the home cell of each vector and one for each cell it is a guest in."""
    width = centres.shape[1]
    for batch in batches:
        x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float64).reshape(-1, width)
        for low in range(0, len(x), 2048):
            part = x[low : low + 2048]
            near = part @ centres.T
            probes = min(PROBES, near.shape[1])
            top = np.argpartition(-near, probes - 1, axis=1)[:, :probes]
            value = np.take_along_axis(near, top, 1)
            order = np.argsort(-value, axis=1, kind="stable")
            top, value = np.take_along_axis(top, order, 1), np.take_along_axis(value, order, 1)
            used = value >= value[:, :1] - MARGIN
            row, rank = np.nonzero(used)
            lists = [top[k][used[k]].astype(np.int32) for k in range(len(part))]
            rows = pa.array(low + row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(top[row, rank].astype(np.int32)), pa.array(top[row, 0].astype(np.int32)),
                 batch.column("key").take(rows), batch.column("n").take(rows), batch.column("x").take(rows),
                 pa.array([lists[k] for k in row], pa.list_(pa.int32()))],
                names=["cell", "home", "key", "n", "x", "probes"],
            )


def _compare(key: tuple, table: pa.Table, threshold: float) -> pa.Table:
    """Links of one pair of blocks: how many for each vector, and edges to the least vector linked with it.

    The left block holds vectors at home in the cell, the right one any of its vectors. A link between vectors
    that both cells see is counted in the smaller one.
    """
    cell = key[0].as_py()
    keys = np.array(table["key"].to_pylist(), "S16") if table.num_rows else np.zeros(0, "S16")
    raw = table["key"].to_pylist()
    n, home = table["n"].to_numpy(), table["home"].to_numpy()
    side = table["side"].to_numpy()
    x = np.frombuffer(b"".join(table["x"].to_pylist()), np.float64).reshape(table.num_rows, -1)
    probes = [set(p) for p in table["probes"].to_pylist()]
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    links, label = np.zeros(len(keys), np.int64), np.arange(len(keys))
    owners: dict[bytes, int] = {}
    for k, each in enumerate(raw):
        label[k] = owners.setdefault(each, k)
    for low in range(0, len(left), 512):
        rows = left[low : low + 512]
        close = x[rows] @ x[right].T >= threshold
        a, b = np.nonzero(close)
        a, b = rows[a], right[b]
        # Not itself; a guest only once, in the smaller cell if both see the pair.
        fresh = np.array(
            [raw[i] != raw[j] and (home[j] == cell or cell < home[j] or int(home[j]) not in probes[i]) for i, j in zip(a, b)],
            bool,
        )
        a, b = a[fresh], b[fresh]
        np.add.at(links, a, n[b])
        guest = home[b] != cell
        np.add.at(links, b[guest], n[a[guest]])
        while len(a):  # join the roots of all that are linked, also those of earlier rows
            one, two = label[a], label[b]
            if (one == two).all():
                break
            np.minimum.at(label, np.maximum(one, two), np.minimum(one, two))
            while (label != label[label]).any():
                label = label[label]
    moved = (links > 0) | (label != np.arange(len(keys)))
    rows = np.flatnonzero(moved)
    return pa.table(
        {"key": pa.array([raw[k] for k in rows], pa.binary()), "links": pa.array(links[rows]),
         "root": pa.array([raw[label[k]] for k in rows], pa.binary())}
    )


def dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id`` and ``kept`` (the component's least id).

    Vectors link whose cosine in double precision is at least ``threshold``. Every vector is indexed: it is at
    home in its nearest cell and a guest in a few more; all vectors at home in a cell are compared with all in it.
    Links between vectors neither of which is a guest in the other's cell are missed (see the measured recall in
    the README). Equal directions are one vector with a count, so copies cost nothing. Vectors that are null, empty,
    zero, hold null or non-finite components, or have another number of components than most, link with nothing; a
    null id counts as greater than any other and rows with a repeated id are rows of their own. An empty table gives
    no rows. Centroids are fitted on at most ``SAMPLE`` vectors.
    """
    spark = vectors.sparkSession
    shelf = Shelf(spark, "vectors")
    source = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("v"))
    usual = source.where("v IS NOT NULL AND size(v) > 0").groupBy(F.size("v").alias("w")).count()
    usual = usual.orderBy(F.desc("count"), "w").limit(1).collect()
    width = usual[0]["w"] if usual else 1
    source = source.select("id", F.when(F.size("v") == width, F.col("v")).alias("v"))
    rows = shelf.put(source.mapInArrow(lambda b: _read(b, width), "id bigint, key binary, x binary"), "rows")
    usable = rows.where("key IS NOT NULL")
    # Minima and counts are combined before the shuffle: copies of a vector meet as one row for each task.
    unique = usable.groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"), F.min("x").alias("x"))
    unique = shelf.put(unique, "unique")
    total = unique.count()
    cells = max(1, min(MOST_CELLS, total // PER_CELL))
    sample = unique.orderBy(F.xxhash64("key"), "key").limit(min(SAMPLE, max(1000, 64 * cells))).select("x").collect()
    x = np.frombuffer(b"".join(bytes(r[0]) for r in sample), np.float64).reshape(-1, width)
    centres = kmeans(x, cells) if len(x) else np.zeros((1, width))
    handle = spark.sparkContext.broadcast(centres)
    kinds = "cell int, home int, key binary, n bigint, x binary, probes array<int>"
    placed = unique.select("key", "n", "x").mapInArrow(lambda b: _cells(b, handle.value), kinds)
    placed = shelf.put(placed, "placed")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    blocked = placed.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    right = blocked.select("*", every.alias("i"), F.col("block").alias("j"), F.lit(1).alias("side"))
    left = blocked.where("home = cell").select("*", F.col("block").alias("i"), every.alias("j"), F.lit(0).alias("side"))
    tasks = left.unionByName(right).select("cell", "i", "j", "side", "home", "key", "n", "x", "probes")
    found = tasks.groupBy("cell", "i", "j").applyInArrow(
        lambda key, table: _compare(key, table, threshold), "key binary, links bigint, root binary"
    )
    found = shelf.put(found, "found")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")), "vector-components")
    groups = unique.select("key", "least", "n").join(links, "key", "left")
    groups = groups.join(roots.withColumnRenamed("node", "key"), "key", "left")
    groups = groups.select("key", "least", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "key").alias("root"))
    groups = shelf.put(groups, "groups")
    least = groups.groupBy("root").agg(F.min("least").alias("component"))
    groups = shelf.put(groups.join(least, "root").select("key", "n", "links", "component"), "named")
    shelf.drop("placed", "found")
    out = rows.select("id", "key").join(groups, "key", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col), (F.coalesce(F.col("links") + F.col("n") - 1, F.lit(0))).alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
    )
