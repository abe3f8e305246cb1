"""Reversible line deduplication: sharded cuckoo filters backed by exact tables of reference counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.store import Shelf, text_bytes

#: Keys shorter than this many code points are never dropped.
LEAST_CHARS = 20
#: Keys in at least so many documents are dropped but for one document.
LEAST_DOCS = 3
#: Text bytes of a bucket of documents, and of the documents whose keys a shard holds, on average.
BUCKET_BYTES = 4 << 20
SHARD_BYTES = 16 << 20
#: Partitions of the shuffled documents at most, for each core of the session; a partition may hold many buckets.
PER_CORE = 16
_SPACE = b" \t\n\x0b\x0c\r"
_SLOTS = 4


class Cuckoo:
    """A cuckoo filter of 16-bit fingerprints, four to a bucket; keys are rows of two 64-bit hashes."""

    def __init__(self, capacity: int = 64, table: np.ndarray | None = None) -> None:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, capacity) / _SLOTS / 0.8))))
        self.table = np.zeros((buckets, _SLOTS), np.uint16) if table is None else table.copy()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = len(self.table) - 1
        prints = (keys[:, 1] & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (keys[:, 0] & np.uint64(mask)).astype(np.int64)
        return prints, first, self._other(first, prints)

    def _other(self, bucket, prints):
        jump = (np.asarray(prints, np.int64) * 0x5BD1E995) & 0x7FFFFFFF
        return bucket ^ (jump & (len(self.table) - 1))

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """False means absent for sure."""
        prints, first, second = self._places(keys)
        return ((self.table[first] == prints[:, None]) | (self.table[second] == prints[:, None])).any(1)

    def insert(self, keys: np.ndarray) -> bool:
        """Enter keys; false if the table is too full, and then it must be rebuilt larger."""
        prints, first, second = self._places(keys)
        waiting = np.arange(len(keys))
        for bucket in (first, second):
            for _ in range(_SLOTS):
                if not len(waiting):
                    return True
                at = bucket[waiting]
                room = (self.table[at] == 0).any(1)
                _, lead = np.unique(at, return_index=True)
                chosen = lead[room[lead]]
                if not len(chosen):
                    break
                rows = at[chosen]
                self.table[rows, (self.table[rows] == 0).argmax(1)] = prints[waiting[chosen]]
                keep = np.ones(len(waiting), bool)
                keep[chosen] = False
                waiting = waiting[keep]
        for k in waiting:  # move others to their second bucket
            print_, at = prints[k], int(second[k])
            for turn in range(500):
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = print_
                    break
                slot = turn % _SLOTS
                print_, self.table[at, slot] = self.table[at, slot], print_
                at = int(self._other(at, print_))
            else:
                return False
        return True

    def delete(self, keys: np.ndarray) -> None:
        """Remove one fingerprint for each key; all must have been inserted."""
        for print_, first, second in zip(*self._places(keys)):
            for at in (int(first), int(second)):
                found = np.flatnonzero(self.table[at] == print_)
                if len(found):
                    self.table[at, found[0]] = 0
                    break


@dataclass
class Shard:
    """Keys (two 64-bit hashes each, sorted) with the number of documents that hold them, and their filter."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros((0, 2), np.uint64))
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    filter: Cuckoo = field(default_factory=Cuckoo)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it is absent; the table is asked only about keys that pass the filter."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.keys):
            return out
        maybe = np.flatnonzero(self.filter.contains(keys))
        at = np.searchsorted(_joined(self.keys), _joined(keys[maybe]))
        at = np.minimum(at, len(self.keys) - 1)
        out[maybe] = np.where((self.keys[at] == keys[maybe]).all(1), at, -1)
        return out

    def change(self, keys: np.ndarray, counts: np.ndarray, sign: int = 1) -> None:
        """Add or take away documents of distinct keys; keys that no document holds any more leave both."""
        at = self.find(keys)
        known = at >= 0
        np.add.at(self.counts, at[known], sign * counts[known])
        if sign > 0 and not known.all():
            fresh = keys[~known]
            joined = np.concatenate([self.keys, fresh])
            order = np.argsort(_joined(joined), kind="stable")
            self.keys, self.counts = joined[order], np.concatenate([self.counts, counts[~known]])[order]
            room = 0.8 * self.filter.table.size
            if len(self.keys) > room or not self.filter.insert(fresh):
                capacity = 2 * len(self.keys)
                while True:
                    self.filter = Cuckoo(capacity)
                    if self.filter.insert(self.keys):
                        break
                    capacity *= 2
        gone = self.counts <= 0
        if gone.any():
            self.filter.delete(self.keys[gone])
            self.keys, self.counts = self.keys[~gone], self.counts[~gone]


def _joined(keys: np.ndarray) -> np.ndarray:
    """Keys as one value each that sorts like the pair."""
    return np.ascontiguousarray(keys.astype(">u8")).view("S16").ravel()


def key_of(line: bytes) -> bytes | None:
    """A line's key, or None if it has too few code points to count."""
    key = line.strip(_SPACE).lower()
    if len(key) < LEAST_CHARS:
        return None
    if not key.isascii() and len(key.decode()) < LEAST_CHARS:
        return None
    return key


def _code(key: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(key)
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


_KEYS = "bucket int, k1 bigint, k2 bigint, n bigint, top bigint"


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each bucket and key: number of documents and their largest id (null if none has one).

    Sums are given out when a task holds many, so a key may come several times.
    """
    sums: dict[tuple, list] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        rows = [(b, k1, k2, n, top) for (b, (k1, k2)), (n, top) in sums.items()]
        sums.clear()
        for low in range(0, len(rows), 50_000):
            columns = list(zip(*rows[low : low + 50_000]))
            arrays = [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])]
            yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "k1", "k2", "n", "top"])

    for batch in batches:
        for bucket, ident, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            for key in set(map(key_of, raw.split(b"\n"))):
                if key is None:
                    continue
                own = sums.setdefault((bucket, _code(key)), [0, None])
                own[0] += 1
                if ident is not None and (own[1] is None or ident > own[1]):
                    own[1] = ident
            if len(sums) > 400_000:
                yield from flush()
    yield from flush()


def partitions(buckets: int, cores: int) -> int:
    """Into how many partitions buckets are dealt: one each while they are few, else a number for each core."""
    return min(buckets, PER_CORE * max(1, cores))


def _arranged(docs: DataFrame, id_col: str, text_col: str, buckets: int, keep: tuple = ()) -> DataFrame:
    """Documents dealt to buckets by a hash of id and text, whatever lines they hold."""
    key, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")
    spread = F.pmod(F.xxhash64(key, text), F.lit(buckets)).cast("int")
    extra = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    rows = docs.select(spread.alias("bucket"), key.alias("id"), text.cast("binary").alias("text"), *extra)
    return rows.repartition(partitions(buckets, docs.sparkSession.sparkContext.defaultParallelism), "bucket")


def _reduced(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, their summed counts, and the distinct key of each row."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    sorted_ = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = (sorted_[1:] != sorted_[:-1]).any(1)
    at = np.cumsum(first) - 1
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = at
    return sorted_[first], np.bincount(at, weights=counts[order]).astype(np.int64), inverse


def _matrix(table: pa.Table) -> np.ndarray:
    return np.stack([table[c].to_numpy().view(np.uint64) for c in ("k1", "k2")], axis=1)


_STATE = "shard int, filter binary, keys binary, counts binary"


def _pack(shard: int, own: Shard) -> pa.Table:
    return pa.table(
        {"shard": pa.array([shard], pa.int32()), "filter": pa.array([own.filter.table.tobytes()], pa.binary()),
         "keys": pa.array([own.keys.tobytes()], pa.binary()), "counts": pa.array([own.counts.tobytes()], pa.binary())}
    )


def _unpack(state: pa.Table) -> Shard:
    if not state.num_rows:
        return Shard()
    row = state.to_pylist()[0]
    table = np.frombuffer(row["filter"], np.uint16).reshape(-1, _SLOTS)
    return Shard(
        np.frombuffer(row["keys"], np.uint64).reshape(-1, 2).copy(), np.frombuffer(row["counts"], np.int64).copy(),
        Cuckoo(table=table),
    )


def _sharded(sums: DataFrame, shards: int) -> DataFrame:
    return sums.withColumn("shard", F.pmod(F.col("k1"), F.lit(shards)).cast("int"))


def update(state: DataFrame | None, docs: DataFrame, shards: int, sign: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The state after documents came (``sign`` 1) or went (-1): one row for each shard that ever held keys.

    ``shards`` must stay the same over a state's life. A document must be deleted with the text it came with.
    Deleting all that was inserted leaves empty tables and empty filters.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.lit(0).alias("bucket"), F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{text_col}`").cast("binary").alias("text"),
    )
    sums = _sharded(rows.mapInArrow(_keys, _KEYS), shards)

    def apply(key: tuple, old: pa.Table, new: pa.Table) -> pa.Table:
        own = _unpack(old)
        if new.num_rows:
            keys, counts, _ = _reduced(_matrix(new), new["n"].to_numpy())
            own.change(keys, counts, sign)
        return _pack(key[0].as_py(), own)

    if state is None:
        state = spark.createDataFrame([], _STATE)
    grouped = state.groupBy("shard").cogroup(sums.groupBy("shard"))
    return Shelf(spark, "lines").put(grouped.applyInArrow(apply, _STATE), "state")


def _decide(key: tuple, old: pa.Table, new: pa.Table, learn: bool, least_docs: int) -> pa.Table:
    """Keys to drop in each bucket, with the id of the document that keeps them."""
    own = _unpack(old)
    names = {"bucket": pa.int32(), "k1": pa.int64(), "k2": pa.int64(), "keep": pa.int64()}
    if not new.num_rows:
        return pa.table({n: pa.array([], t) for n, t in names.items()})
    keys, counts, inverse = _reduced(_matrix(new), new["n"].to_numpy())
    if learn:
        own.change(keys, counts)
    at = own.find(keys)
    often = np.zeros(len(keys), bool)
    often[at >= 0] = own.counts[at[at >= 0]] >= least_docs
    top = new["top"]
    has = top.is_valid().to_numpy()
    value = np.where(has, top.fill_null(0).to_numpy(), np.iinfo(np.int64).min)
    best = np.full(len(keys), np.iinfo(np.int64).min)
    np.maximum.at(best, inverse, value)
    rows = np.flatnonzero(often[inverse])
    kept = best[inverse[rows]]
    return pa.table(
        {"bucket": new["bucket"].take(rows), "k1": new["k1"].take(rows), "k2": new["k2"].take(rows),
         "keep": pa.array(kept, pa.int64(), mask=kept == np.iinfo(np.int64).min)}
    )


def dedup(
    docs: DataFrame, state: DataFrame | None = None, shards: int | None = None, id_col: str = "doc_id",
    text_col: str = "text", keep: tuple = (), least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """Documents without their repeated lines: id, ``n_lines``, ``n_dropped``, ``kept_text`` and columns ``keep``.

    Texts are split at newlines; a null or empty text is one empty line. A key is the line without white space at
    its ends, A-Z lower-cased. Keys of ``LEAST_CHARS`` code points or more that ``least_docs`` documents hold lose
    all their lines except in the document with the largest id. With ``state`` (of :func:`update`, with its
    ``shards``) documents are counted there; without, the given documents are counted. Each row is a document;
    rows repeated with the largest id all keep the line. A null id is smaller than any other. An empty table gives
    no rows.

    Documents are dealt to buckets by a hash. A bucket's task adds up its keys, so a line that a third of all
    documents hold reaches its shard once for each bucket. A shard inserts keys in its cuckoo filter and exact
    table, and tells buckets which keys go. The buckets, shuffled once for both passes, then rebuild their texts.
    """
    size = text_bytes(docs, text_col)
    buckets = max(1, -(-size // BUCKET_BYTES))
    shards = shards or max(1, -(-size // SHARD_BYTES))
    rows = _arranged(docs, id_col, text_col, buckets, keep)
    # All columns are read here too: both passes then read one shuffle of the documents.
    sums = _sharded(rows.mapInArrow(_keys, _KEYS), shards)
    learn = state is None
    if state is None:
        state = docs.sparkSession.createDataFrame([], _STATE)
    drops = state.groupBy("shard").cogroup(sums.groupBy("shard")).applyInArrow(
        lambda key, old, new: _decide(key, old, new, learn, least_docs), "bucket int, k1 bigint, k2 bigint, keep bigint"
    )
    extra = len(keep)

    def rebuild(key: tuple, docs: pa.Table, drops: pa.Table) -> pa.Table:
        gone = dict(zip(zip(drops["k1"].to_pylist(), drops["k2"].to_pylist()), drops["keep"].to_pylist()))
        n_lines, n_dropped, texts = [], [], []
        for ident, text in zip(docs["id"].to_pylist(), docs["text"]):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            lines = raw.split(b"\n")
            left = lines
            if gone:
                left = []
                for line in lines:
                    key = key_of(line)
                    code = None if key is None else _code(key)
                    if code is None or code not in gone or gone[code] == ident:
                        left.append(line)
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(left))
            texts.append(b"\n".join(left).decode())
        columns = [docs["id"], pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.string())]
        names = ["id", "n_lines", "n_dropped", "kept_text", *(f"k{i}" for i in range(extra))]
        return pa.table([*columns, *(docs[f"k{i}"] for i in range(extra))], names=names)

    kinds = "".join(f", k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    done = rows.groupBy("bucket").cogroup(drops.groupBy("bucket")).applyInArrow(
        rebuild, f"id bigint, n_lines bigint, n_dropped bigint, kept_text string{kinds}"
    )
    return done.toDF(id_col, "n_lines", "n_dropped", "kept_text", *keep)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`dedup` with a digest in place of the kept text."""
    kept = dedup(docs, id_col=id_col, text_col=text_col)
    return kept.select(id_col, "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
