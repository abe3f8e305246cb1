"""Packing token sequences by length patterns fitted with non-negative least squares."""

from __future__ import annotations

import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablekit.llm.store import Shelf

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
#: Lengths are grouped in so many classes when patterns are enumerated and fitted.
CLASSES = 128
#: Encoded words a worker remembers; the memory is emptied when full.
REMEMBERED = 400_000

class Encoder:
    """Ids of texts under a tokenizer that drops white space and lower-cases.

    Such a tokenizer never joins what white space parts, so each distinct stretch between spaces is encoded once.
    Plain stretches (code points below U+0100) go to the tokenizer's own model word by word; any others, and those
    that may hold a special token, go through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in shown)}
        self.letters = {b: hidden.get(b, b) for b in range(256)}
        self.marks = tuple({t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.plain = not any(mark.isalpha() for mark in self.marks)  # then no special token in letters alone
        self.words: dict[str, bytes] = {}
        self.stretches: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            shown = word.encode().decode("latin-1").translate(self.letters)
            ids = struct.pack(f"<{len(found := self.tokenize(shown))}I", *[t.id for t in found])
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            self.words[word] = ids
        return ids

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def stretch(self, text: str) -> bytes:
        if not text.isascii() and max(text) > "\xff":
            return self.whole(text)
        low = text.lower()
        if low.isalpha() and self.plain:
            return self.word(low)
        if not text or any(mark in text for mark in self.marks):
            return self.whole(text)
        if low[-1] in ".," and low[:-1].isalpha():
            return self.word(low[:-1]) + self.word(low[-1])
        return b"".join(map(self.word, self.split.findall(low)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        known, parts = self.stretches, text.replace("\n", " ").split(" ")
        ids = list(map(known.get, parts))
        if None in ids:
            if len(known) + len(parts) > REMEMBERED:
                known.clear()
            for k, part in enumerate(parts):
                if ids[k] is None:
                    found = known.get(part)
                    if found is None:
                        known[part] = found = self.stretch(part)
                    ids[k] = found
        return b"".join(ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(path)


_PIECES = (
    "rid bigint, task bigint, rank bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
)


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
    capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False,
) -> DataFrame:
    """Each text's ids and an end id, cut into pieces of ``capacity`` ids; the last may be shorter.

    A null text counts as empty and gives one piece, the end id. Besides the piece, its first id's place, length
    and crc32, rows have the task that made them and their number among the task's pieces of that length, from
    which global numbers follow without sorting. ``with_ids`` adds the ids.
    """
    path = public_tokenizers.path(vocabulary) if "/" not in vocabulary else vocabulary
    end = np.array([end_id], "<u4").tobytes()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, seen = encoder(path), defaultdict(int)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part, out, ids_out = batch.slice(low, 256), [], []
                for rid, ident, text in zip(*(column.to_pylist() for column in part.columns)):
                    ids = coder.encode(text or "") + end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        length = len(own) // 4
                        out.append((rid, rid >> 33, seen[length], ident, k, at // 4, length, zlib.crc32(own)))
                        seen[length] += 1
                        if with_ids:
                            ids_out.append(np.frombuffer(own, "<u4").astype(np.int32))
                columns = [pa.array(c, pa.int32() if n == 4 else pa.int64()) for n, c in enumerate(zip(*out))]
                names = [f.split()[0] for f in _PIECES.split(", ")]
                if with_ids:
                    columns.append(pa.array(ids_out, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    source = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{text_col}`").alias("text"),
    )
    return source.mapInArrow(apply, _PIECES + (", ids array<int>" if with_ids else ""))


def patterns(classes: int, present: np.ndarray) -> list[tuple[int, ...]]:
    """All multisets of two or three present classes that add up to all ``classes`` units."""
    have = set(np.flatnonzero(present).tolist())
    out = [(a, classes - a) for a in have if classes - a in have and a >= classes - a]
    for a in have:
        for b in have:
            c = classes - a - b
            if a >= b >= c > 0 and c in have:
                out.append((a, b, c))
    return sorted(out, reverse=True)


def nnls(columns: list[tuple[int, ...]], target: np.ndarray) -> np.ndarray:
    """Non-negative repeat counts of the patterns that fit the histogram best in squares (active set method)."""
    matrix = np.zeros((len(target), len(columns)))
    for j, pattern in enumerate(columns):
        for c in pattern:
            matrix[c, j] += 1
    x, active = np.zeros(len(columns)), np.zeros(len(columns), bool)
    scale = max(1.0, float(target.max(initial=0)))
    goal = target / scale
    for _ in range(3 * len(target)):
        slope = matrix.T @ (goal - matrix @ x)
        slope[active] = -np.inf
        j = int(slope.argmax()) if len(slope) else 0
        if not len(slope) or slope[j] <= 1e-9:
            break
        active[j] = True
        while True:
            fitted = np.zeros(len(columns))
            fitted[active] = np.linalg.lstsq(matrix[:, active], goal, rcond=None)[0]
            low = active & (fitted <= 1e-12)
            if not low.any():
                x = fitted
                break
            step = np.min(x[low] / np.maximum(x[low] - fitted[low], 1e-12))
            x = x + step * (fitted - x)
            active &= x > 1e-12
            x[~active] = 0
            if not active.any():
                break
    return x * scale


def plan(histogram: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Which lengths share a sequence, and how often, for all pieces of a histogram of lengths.

    Patterns of classes of lengths are fitted to the histogram and their counts rounded down. A pattern takes its
    longer pieces from their classes and its last from the length that fills the sequence best. What remains is
    packed by best fit, longest first, into the room that is left and new sequences. Only counts are handled, so the
    work depends on the capacity and not on the number of pieces.
    """
    left = histogram.astype(np.int64).copy()
    made: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        made.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    width = max(1, capacity // CLASSES)
    classes = capacity // width
    group = np.minimum(-(-np.arange(capacity + 1) // width), classes)
    sizes = np.bincount(group, weights=left, minlength=classes + 1)
    kinds = patterns(classes, sizes > 0)
    repeats = np.floor(nnls(kinds, sizes) + 1e-6).astype(np.int64) if kinds else []

    def longest(low: int, high: int) -> int:
        """The longest length that is left within bounds, or 0."""
        if high < low:
            return 0
        found = np.flatnonzero(left[low : high + 1])
        return low + int(found[-1]) if len(found) else 0

    open_room: dict[int, list[list]] = defaultdict(list)  # room left: [lengths, count]

    def close(lengths: tuple[int, ...], count: int) -> None:
        room = capacity - sum(lengths)
        if room:
            open_room[room].append([lengths, count])
        else:
            made.append((lengths, count))

    for kind, count in zip(kinds, repeats):
        count = int(count)
        while count > 0:
            lengths: tuple[int, ...] = ()
            for c in kind[:-1]:
                taken = longest((c - 1) * width + 1, c * width)
                if not taken:
                    break
                lengths += (taken,)
                left[taken] -= 1
            for taken in lengths:
                left[taken] += 1
            if len(lengths) < len(kind) - 1:
                break
            uses = defaultdict(int)
            for taken in lengths:
                uses[taken] += 1
            if any(left[k] < n for k, n in uses.items()):
                break
            for k, n in uses.items():
                left[k] -= n
            last = longest(max(1, (kind[-1] - 1) * width + 1), capacity - sum(lengths))
            for k, n in uses.items():
                left[k] += n
            if not last:
                break
            lengths += (last,)
            uses[last] += 1
            times = min([count, *(int(left[k]) // n for k, n in uses.items())])
            if not times:
                break
            for k, n in uses.items():
                left[k] -= n * times
            close(lengths, times)
            count -= times
    for length in range(capacity, 0, -1):
        count = int(left[length])
        while count:
            room = min((r for r in open_room if r >= length), default=None)
            if room is None:
                per = min(capacity // length, count)
                close((length,) * per, count // per)
                count -= per * (count // per)
                continue
            entry = open_room[room][-1]
            times = min(count, entry[1])
            entry[1] -= times
            if not entry[1]:
                open_room[room].pop()
                if not open_room[room]:
                    del open_room[room]
            close((*entry[0], length), times)
            count -= times
    for room in open_room.values():
        made += [(lengths, count) for lengths, count in room]
    return made


def slots(made: list[tuple[tuple[int, ...], int]], capacity: int) -> np.ndarray:
    """For each length, runs of its pieces' numbers: length, first number, first sequence, offset, step; sorted.

    Piece ``n`` of a run that begins at ``f`` lies in sequence ``s + n - f`` at the run's offset.
    """
    used, rows, sequence = np.zeros(capacity + 1, np.int64), [], 0
    for lengths, count in made:
        offset = 0
        for length in lengths:
            rows.append((length, used[length], sequence, offset))
            used[length] += count
            offset += length
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def assign(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id`` and ``offset`` for pieces (``task``, ``rank``, ``length``), which must be a written table.

    Counts by task and length give each piece a number among the pieces of its length; the histogram of at most
    ``capacity`` lengths is all that reaches the driver, and the runs of the plan, a few for each length, all
    that is broadcast.
    """
    spark = parts.sparkSession
    counts = parts.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in parts.groupBy("length").count().collect():
        histogram[row[0]] = row[1]
    runs = slots(plan(histogram, capacity), capacity)
    handle = spark.sparkContext.broadcast(runs)
    names = [*parts.columns, "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = handle.value
        # Runs in order of (length, first number), as one number each.
        keys = (runs[:, 0] << 44) + runs[:, 1]
        for batch in batches:
            number = batch.column("number").to_numpy()
            at = np.searchsorted(keys, (batch.column("length").to_numpy() << 44) + number, side="right") - 1
            sequence = runs[at, 2] + number - runs[at, 1]
            columns = [*batch.columns[: len(names) - 2], pa.array(sequence), pa.array(runs[at, 3])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    numbered = parts.join(starts, ["length", "task"]).withColumn("number", F.col("rank") + F.col("base"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    chosen = numbered.select(*parts.columns, "number")
    return chosen.mapInArrow(place, f"{kinds}, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``capacity`` ids.

    Returns id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` and, if asked for,
    ``ids``. A null text counts as empty; ids may be null or repeated, each row is a document of its own; an empty
    table gives no rows; other columns are ignored.
    """
    parts = Shelf(docs.sparkSession, "packing").put(
        pieces(docs, id_col, text_col, capacity=capacity, with_ids=with_ids), "pieces"
    )
    placed = assign(parts, capacity).drop("rid", "task", "rank")
    names = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    return placed.select(F.col("doc_id").alias(id_col), *names)
