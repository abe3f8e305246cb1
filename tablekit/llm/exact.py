"""Exact deduplication by Grace hashing: partition, spill, and compare complete texts in open-addressing tables."""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.store import Shelf

#: A bucket's table may hold so many bytes of distinct texts before the rest of the bucket is spilled.
TABLE_BYTES = 64 << 20
#: A spilled bucket is dealt to so many files.
FAN_OUT = 16


class Table:
    """Open addressing with linear probing over distinct texts; equal hashes compare complete contents."""

    def __init__(self, slots: int = 1 << 10) -> None:
        self.slots = np.full(slots, -1, np.int64)
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.bytes = 0

    def find(self, code: int, text: bytes) -> int:
        """The entry of a text, or -1."""
        mask = len(self.slots) - 1
        at = code & mask
        while (entry := int(self.slots[at])) >= 0:
            if self.hashes[entry] == code and self.texts[entry] == text:
                return entry
            at = (at + 1) & mask
        return -1

    def add(self, code: int, text: bytes) -> int:
        """Enter a text that is not there."""
        if 2 * (len(self.texts) + 1) > len(self.slots):
            self.slots = np.full(2 * len(self.slots), -1, np.int64)
            for entry, old in enumerate(self.hashes):
                self._place(old, entry)
        self.hashes.append(code)
        self.texts.append(text)
        self.bytes += len(text) + 100
        self._place(code, len(self.texts) - 1)
        return len(self.texts) - 1

    def _place(self, code: int, entry: int) -> None:
        mask = len(self.slots) - 1
        at = code & mask
        while self.slots[at] >= 0:
            at = (at + 1) & mask
        self.slots[at] = entry


def _code(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text)


_LOCAL = pa.schema(
    [("rid", pa.int64()), ("id", pa.int64()), ("rep", pa.int64()), ("n", pa.int64()), ("top", pa.int64()),
     ("top_rid", pa.int64()), ("sha", pa.string()), ("code", pa.int64()), ("text", pa.binary())]
)
_LOCAL_DDL = (
    "rid bigint, id bigint, rep bigint, n bigint, top bigint, top_rid bigint, sha string, code bigint, text binary"
)


def _signed(code: int) -> int:
    return code - (1 << 64) if code >= 1 << 63 else code


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the first row of the task that has the same text; those carry the text and its group's sums.

    The table is emptied when it is full, so a text may have several first rows in a task.
    """
    table, owners, rows = Table(), [], []

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal table, owners, rows
        digests = [hashlib.sha256(t).hexdigest() for t in table.texts]
        for low in range(0, len(rows), 1024):
            part = rows[low : low + 1024]
            out = []
            for rid, ident, entry in part:
                first, n, top, top_rid = owners[entry]
                own = first == rid
                out.append(
                    (rid, ident, first, n if own else None, top if own else None, top_rid if own else None,
                     digests[entry], _signed(table.hashes[entry]), table.texts[entry] if own else None)
                )
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _LOCAL)], schema=_LOCAL)
        table, owners, rows = Table(), [], []

    for batch in batches:
        for rid, ident, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            text = text.as_buffer().to_pybytes() if text.is_valid else b""
            code = _code(text)
            entry = table.find(code, text)
            if entry < 0:
                entry = table.add(code, text)
                owners.append([rid, 0, None, rid])
            own = owners[entry]
            own[1] += 1
            if ident is not None and (own[2] is None or ident > own[2]):
                own[2], own[3] = ident, rid
            rows.append((rid, ident, entry))
            if table.bytes > TABLE_BYTES or len(rows) >= 1 << 17:
                yield from flush()
    yield from flush()


_GROUPS = pa.schema(
    [("rep", pa.int64()), ("keep_id", pa.int64()), ("keep_rid", pa.int64()), ("group_size", pa.int64())]
)


def _grace(records: Iterator[tuple], level: int, folder: str) -> Iterator[pa.RecordBatch]:
    """Resolve one bucket: insert into a table while it has room, spill the rest by other bits of the hash."""
    table, groups, members, files, size = Table(), [], [], {}, [0] * FAN_OUT
    for rep, n, top, top_rid, code, text in records:
        unsigned = code & (1 << 64) - 1
        entry = table.find(unsigned, text)
        if entry < 0 and table.texts and table.bytes + len(text) > TABLE_BYTES:
            part = xxhash.xxh64_intdigest(unsigned.to_bytes(8, "little"), seed=level + 1) % FAN_OUT
            if part not in files:
                files[part] = open(os.path.join(folder, f"{level}-{part}-{os.urandom(4).hex()}.spill"), "w+b")
            head = np.array([rep, n, top or 0, top_rid, code, len(text), top is None], np.int64).tobytes()
            files[part].write(head + text)
            size[part] += 1
            continue
        if entry < 0:
            entry = table.add(unsigned, text)
            groups.append([0, None, None])
        own = groups[entry]
        own[0] += n
        if own[2] is None or (top is not None and (own[1] is None or top > own[1])):
            own[1], own[2] = top, top_rid
        members.append((rep, entry))
    for low in range(0, len(members), 10_000):
        part = members[low : low + 10_000]
        columns = [
            [rep for rep, _ in part], [groups[e][1] for _, e in part], [groups[e][2] for _, e in part],
            [groups[e][0] for _, e in part],
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_GROUPS)
    del table, groups, members
    for spilled in files.values():

        def stored(file=spilled) -> Iterator[tuple]:
            file.seek(0)
            while head := file.read(56):
                rep, n, top, top_rid, code, length, none = np.frombuffer(head, np.int64).tolist()
                yield rep, n, None if none else top, top_rid, code, file.read(length)

        yield from _grace(stored(), level + 1, folder)
        spilled.close()
        os.unlink(spilled.name)


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def records() -> Iterator[tuple]:
        for batch in batches:
            plain = [batch.column(i).to_pylist() for i in range(5)]
            for *values, text in zip(*plain, batch.column(5)):
                yield *values, text.as_buffer().to_pybytes()

    with tempfile.TemporaryDirectory() as folder:  # this task's own spill files, deleted with it
        yield from _grace(records(), 0, folder)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of equal texts: one row per input row.

    Returns id, ``keep_id`` (largest id of the rows with the same text), ``group_size``, ``kept`` (one row of the
    group, with that id) and ``text_sha256``. Texts are equal when identical byte for byte; a null text counts
    as empty, a null id as smaller than any other. Of rows repeated with the same id and text one is kept. An
    empty table gives no rows. Other columns are ignored.

    Equal texts are first combined in each task, so a text reaches the shuffle once for each task that holds
    it, however many copies there are; rows keep a pointer to their task's first copy, and only these pointers
    are joined with the groups, so no join key is hot. First copies are dealt by hash; a task keeps distinct
    texts in an open-addressing table of at most ``TABLE_BYTES`` and spills what does not fit to files by other
    bits of the hash, again and again, until each fits. Tables compare complete contents, hashes decide nothing.
    """
    spark = docs.sparkSession
    shelf = Shelf(spark, "exact")
    source = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{text_col}`").cast("binary").alias("text"),
    )
    local = shelf.put(source.mapInArrow(_combine, _LOCAL_DDL), "local")
    firsts = local.where("text IS NOT NULL").select("rep", "n", "top", "top_rid", "code", "text")
    dealt = firsts.repartition(F.col("code"))
    groups = dealt.mapInArrow(_resolve, "rep bigint, keep_id bigint, keep_rid bigint, group_size bigint")
    groups = shelf.put(groups, "groups")
    rows = local.select("rid", "id", "rep", "sha").join(groups, "rep")
    return rows.select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
