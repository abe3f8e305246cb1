"""How filters interact: every order of a set of filters, with copies found by radix tries over ranges of texts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablekit.llm.store import Shelf

#: Texts that begin alike are dealt together while they weigh at most so many bytes; else a longer beginning decides.
RANGE_BYTES = 32 << 20
#: A text's weight beside its bytes: a node and its lists.
NODE_BYTES = 512
#: Bytes of the first beginning; each further one is GROWTH times as long.
FIRST, GROWTH = 8, 4
#: A task gives its trie's texts on and begins another one beyond so many bytes.
TRIE_BYTES = 48 << 20

# Filters by letter, in the order of their bits, and their thresholds.
LETTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 100, 80, 10, b"#$%&*|"
COPY = 1 << LETTERS.index("E")

_CAPITALS = bytes(range(65, 91))
_CONTINUED = bytes(range(128, 192))


def failures(text: bytes) -> int:
    """Bits of the filters A to D that a UTF-8 text fails."""
    words = text.split()  # bytes split at exactly [\x20\x09-\x0D]
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _CONTINUED))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * capitals > CAPITAL_PERCENT * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def _common(edge: bytes, text: bytes, at: int) -> int:
    """How many bytes an edge has in common with a text from ``at`` on, by halving; less than the whole edge."""
    low, high = 0, min(len(edge), len(text) - at) + 1
    while high - low > 1:
        middle = (low + high) // 2
        if edge[low:middle] == text[at + low : at + middle]:
            low = middle
        else:
            high = middle
    return low


class Node:
    """A node of a compressed trie: the bytes on its edge, its children by first byte, and a terminal's records."""

    __slots__ = ("edge", "children", "least", "records")

    def __init__(self, edge: bytes) -> None:
        self.edge, self.children, self.least, self.records = edge, {}, None, None


class Trie:
    """Complete texts by shared beginnings; a terminal holds the minimum id of its text and records kept with it."""

    def __init__(self) -> None:
        self.root, self.bytes = Node(b""), 0

    def insert(self, text: bytes) -> Node:
        """The terminal of a text; its ``records`` are None if it is new."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.bytes += len(text) - at + NODE_BYTES
                return child
            if not text.startswith(child.edge, at):
                shared = _common(child.edge, text, at)
                upper = node.children[text[at]] = Node(child.edge[:shared])
                child.edge = child.edge[shared:]
                upper.children[child.edge[0]] = child
                self.bytes += NODE_BYTES
                child = upper
            node, at = child, at + len(child.edge)
        return node

    def terminals(self) -> Iterator[tuple[bytes, Node]]:
        """All texts in bytewise order with their terminals."""
        stack = [(b"", self.root)]
        while stack:
            above, node = stack.pop()
            text = above + node.edge
            if node.records is not None:
                yield text, node
            stack.extend((text, node.children[k]) for k in sorted(node.children, reverse=True))


_LOCAL_DDL = "id bigint, part string, mask int, n bigint, text binary"
_LOCAL = pa.schema(
    [("id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64()), ("text", pa.binary())]
)
_DONE_DDL = "id bigint, part string, mask int, n bigint"


def _emit(rows: Iterator[tuple], width: int) -> Iterator[pa.RecordBatch]:
    """Rows as batches of at most 4096 rows and about 8 MB."""
    schema = pa.schema(list(_LOCAL)[:width])
    part, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)

    for row in rows:
        part.append(row)
        size += len(row[4] or b"") if width > 4 else 0
        if len(part) >= 4096 or size > 8 << 20:
            yield batch()
            part, size = [], 0
    if part:
        yield batch()


def _enter(node: Node, ident: int, held: dict) -> dict:
    """Keep what belongs to a terminal's minimum id; what does not is returned: it is a copy."""
    if node.records is None or ident < node.least:
        beaten, node.least, node.records = node.records, ident, dict(held)
        return beaten or {}
    if ident > node.least:
        return held
    for key, n in held.items():
        node.records[key] = node.records.get(key, 0) + n
    return {}


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Masks of a task's rows. Copies of a smaller id in the task are decided; minimum ids go on with their text.

    A row without an id is no copy of a larger one and makes none: it is decided too.
    """

    def rows() -> Iterator[tuple]:
        trie, masks = Trie(), {}

        def flush() -> Iterator[tuple]:
            for text, node in trie.terminals():
                for (part, mask), n in node.records.items():
                    yield node.least, part, mask, n, text

        for batch in batches:
            for ident, part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = text.as_buffer().to_pybytes() if text.is_valid else b""
                node = trie.insert(text)
                mask = masks.get(id(node))
                if mask is None:
                    mask = masks[id(node)] = failures(text)
                if ident is None:
                    yield None, part, mask, 1, None
                    continue
                last = node.least
                held = {(part, mask): 1}
                beaten = _enter(node, ident, held)
                copy = ident if beaten is held else last
                for (part, mask), n in beaten.items():
                    yield copy, part, mask | COPY, n, None
                if trie.bytes > TRIE_BYTES:
                    yield from flush()
                    trie, masks = Trie(), {}
        yield from flush()

    return _emit(rows(), 5)


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their copies marked; texts come in order of their keys, and equal texts have equal keys."""

    def rows() -> Iterator[tuple]:
        trie, last = Trie(), None

        def flush() -> Iterator[tuple]:
            for _, node in trie.terminals():
                for (ident, part, mask), n in node.records.items():
                    yield ident, part, mask | (COPY if ident > node.least else 0), n

        for batch in batches:
            plain = [batch.column(i).to_pylist() for i in (0, 1, 2, 3, 5, 6)]
            for ident, part, mask, n, head, tail, text in zip(*plain, batch.column(4)):
                if (head, tail) != last and trie.bytes > RANGE_BYTES // 4:
                    yield from flush()
                    trie = Trie()
                last = head, tail
                node = trie.insert(text.as_buffer().to_pybytes())
                if node.records is None:
                    node.least, node.records = ident, {}
                node.least = min(node.least, ident)
                key = (ident, part, mask)
                node.records[key] = node.records.get(key, 0) + n
        yield from flush()

    return _emit(rows(), 4)


def _keys(shelf: Shelf, pending: DataFrame, range_bytes: int) -> DataFrame:
    """``pending`` with a key that holds a bounded part of the texts: ``head`` and ``tail``.

    A text is dealt by its beginning of ``FIRST`` bytes, or by one so much longer that the texts which begin so weigh at
    most ``range_bytes`` (equal texts have equal beginnings, so copies meet). Beyond 32 bytes a beginning goes by its hash.
    Each round counts only texts whose shorter beginnings are all heavy. Heavy beginnings are at most
    one for each ``range_bytes`` of texts and round, 8 bytes each; Spark broadcasts them only while it finds them small.
    """
    weight = F.octet_length("text") + F.lit(NODE_BYTES)
    start = lambda size: F.substring("text", 1, size)
    size = FIRST
    keyed = pending.withColumn("size", F.lit(size))
    while True:
        light = keyed.where((F.col("size") == size) & (F.octet_length("text") > size))
        heavy = light.groupBy(F.xxhash64(start(size)).alias("start")).agg(F.sum(weight).alias("weight"))
        heavy = shelf.put(heavy.where(F.col("weight") > range_bytes).select("start"), f"heavy-{size}")
        if heavy.isEmpty():
            break
        longer = F.when(F.col("start").isNotNull() & (F.col("size") == size), size * GROWTH).otherwise(F.col("size"))
        keyed = keyed.withColumn("own", F.xxhash64(start(size))).join(heavy, F.col("own") == F.col("start"), "left")
        keyed = keyed.withColumn("size", longer).drop("own", "start")
        size *= GROWTH
    beginning = F.substring(F.col("text"), F.lit(1), F.col("size"))
    return keyed.withColumn("head", F.substring(beginning, 1, 4 * FIRST)).withColumn("tail", F.xxhash64(beginning)).drop("size")


def masks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Which filters rows fail: ``id, part, mask, n``, a bit for each letter; ``n`` rows are alike.

    A null text is empty, a null part the empty string. A row fails E if an equal text has a smaller id: of rows
    repeated with one id and text none does for the others, and rows without an id neither fail E nor make others
    fail. Texts are equal when identical byte for byte; complete texts are compared.

    Each task enters its texts in a radix trie whose terminals hold minimum ids. Any other id at a terminal is a copy,
    known at once; only minimum ids travel, with their text once for each task, dealt by ranges of their beginnings.
    There a trie for each run of keys gives the table's minimum ids and marks the rest.
    """
    shelf = Shelf(docs.sparkSession, "audit")
    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        F.col(f"`{text_col}`").cast("binary").alias("text"),
    )
    local = shelf.put(source.mapInArrow(_combine, _LOCAL_DDL), "local")
    keyed = _keys(shelf, local.where("text IS NOT NULL"), range_bytes)
    dealt = keyed.repartitionByRange("head", "tail").sortWithinPartitions("head", "tail")
    found = dealt.mapInArrow(_resolve, _DONE_DDL)
    return local.where("text IS NULL").drop("text").unionByName(found)


def interactions(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """What every order of the filters does, from ``part, mask, n, good, toxic``: a row for each part, order and step.

    ``kept`` rows are left after the step and ``removed`` ones go at it; ``redundant`` ones fail its filter but went
    earlier, ``unique_fails`` fail no other filter; ``good_lost`` and ``toxic_lost`` are those removed with such a label;
    ``shapley`` sums the filter's removed rows over all orders. A part has at most 2 ** filters rows here.
    """
    by_mask = counts.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    orders = F.lit(["".join(order) for order in permutations(letters)])
    each = by_mask.withColumn("filter_order", F.explode(orders))
    each = each.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    each = each.withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
    earlier = F.substring("filter_order", F.lit(1), F.col("step") - 1)
    bit = {c: F.lit(1 << k) for k, c in enumerate(letters)}
    own = sum((F.when(F.col("letter") == c, b).otherwise(0) for c, b in bit.items()), F.lit(0))
    before = sum((F.when(F.contains(earlier, F.lit(c)), b).otherwise(0) for c, b in bit.items()), F.lit(0))
    each = each.withColumn("own", own).withColumn("before", before)
    fails = F.col("mask").bitwiseAND(F.col("own")) > 0
    gone = F.col("mask").bitwiseAND(F.col("before")) > 0
    total = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(0)).cast("long")
    result = each.groupBy("part", "filter_order", "step", "letter").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"), total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter")).alias("shapley")
    return result.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", shapley
    )


def audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """:func:`interactions` of the filters A to E over all rows, those of each part counted on their own.

    ``labels`` (id, ``quality``, ``toxic``) may cover any rows and may repeat an id: a label counts if any of its
    rows has it; rows without an id have none. An empty table gives no rows. Other columns are ignored.
    """
    found = masks(docs, id_col, text_col, part_col, range_bytes)
    # Rows are counted before they meet labels, so a repeated id is a few rows.
    found = found.groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))
    marked = labels.where(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").cast("long").alias("id"))
    marked = marked.agg(F.max(F.col("quality") == 1).alias("is_good"), F.max(F.col("toxic") == 1).alias("is_toxic"))
    joined = found.join(marked, "id", "left")
    counted = lambda flag: F.when(F.col(flag), F.col("n")).otherwise(0)
    return interactions(joined.select("part", "mask", "n", counted("is_good").alias("good"), counted("is_toxic").alias("toxic")))
