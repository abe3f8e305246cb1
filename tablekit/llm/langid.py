"""Language identification: averaged embeddings of hashed subwords under a linear softmax, trained in numpy."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablekit.llm import words
from tablekit.llm.sample import fold
from tablekit.llm.store import ship

#: Subwords of so many bytes, hashed to so many buckets.
SUBWORDS = (2, 3)
BUCKETS = 1 << 12
WIDTH = 16
#: Most documents of a language that are learnt from.
SAMPLE = 600
#: Share of correct answers that the confidence of an accepted prediction must reach on calibration documents.
TRUST = 0.99
UNKNOWN = "und"

# Letters keep their lower-case byte, bytes of longer characters theirs; all else is a gap between words.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def subwords(data: np.ndarray) -> np.ndarray:
    """How often each bucket's subwords occur in a text; gaps are single and subwords of gaps only don't count."""
    data = _FOLD[data]
    gap = data == 32
    if len(data):
        data = data[~(gap & np.concatenate([[False], gap[:-1]]))]
    data = np.concatenate([[32], data, [32]]).astype(np.uint32)
    counts = np.zeros(BUCKETS, np.float32)
    for k in SUBWORDS:
        if len(data) < k:
            continue
        code = np.full(len(data) - k + 1, k, np.uint32)
        for j in range(k):
            code = (code * np.uint32(257) + data[j : len(data) - k + 1 + j]) * np.uint32(0x9E3779B1)
        counts += np.bincount(code >> np.uint32(20), minlength=BUCKETS)
    return counts


@dataclass
class Model:
    """Weights, the languages in the order of the outputs, temperature and the least trusted confidence."""

    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    labels: list[str]
    temperature: float = 1.0
    least: float = 0.0

    def logits(self, counts: np.ndarray) -> np.ndarray:
        share = counts / np.maximum(counts.sum(-1, keepdims=True), 1)
        return share @ self.embeddings @ self.weights + self.bias

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        return softmax(self.logits(counts) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(-1, keepdims=True))
    return x / x.sum(-1, keepdims=True)


class Examples:
    """Counts of many texts, stored by what is not zero: ``bucket`` and ``count`` of text i from ``cut[i]`` on."""

    def __init__(self, packed: list[bytes]) -> None:
        parts = [np.frombuffer(p, _PAIR) for p in packed]
        self.cut = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
        pairs = np.concatenate([*parts, np.zeros(0, _PAIR)])
        self.bucket, self.count = pairs["bucket"].copy(), pairs["count"].copy()

    def dense(self, rows: np.ndarray) -> np.ndarray:
        """The counts of a few texts."""
        out = np.zeros((len(rows), BUCKETS), np.float32)
        for i, row in enumerate(rows):
            low, high = self.cut[row], self.cut[row + 1]
            out[i, self.bucket[low:high]] = self.count[low:high]
        return out


_PAIR = np.dtype([("bucket", "<u2"), ("count", "<f4")])


def pack(counts: np.ndarray) -> bytes:
    """A text's counts as pairs of bucket and count."""
    used = np.flatnonzero(counts)
    pairs = np.empty(len(used), _PAIR)
    pairs["bucket"], pairs["count"] = used, counts[used]
    return pairs.tobytes()


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the whole text and of short runs spread over all of it, so that short texts are learnt too."""
    names = ["id", "lang", "run", "digest", "counts"]
    for batch in batches:
        for low, high in words.slices(batch.column("text")):
            part = batch.slice(low, high - low)
            data, offsets = words.texts(part.column("text"))
            ids, langs, numbers, digests, out = [], [], [], [], []
            for d, (ident, lang) in enumerate(zip(part.column("id").to_pylist(), part.column("lang").to_pylist())):
                text = data[offsets[d] : offsets[d + 1]]
                runs = [text]
                for size in (24, 60, 150):
                    if len(text) > 2 * size:
                        at = (hash((ident, size)) % 997) * (len(text) - size) // 997
                        runs.append(text[at : at + size])
                for k, run in enumerate(runs):
                    packed = pack(subwords(run))
                    ids.append(ident)
                    langs.append(lang)
                    numbers.append(k)
                    digests.append(hashlib.md5(packed).hexdigest())
                    out.append(packed)
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.string(), pa.binary())
            columns = [pa.array(c, t) for c, t in zip((ids, langs, numbers, digests, out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int = SAMPLE, seed: int = 7) -> Model:
    """Learn from at most ``sample`` documents of each language (null languages and texts are left out).

    Those with the smallest hashes of their ids are taken, for all languages in one pass. Every fifth document of the
    sample is kept for calibration: the temperature with the least log loss, and the least confidence from which on
    ``TRUST`` of the answers are right. The driver holds a few numbers for each subword that an example has.
    """
    ship(docs.sparkSession)
    usable = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text")
    )
    usable = usable.where("id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    ids = usable.select("lang", "id").distinct().withColumn("h", F.xxhash64("id", F.lit(0)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))  # cut in each task before rows move
    chosen = ids.withColumn("place", place).where(F.col("place") <= sample).select("lang", "id")
    # At most ``sample`` rows of two short values for each language are broadcast.
    picked = usable.join(F.broadcast(chosen), ["lang", "id"], "left_semi").select("id", "lang", "text")
    ddl = "id bigint, lang string, run int, digest string, counts binary"
    rows = picked.mapInArrow(_examples, ddl).toArrow()
    rows = rows.sort_by([(c, "ascending") for c in ("id", "lang", "run", "digest")])
    labels = sorted(set(rows.column("lang").to_pylist()))
    if not labels:
        return Model(np.zeros((BUCKETS, WIDTH), np.float32), np.zeros((WIDTH, 0)), np.zeros(0), [])
    examples = Examples(rows.column("counts").to_pylist())
    target = np.array([labels.index(lang) for lang in rows.column("lang").to_pylist()])
    held = np.array([i % 5 == 2 for i in rows.column("id").to_pylist()])
    del rows
    return fit(examples, target, held, labels, seed)


def fit(examples: Examples, target: np.ndarray, held: np.ndarray, labels: list[str], seed: int = 7) -> Model:
    """Stochastic gradient descent on the examples that are not held, then calibration on those that are."""
    if held.all() or not held.any():
        held = np.zeros(len(held), bool)
    rng = np.random.default_rng(seed)
    model = Model(
        rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32),
        rng.normal(0, 0.1, (WIDTH, len(labels))).astype(np.float32), np.zeros(len(labels), np.float32), labels,
    )
    one = np.eye(len(labels), dtype=np.float32)
    learnt = np.flatnonzero(~held)
    balance = (len(learnt) / len(labels) / np.maximum(np.bincount(target[learnt], minlength=len(labels)), 1))[target]
    epochs = 24
    for epoch in range(epochs):
        rate = 8.0 * (1 - epoch / epochs)
        for part in np.array_split(rng.permutation(learnt), max(1, len(learnt) // 32)):
            counts = examples.dense(part)
            share = counts / np.maximum(counts.sum(1, keepdims=True), 1)
            hidden = share @ model.embeddings
            error = softmax(hidden @ model.weights + model.bias) - one[target[part]]
            error *= balance[part, None].astype(np.float32) / len(part)
            model.embeddings -= rate * (share.T @ (error @ model.weights.T))
            model.weights -= rate * (hidden.T @ error)
            model.bias -= rate * error.sum(0)
    checked = np.flatnonzero(held if held.any() else ~held)
    truth, rows_at = target[checked], np.arange(len(checked))
    parts = np.array_split(checked, max(1, len(checked) // 256))
    logits = np.concatenate([model.logits(examples.dense(part)) for part in parts])
    losses = {t: -np.log(softmax(logits / t)[rows_at, truth] + 1e-12).mean() for t in np.geomspace(0.1, 10, 41)}
    model.temperature = float(min(losses, key=losses.get))
    odds = softmax(logits / model.temperature)
    order = np.argsort(-odds.max(1), kind="stable")
    right = np.cumsum((odds.argmax(1) == truth)[order]) / (rows_at + 1)
    trusted = np.flatnonzero(right >= TRUST)
    model.least = float(odds.max(1)[order][trusted[-1]]) if len(trusted) else 1.0
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``lang_pred``, ``score`` (calibrated probability of that language) and ``accepted`` for each row.

    A null text, and one without a letter, is ``und`` with score 0; ids may be null or repeated; an empty table
    gives no rows. ``accepted`` is false where the score is below the calibrated bound of rejection.
    """
    ship(docs.sparkSession)
    handle = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = handle.value
        for batch in batches:
            for low, high in words.slices(batch.column(1)):
                part = batch.slice(low, high - low)
                data, offsets = words.texts(part.column(1))
                names, scores = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
                for d in range(part.num_rows):
                    raw = data[offsets[d] : offsets[d + 1]]
                    if not model.labels or not any(map(str.isalpha, raw.tobytes().decode())):  # isalpha: \p{L}
                        continue
                    odds = model.probabilities(subwords(raw)[None])[0]
                    best = int(odds.argmax())
                    names[d], scores[d] = model.labels[best], min(1.0, float(odds[best]))
                accepted = scores >= model.least if model.labels else scores > 0
                known = np.array([n != UNKNOWN for n in names], bool)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(scores), pa.array(accepted & known)],
                    names=["key", "lang_pred", "score", "accepted"],
                )

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("key"), F.col(f"`{text_col}`").alias("text"))
    scored = source.mapInArrow(apply, "key bigint, lang_pred string, score double, accepted boolean")
    return scored.withColumnRenamed("key", id_col)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on documents outside fold 0 of crc32(id) and predict all: :func:`predict` with ``held_out``."""
    model = train(docs.where(fold(id_col) != 0), id_col, text_col, lang_col)
    scored = predict(docs, model, id_col, text_col)
    return scored.select(id_col, (fold(id_col) == 0).alias("held_out"), "lang_pred", "score", "accepted")
