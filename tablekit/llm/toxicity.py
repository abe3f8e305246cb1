"""Toxicity grades by cumulative-link ordinal regression on sparse text features, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm import words
from tablekit.llm.sample import fold, smallest
from tablekit.llm.store import Shelf

#: Features are whole words and word beginnings of so many bytes, which catch inflected and compound words.
PREFIXES = (4, 5, 6)
#: Most labelled documents of each label that are learnt from.
SAMPLE = 4000
#: Most features that are kept, those most unevenly spread over the labels.
KEPT = 4096
#: Least log-likelihood ratio (G) by which a feature must depend on the label.
EVIDENCE = 15.0
#: Grades: 0 is clean; toxic documents fall into equal thirds by their tell-tale words.
GRADES = 4
#: A document is flagged from this expected severity on.
THRESHOLD = 0.5


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct features of every text and their counts, sorted in each text, and the offsets of the texts.

    A feature is a hash of a word without punctuation at its end, or of a word's beginning.
    """
    data, offsets = words.texts(column)
    _, starts, ends, bounds, heads = words.words(_trimmed(data), offsets, (*PREFIXES, 64))
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(bounds))
    length = ends - starts
    codes, owners = [heads[-1]], [owner]
    for k, head in zip(PREFIXES, heads):
        longer = length > k
        codes.append(head[longer])
        owners.append(owner[longer])
    code, owner = np.concatenate(codes).view(np.int64), np.concatenate(owners)
    order = np.lexsort((code, owner))
    code, owner = code[order], owner[order]
    first = np.ones(len(code), bool)
    first[1:] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    counts = np.diff(np.append(at, len(code)))
    return code[at], counts.astype(np.int32), np.searchsorted(owner[at], np.arange(len(offsets)))


def _trimmed(data: np.ndarray) -> np.ndarray:
    """ASCII bytes that are no letters or digits become spaces."""
    return _WORD[data]


_WORD = np.full(256, 32, np.uint8)
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _WORD[_low:_high] = np.arange(_low, _high)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """One weight for each kept feature (sorted hashes), shared by all thresholds, and the ordered thresholds.

    P(grade > k) is the logistic function of the weighted features minus threshold k.
    """

    codes: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, eta: np.ndarray) -> np.ndarray:
        return _sigmoid(eta[:, None] - self.thresholds[None, :])

    def eta(self, code: np.ndarray, counts: np.ndarray, cut: np.ndarray) -> np.ndarray:
        if not len(self.codes) or not len(code):
            return np.zeros(len(cut) - 1)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        value = np.where(self.codes[at] == code, self.weights[at] * np.log1p(counts), 0.0)
        sums = np.concatenate([[0.0], np.cumsum(value)])
        return sums[cut[1:]] - sums[cut[:-1]]


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, codes: np.ndarray, steps: int = 600) -> Model:
    """Adam on the penalised likelihood of the cumulative-link model; grades weigh the same as groups 0 and above."""
    column = np.concatenate([np.searchsorted(codes, c) for c, _ in rows]) if rows else np.zeros(0, np.int64)
    value = np.concatenate([np.log1p(n) for _, n in rows]) if rows else np.zeros(0)
    owner = np.repeat(np.arange(len(rows)), [len(c) for c, _ in rows])
    levels = GRADES - 1
    weights = np.zeros(len(codes))
    gaps = np.array([1.0] + [0.5] * (levels - 1))  # the first threshold, then logs of the steps between them
    weight = np.where(grades > 0, 0.5 / max(1, (grades > 0).sum()), 0.5 / max(1, (grades == 0).sum()))
    state = [np.zeros(len(codes) + levels) for _ in range(2)]
    for step in range(1, steps + 1):
        thresholds = np.cumsum(np.concatenate([gaps[:1], np.exp(gaps[1:])]))
        eta = np.bincount(owner, weights=weights[column] * value, minlength=len(rows))
        above = np.hstack([np.ones((len(rows), 1)), _sigmoid(eta[:, None] - thresholds), np.zeros((len(rows), 1))])
        at = np.arange(len(rows))
        high, low = above[at, grades], above[at, grades + 1]
        likely = np.maximum(high - low, 1e-9)
        # d log(high - low): the logistic's slope at each side of the grade
        slope = above * (1 - above)
        up, down = slope[at, grades] / likely * weight, slope[at, grades + 1] / likely * weight
        d_eta = -(up - down)
        d_threshold = np.zeros(levels)
        np.add.at(d_threshold, grades[grades > 0] - 1, up[grades > 0])
        np.add.at(d_threshold, grades[grades < levels], -down[grades < levels])
        d_gaps = np.cumsum(d_threshold[::-1])[::-1].copy()
        d_gaps[1:] *= np.exp(gaps[1:])
        d_weights = np.bincount(column, weights=d_eta[owner] * value, minlength=len(codes)) + 2e-5 * weights
        gradient = np.concatenate([d_weights, d_gaps])
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.999 * state[1] + 0.001 * gradient**2
        move = 0.1 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        weights -= move[: len(codes)]
        gaps -= move[len(codes) :]
    thresholds = np.cumsum(np.concatenate([gaps[:1], np.exp(gaps[1:])]))
    return Model(codes, weights, thresholds)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high in words.slices(batch.column("text")):
            part = batch.slice(low, high - low)
            code, counts, cut = features(part.column("text"))
            offsets = pa.array(cut, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("toxic"), pa.ListArray.from_arrays(offsets, pa.array(code)),
                 pa.ListArray.from_arrays(offsets, pa.array(counts))],
                names=["id", "toxic", "code", "n"],
            )


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` labelled documents of each label.

    Features whose spread over the two labels is no chance (``EVIDENCE``) are kept, at most ``KEPT``, so what is
    collected is bounded. The tables know two grades only; a toxic document's
    grade is its third by how many tell-tale features it has (those at least 20 times as frequent among toxic
    documents), repeated ones counting less.
    """
    shelf = Shelf(docs.sparkSession, "toxicity")
    marked = labels.select(F.col(id_col), F.col(label_col).cast("int").alias("toxic")).where(f"{id_col} IS NOT NULL")
    chosen = None
    for target in (0, 1):
        ids = smallest(marked.where(F.col("toxic") == target), id_col, sample).withColumn("toxic", F.lit(target))
        chosen = ids if chosen is None else chosen.unionByName(ids)
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # At most 2 x sample rows of two numbers are broadcast.
    picked = picked.join(F.broadcast(chosen), F.col("id") == F.col("sample_id")).select("id", "toxic", "text")
    rows = picked.mapInArrow(_examples, "id bigint, toxic int, code array<bigint>, n array<int>")
    rows = shelf.put(rows.withColumn("digest", F.xxhash64("code", "n")), "rows")
    rows = rows.dropDuplicates(["toxic", "digest"])  # copies would pass for evidence
    totals = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return Model(np.zeros(0, np.int64), np.zeros(0), np.array([4.0, 5.0, 6.0]))
    spread = rows.select("toxic", F.explode("code").alias("code")).groupBy("code")
    spread = spread.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    share = totals[1] / (totals[0] + totals[1])
    both = F.col("bad") + F.col("good")
    gain = 2 * (
        F.col("bad") * F.log(F.greatest("bad", F.lit(0.5)) / (both * share))
        + F.col("good") * F.log(F.greatest("good", F.lit(0.5)) / (both * (1 - share)))
    )
    odds = F.log((F.col("bad") + 0.5) / (totals[1] + 1)) - F.log((F.col("good") + 0.5) / (totals[0] + 1))
    spread = spread.where(both >= 3).select("code", odds.alias("odds"), gain.alias("gain")).where(F.col("gain") >= EVIDENCE)
    best = spread.orderBy(F.desc("gain"), "code").limit(KEPT).collect()
    codes = np.sort(np.array([r["code"] for r in best], np.int64))
    telling = {r["code"] for r in best if r["odds"] > np.log(20)}
    kept = docs.sparkSession.sparkContext.broadcast(codes)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                code = np.asarray(batch.column(2)[k].values)
                own = np.isin(code, kept.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, 1), batch.column(1).slice(k, 1), pa.array([code[own]]),
                     pa.array([np.asarray(batch.column(3)[k].values)[own]])],
                    names=["id", "toxic", "code", "n"],
                )

    kinds = "id bigint, toxic int, code array<bigint>, n array<int>"
    found = rows.drop("digest").mapInArrow(narrow, kinds).collect()
    found.sort(key=lambda r: (r["id"], r["toxic"], r["code"]))
    pairs = [(np.array(r["code"], np.int64), np.array(r["n"], np.int64)) for r in found]
    toxic = np.array([r["toxic"] for r in found])
    hits = np.array([sum(np.log1p(n) for c, n in zip(r["code"], r["n"]) if c in telling) for r in found])
    edges = np.quantile(hits[toxic == 1], np.arange(1, GRADES - 1) / (GRADES - 1))
    grades = np.where(toxic == 1, 1 + np.searchsorted(edges, hits, side="right"), 0)
    shelf.drop("rows")
    return fit(pairs, grades, codes)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``severity`` (expected grade, 0 to 3), ``grade`` (the likeliest), ``p_toxic`` and ``toxic``.

    One row per input row, over its whole text. Null and empty texts have no features and get the severity of a
    text without any tell-tale; ids may be null or repeated; an empty table gives no rows. ``toxic`` is true from
    ``THRESHOLD`` on.
    """
    handle = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = handle.value
        for batch in batches:
            for low, high in words.slices(batch.column(1), 1 << 20):
                part = batch.slice(low, high - low)
                above = model.above(model.eta(*features(part.column(1))))
                each = -np.diff(np.hstack([np.ones((len(above), 1)), above, np.zeros((len(above), 1))]), axis=1)
                severity = above.sum(1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(severity), pa.array(each.argmax(1).astype(np.int32)),
                     pa.array(above[:, 0].copy()), pa.array(severity >= THRESHOLD)],
                    names=["key", "severity", "grade", "p_toxic", "toxic"],
                )

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("key"), F.col(f"`{text_col}`").alias("text"))
    scored = source.mapInArrow(apply, "key bigint, severity double, grade int, p_toxic double, toxic boolean")
    return scored.withColumnRenamed("key", id_col)


def grade(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on labels outside fold 0 of crc32(id) and grade all documents, with ``held_out``."""
    model = train(docs, labels.where(fold(id_col) != 0), id_col, text_col, "toxic")
    return score(docs, model, id_col, text_col).withColumn("held_out", fold(id_col) == 0)
