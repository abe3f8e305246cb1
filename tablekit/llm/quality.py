"""Document quality by attention-based multiple-instance learning over passages, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm import words
from tablekit.llm.sample import fold, smallest

#: Words of a passage; the last passage of a text may be shorter.
PASSAGE = 64
#: Most labelled documents of each label that are learnt from.
SAMPLE = 1500
HIDDEN = 16
THRESHOLD = 0.3

# Classes of bytes: upper, lower (with bytes of longer characters), digit, space, usual and other punctuation.
_CLASS = np.full(256, 5, np.int8)
_CLASS[65:91] = 0
_CLASS[97:123] = 1
_CLASS[128:] = 1
_CLASS[48:58] = 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[[ord(c) for c in ".,;:'\"-()?!"]] = 4
FEATURES = 12


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and the offsets of the texts in them; an empty text has one passage of zeros."""
    data, offsets = words.texts(column)
    hashes, starts, ends, bounds, _ = words.words(data, offsets)
    counts = np.diff(bounds)
    made = np.maximum(1, -(-counts // PASSAGE))
    cut = np.concatenate([[0], np.cumsum(made)])
    owner = np.repeat(np.arange(len(counts)), made)
    inner = np.arange(len(owner)) - cut[:-1][owner]
    first = bounds[:-1][owner] + inner * PASSAGE
    last = np.minimum(first + PASSAGE, bounds[1:][owner])
    out = np.zeros((len(owner), FEATURES), np.float32)
    filled = np.flatnonzero(last > first)
    if not len(filled):
        return out, cut
    first, last = first[filled], last[filled]
    size = (last - first).astype(np.float64)
    low, high = starts[first], ends[last - 1]
    width = np.maximum(high - low, 1)
    kind = _CLASS[data]
    for k in range(6):
        sums = np.concatenate([[0], np.cumsum(kind == k, dtype=np.int64)])
        out[filled, k] = (sums[high] - sums[low]) / width
    same = np.zeros(len(hashes) + 1, np.int64)
    same[2:] = np.cumsum(hashes[1:] == hashes[:-1])
    out[filled, 6] = (same[last] - same[first + 1]) / size
    group = np.repeat(np.arange(len(first)), last - first)
    keyed = words.mix(hashes ^ words.mix(group.astype(np.uint64)))
    order = np.argsort(keyed, kind="stable")
    fresh = np.ones(len(keyed), bool)
    fresh[order[1:]] = keyed[order[1:]] != keyed[order[:-1]]
    out[filled, 7] = np.bincount(group, weights=fresh, minlength=len(first)) / size
    length = ends - starts
    out[filled, 8] = np.bincount(group, weights=length, minlength=len(first)) / size / 10
    capital = (kind[starts] == 0).astype(np.float64)
    out[filled, 9] = np.bincount(group, weights=capital, minlength=len(first)) / size
    symbol = (kind[ends - 1] == 5).astype(np.float64)
    out[filled, 10] = np.bincount(group, weights=symbol, minlength=len(first)) / size
    out[filled, 11] = np.log1p(size) / 5
    return out, cut


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Encoder, gated attention and classifier; ``weights`` by name, features centred and scaled."""

    def __init__(self, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        shapes = {
            "encode": (FEATURES, HIDDEN), "encode0": (HIDDEN,), "tanh": (HIDDEN, HIDDEN), "gate": (HIDDEN, HIDDEN),
            "attend": (HIDDEN,), "out": (HIDDEN,), "out0": (),
        }
        self.weights = {k: rng.normal(0, 1 / np.sqrt(max(1, s[0] if s else 1)), s) * bool(s) for k, s in shapes.items()}
        self.weights["encode0"] = np.zeros(HIDDEN)
        self.centre, self.scale = np.zeros(FEATURES), np.ones(FEATURES)

    def forward(self, features: np.ndarray, cut: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        x = (features - self.centre) / self.scale
        code = np.tanh(x @ w["encode"] + w["encode0"])
        tanh, gate = np.tanh(code @ w["tanh"]), _sigmoid(code @ w["gate"])
        raw = (tanh * gate) @ w["attend"]
        owner = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
        raw = np.exp(raw - np.maximum.reduceat(raw, cut[:-1])[owner])
        share = raw / np.add.reduceat(raw, cut[:-1])[owner]
        bag = np.add.reduceat(share[:, None] * code, cut[:-1], axis=0)
        logit = bag @ w["out"] + w["out0"]
        return {"x": x, "code": code, "tanh": tanh, "gate": gate, "share": share, "bag": bag, "logit": logit, "owner": owner}

    def score(self, features: np.ndarray, cut: np.ndarray) -> np.ndarray:
        return _sigmoid(self.forward(features, cut)["logit"])

    def gradients(self, features: np.ndarray, cut: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict:
        """Gradients of the weighted mean log loss."""
        w, v = self.weights, self.forward(features, cut)
        error = (_sigmoid(v["logit"]) - target) * weight / weight.sum()
        bag = error[:, None] * w["out"]
        share = (bag[v["owner"]] * v["code"]).sum(1)
        raw = v["share"] * (share - np.add.reduceat(v["share"] * share, cut[:-1])[v["owner"]])
        gated = raw[:, None] * w["attend"]
        tanh = gated * v["gate"] * (1 - v["tanh"] ** 2)
        gate = gated * v["tanh"] * v["gate"] * (1 - v["gate"])
        code = v["share"][:, None] * bag[v["owner"]] + tanh @ w["tanh"].T + gate @ w["gate"].T
        inner = code * (1 - v["code"] ** 2)
        return {
            "encode": v["x"].T @ inner, "encode0": inner.sum(0), "tanh": v["code"].T @ tanh, "gate": v["code"].T @ gate,
            "attend": ((v["tanh"] * v["gate"]) * raw[:, None]).sum(0), "out": v["bag"].T @ error, "out0": error.sum(),
        }

    def fit(self, features: np.ndarray, cut: np.ndarray, target: np.ndarray, steps: int = 400) -> Model:
        """Adam on all bags at once; both labels weigh the same."""
        self.centre, self.scale = features.mean(0), features.std(0) + 1e-3
        share = np.clip(target.mean(), 1e-6, 1 - 1e-6)
        weight = np.where(target > 0, 0.5 / share, 0.5 / (1 - share))
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            rate = 0.02 * (1 - (step - 1) / steps)
            for k, g in self.gradients(features, cut, target, weight).items():
                g = g + 1e-4 * self.weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                self.weights[k] = self.weights[k] - rate * (first[k] / (1 - 0.9**step)) / (
                    np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                )
        return self


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high in words.slices(batch.column("text")):
            part = batch.slice(low, high - low)
            features, cut = passages(part.column("text"))
            bags = [features[cut[d] : cut[d + 1]].tobytes() for d in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("target"), pa.array(bags, pa.binary())], names=["id", "target", "bag"]
            )


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` labelled documents of each label; without both labels all scores are 0.5."""
    marked = labels.select(F.col(id_col), F.col(label_col).cast("int").alias("target")).where(f"{id_col} IS NOT NULL")
    chosen = None
    for target in (0, 1):
        ids = smallest(marked.where(F.col("target") == target), id_col, sample).withColumn("target", F.lit(target))
        chosen = ids if chosen is None else chosen.unionByName(ids)
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # At most 2 x sample rows of two numbers are broadcast.
    picked = picked.join(F.broadcast(chosen), F.col("id") == F.col("sample_id")).select("id", "target", "text")
    rows = picked.mapInArrow(_examples, "id bigint, target int, bag binary").collect()
    rows.sort(key=lambda r: (r["id"], r["target"], bytes(r["bag"])))
    model = Model()
    target = np.array([r["target"] for r in rows], np.float64)
    if len(set(target.tolist())) < 2:
        model.weights["out"] = np.zeros(HIDDEN)
        return model
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, FEATURES) for r in rows]
    cut = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    return model.fit(np.concatenate(bags).astype(np.float64), cut, target)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple = ()) -> DataFrame:
    """id, ``score`` (0 to 1, higher is better) and ``predicted`` (1 from ``THRESHOLD`` on); one row per row.

    Null and empty texts are one passage of zeros and get a score like any other; ids may be null or repeated;
    an empty table gives no rows. Columns named in ``keep`` are carried along.
    """
    handle = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in keep if c not in (id_col,)]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = handle.value
        for batch in batches:
            for low, high in words.slices(batch.column(1)):
                part = batch.slice(low, high - low)
                scores = model.score(*passages(part.column(1)))
                columns = [part.column(0), *part.columns[2:], pa.array(scores, pa.float64())]
                predicted = pa.array((scores >= THRESHOLD).astype(np.int32))
                out = ["key", *(f"k{i}" for i in range(len(names))), "score", "predicted"]
                yield pa.RecordBatch.from_arrays([*columns, predicted], names=out)

    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("key"), F.col(f"`{text_col}`").alias("text"),
        *(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(names)),
    )
    kinds = "".join(f", k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    scored = source.mapInArrow(apply, f"key bigint{kinds}, score double, predicted int")
    return scored.toDF(id_col, *names, "score", "predicted")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple = ()) -> DataFrame:
    """Train on labels outside fold 0 of crc32(id) and score all documents, with ``held_out``."""
    model = train(docs, labels.where(fold(id_col) != 0), id_col, text_col, "quality")
    scored = score(docs, model, id_col, text_col, keep)
    return scored.withColumn("held_out", fold(id_col) == 0)
