"""Language identification: scores against a plain loop, the letter rule, the sample, clashing names."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from tablekit.llm import langid
from tests.llm import data


def small_model(labels=("de", "en", "fr")):
    rng = np.random.default_rng(5)
    return langid.Model(
        rng.normal(0, 3, (langid.BUCKETS, langid.WIDTH)).astype(np.float32),
        rng.normal(0, 3, (langid.WIDTH, len(labels))).astype(np.float32), rng.normal(0, 1, len(labels)).astype(np.float32),
        list(labels), 1.7, 0.6,
    )


def plain(model, text):
    """The same score, subword by subword."""
    folded = []
    for byte in text.encode():
        letter = byte + 32 if 65 <= byte <= 90 else byte if 97 <= byte <= 122 or byte >= 128 else 32
        if not (letter == 32 and folded and folded[-1] == 32):
            folded.append(letter)
    folded = [32, *folded, 32]
    total, n = [0.0] * langid.WIDTH, 0
    for k in langid.SUBWORDS:
        for i in range(len(folded) - k + 1):
            code = k
            for byte in folded[i : i + k]:
                code = (code * 257 + byte) * 0x9E3779B1 % 2**32
            n += 1
            for w in range(langid.WIDTH):
                total[w] += float(model.embeddings[code >> 20, w])
    logits = [
        (sum(total[w] / n * float(model.weights[w, j]) for w in range(langid.WIDTH)) + float(model.bias[j])) / model.temperature
        for j in range(len(model.labels))
    ]
    odds = [math.exp(x - max(logits)) for x in logits]
    return model.labels[int(np.argmax(odds))], max(odds) / sum(odds)


def test_scores_equal_a_plain_loop(spark):
    model = small_model()
    texts = ["The quick brown fox", "Größe", "a", "ab  cd\n\nEF 12", "x" * 500, "été 2024!"]
    rows = langid.predict(data.table(spark, list(enumerate(texts))), model).collect()
    for r in rows:
        label, score = plain(model, texts[r.doc_id])
        assert r.lang_pred == label and abs(r.score - score) < 1e-4 and r.accepted == (r.score >= 0.6)


def test_numerals_and_marks_are_no_letters(spark):
    texts = [None, "", " ", "½", "12 ²", "①", "Ⅷ ⅓", "٣", "_-!", "́", "漢", "ʰ", "a1"]
    rows = {r.doc_id: r for r in langid.predict(data.table(spark, list(enumerate(texts))), small_model()).collect()}
    unknown = [rows[i].lang_pred == "und" for i in range(len(texts))]
    assert unknown == [True] * 10 + [False] * 3
    assert all(rows[i].score == 0 and not rows[i].accepted for i in range(10))


def test_sparse_counts_are_the_counts():
    texts = ["", "ab", "the rain in Spain " * 30, "ñ"]
    counts = [langid.subwords(np.frombuffer(t.encode(), np.uint8)) for t in texts]
    examples = langid.Examples([langid.pack(c) for c in counts])
    assert np.array_equal(examples.dense(np.array([2, 0, 3])), np.stack([counts[2], counts[0], counts[3]]))
    assert langid.Examples([]).dense(np.zeros(0, int)).shape == (0, langid.BUCKETS)


def test_sample_and_clashing_names(spark):
    """Names that the training uses inside; the sample does not depend on the partitions or the order of rows."""
    rows = [(i, f"{w} {w}en {w}ung und der {i}", "de") if i % 2 else (i, f"the {w}ing of {w}s and {i}", "en") for i, w in enumerate(["wal", "ber", "ton", "mir"] * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in ("sample_id", "h", "id", "place", "run", "digest", "counts", "key"):
        docs = docs.withColumn(name, F.lit("x"))
    one = langid.train(docs.repartition(2), "doc_id", "text", "lang", 20)
    two = langid.train(docs.orderBy(F.desc("doc_id")).repartition(7), "doc_id", "text", "lang", 20)
    assert one.labels == ["de", "en"] and np.array_equal(one.weights, two.weights) and one.least == two.least
    said = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    assert said.count() == 120 and said.where("lang = lang_pred").count() > 110
    none = langid.identify(docs.limit(0))
    assert none.count() == 0
