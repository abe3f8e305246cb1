"""The filter audit against a plain version, its trie, and odd tables."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tablekit.llm import audit
from tests.llm import data


def fails(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode())
    return (
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        bool(re.search("[#$%&*|]", text)),
    )


def brute(rows, labels):
    """Every order, every step, row by row."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    marks = {}
    for i, good, toxic in labels:
        if i is not None:
            own = marks.setdefault(i, [False, False])
            own[0] |= good == 1
            own[1] |= toxic == 1
    flagged = []
    for i, text, lang in rows:
        copy = i is not None and i > least[text or ""]
        flagged.append((lang or "", (*fails(text or ""), copy), *marks.get(i, (False, False))))
    out, removed_by = {}, Counter()
    for part in {f[0] for f in flagged}:
        for order in permutations(range(5)):
            left = [f for f in flagged if f[0] == part]
            gone = []
            for step, k in enumerate(order, 1):
                lost = [f for f in left if f[1][k]]
                redundant = sum(f[1][k] for f in gone)
                left = [f for f in left if not f[1][k]]
                gone += lost
                unique = sum(f[0] == part and f[1][k] and sum(f[1]) == 1 for f in flagged)
                key = part, "".join("ABCDE"[x] for x in order), step
                out[key] = (len(left), len(lost), redundant, unique, sum(f[2] for f in lost), sum(f[3] for f in lost))
                removed_by[part, k] += len(lost)
    return sorted((*key, *row, removed_by[key[0], "ABCDE".index(key[1][key[2] - 1])]) for key, row in out.items())


def odd_docs():
    rnd = random.Random(4)
    rows = [(i, t, rnd.choice(["en", "de", None, ""])) for i, t in data.odd_rows(copies=6)]
    shared = " ".join(f"s{i}" for i in range(300))
    rows += [(200 + i, shared + " end" * (i % 5), "en") for i in range(20)]
    rows += [(230, "a\x00b", "en"), (231, "a\x00b", "de"), (232, "x" * 5000 + "A" * 700, "en"), (232, "x" * 5000 + "A" * 700, "en")]
    rows += [(240 + i, "# only symbols %", "de") for i in range(30)]
    return rows


LABELS = [(20, 1, 0), (50, 1, 1), (51, 0, 1), (51, 1, None), (None, 1, 1), (7, 1, 0), (7, 1, 0), (999, 1, 1), (205, 1, 0)]
LABEL_SCHEMA = "doc_id long, quality int, toxic int, mask string, n string, part string"


def tables(spark, rows, labels=LABELS, parts=5):
    given = [(i, t, lang, "s", 1, "x", "x", "x", "x") for i, t, lang in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, mask string, id string, size string, head string"
    docs = spark.createDataFrame(given, schema).repartition(parts)
    return docs, spark.createDataFrame([(*r, "m", "n", "p") for r in labels], LABEL_SCHEMA)


@pytest.mark.parametrize("range_bytes", [audit.RANGE_BYTES, 3000])
def test_audit(spark, range_bytes, monkeypatch):
    monkeypatch.setattr(audit, "TRIE_BYTES", 20_000)
    rows = odd_docs()
    got = audit.audit(*tables(spark, rows), range_bytes=range_bytes)
    assert sorted(map(tuple, got.collect())) == brute(rows, LABELS)


def test_audit_of_nothing(spark):
    docs, labels = tables(spark, [])
    assert audit.audit(docs, labels).count() == 0
    docs, labels = tables(spark, [(1, None, None)], [])
    got = audit.audit(docs, labels)
    assert got.count() == 600 and {r.part for r in got.collect()} == {""}
    assert sorted(map(tuple, got.collect())) == brute([(1, None, None)], [])


def test_heavy_beginnings_are_split(spark):
    """Texts that begin alike go to many keys, equal texts to one."""
    docs, _ = tables(spark, [(i, "same beginning of many words " * 4 + str(i % 50), "en") for i in range(400)])
    pending = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    keyed = audit._keys(audit.Shelf(spark, "test"), pending, 20_000).groupBy("text").agg(F.countDistinct("head", "tail").alias("k"))
    assert keyed.agg(F.max("k")).first()[0] == 1
    keys = audit._keys(audit.Shelf(spark, "test"), pending, 20_000).select("head", "tail").distinct().count()
    assert keys == 50
    assert audit._keys(audit.Shelf(spark, "test"), pending, 10**9).select("head", "tail").distinct().count() == 1


def test_trie_holds_whole_texts():
    rnd = random.Random(1)
    texts = [bytes(rnd.choice(b"ab\x00\xff") for _ in range(rnd.randrange(9))) for _ in range(2000)]
    texts += [b"a" * n for n in range(300)] + [b"a" * 250 + b"b"]
    trie, least = audit.Trie(), {}
    for ident, text in enumerate(texts):
        audit._enter(trie.insert(text), ident, {ident: 1})
        least.setdefault(text, ident)
    found = list(trie.terminals())
    assert [t for t, _ in found] == sorted(least)
    assert all(node.least == least[text] for text, node in found)
