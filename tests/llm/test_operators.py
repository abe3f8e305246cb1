"""Operators on tables with nulls, empty and long texts, repeated rows, ties and clashing columns; and empty ones."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablekit.llm import bpe, exact, langid, lines, ngram_join, packing, passages, quality, toxicity, vectors
from tablekit.llm.components import components
from tests.llm import data

ROWS = data.odd_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return data.table(spark, ROWS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return data.empty(spark)


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 200, (150, 2))] + [(300 + i, 301 + i) for i in range(40)]
    pairs += [(500, 500 + i) for i in range(1, 60)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = data.components(600, pairs)
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    assert got == {n: root[n] for n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_ngram_join(docs, k, percent, monkeypatch):
    monkeypatch.setattr(ngram_join, "MEMBERS", 4)
    monkeypatch.setattr(ngram_join, "QUERIES", 5)
    sets = [data.shingle_set(t, k) for _, t in ROWS]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            inter = len(a & sets[j])
            if a and sets[j] and 100 * inter >= percent * (len(a) + len(sets[j]) - inter):
                links.append((i, j))
    least = data.least_ids(ROWS, data.components(len(ROWS), links))
    want = [(i, len(s), c if s else i) for (i, _), s, c in zip(ROWS, sets, least)]
    got = ngram_join.join(docs, k=k, percent=percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert data.ordered(tuple(r) for r in got.collect()) == data.ordered(want)


def test_ngram_join_of_near_copies(spark, monkeypatch):
    """Clusters of copies whose similarity lies about the threshold: most pairs do not link, and few are proposed."""
    rnd = random.Random(5)
    monkeypatch.setattr(ngram_join, "MEMBERS", 8)
    rows = []
    for cluster in range(3):
        base = [f"c{cluster}w{rnd.randrange(300)}" for _ in range(150)]
        for _ in range(90):
            edited = list(base)
            for _ in range(rnd.randrange(6)):
                edited[rnd.randrange(len(edited))] = f"e{rnd.randrange(10**6)}"
            rows.append((len(rows), " ".join(edited)))
    proposed = []
    put = ngram_join.Shelf.put

    def counted(self, df, name):
        out = put(self, df, name)
        if name == "pairs":
            proposed.append(out.count())
        return out

    monkeypatch.setattr(ngram_join.Shelf, "put", counted)
    sets = [data.shingle_set(t, 3) for _, t in rows]
    links = [(i, j) for i, a in enumerate(sets) for j in range(i) if 100 * len(a & (b := sets[j])) >= 90 * len(a | b)]
    expected = data.components(len(rows), links)
    got = ngram_join.join(data.table(spark, rows, 5), k=3, percent=90).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(expected))
    assert 3 < len(set(expected)) < len(rows)
    assert proposed[0] < 3 * 90 * 90 / 4


def test_exact(docs, monkeypatch):
    want = []
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[t or ""].append(i)
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known, default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        marks = Counter()
        for i in ids:
            kept = i == keep and not marks[i]
            marks[i] += 1
            want.append((i, keep, len(ids), kept, sha))
    got = [tuple(r) for r in exact.dedup(docs).collect()]
    assert data.ordered(got) == data.ordered(want)


@pytest.mark.parametrize("per_core", [16, 1])
def test_lines(docs, per_core, monkeypatch):
    monkeypatch.setattr(lines, "BUCKET_BYTES", 4096)
    monkeypatch.setattr(lines, "PER_CORE", per_core)
    rows = [(i, (t or "").split("\n")) for i, t in ROWS]
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()
    holders = defaultdict(list)
    for i, own in rows:
        for k in {key(x) for x in own}:
            if len(k) >= lines.LEAST_CHARS:
                holders[k].append(i)
    often = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= 3}
    want = []
    for i, own in rows:
        left = [x for x in own if key(x) not in often or often[key(x)] == i]
        want.append((i, len(own), len(own) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    got = [tuple(r) for r in lines.digests(docs).collect()]
    assert data.ordered(got) == data.ordered(want) and sum(r[2] for r in got) > 5


def test_line_state_is_reversible(docs):
    part, rest = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    both = lines.update(lines.update(None, part, 3), rest, 3)
    back = lines.update(both, rest, 3, -1)
    shape = lambda s: {r.shard: (bytes(r["keys"]), bytes(r.counts)) for r in s.collect() if len(r["keys"])}
    assert shape(back) == shape(lines.update(None, part, 3))
    nothing = lines.update(back, part, 3, -1)
    assert shape(nothing) == {} and not any(any(bytes(r["filter"])) for r in nothing.collect())
    given = lines.dedup(part, back, 3).select("doc_id", "n_dropped")
    assert given.exceptAll(lines.dedup(part).select("doc_id", "n_dropped")).count() == 0


def test_bpe_round_trip(docs):
    coded = bpe.encode(docs)
    got = coded.collect()
    assert data.ordered((r.doc_id, bytes(r.decoded).decode()) for r in got) == data.ordered((i, t or "") for i, t in ROWS)
    short = [(r.doc_id, len(r.ids), hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()) for r in got]
    seen = bpe.digests(docs).select("doc_id", "n_tokens", "ids_sha256").collect()
    assert data.ordered(short) == data.ordered(map(tuple, seen))
    back = bpe.decode(coded.select("doc_id", "ids", F.lit(1).alias("decoded")))
    assert data.ordered((r.doc_id, bytes(r.decoded)) for r in back.collect()) == data.ordered((r.doc_id, bytes(r.decoded)) for r in got)


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing(docs, capacity):
    whole = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    want = []
    for i, t in ROWS:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for p, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            want.append((i, p, at, len(own), zlib.crc32(own.tobytes())))
    got = packing.pack(docs, capacity=capacity, with_ids=True).collect()
    assert data.ordered((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == data.ordered(want)
    sequences = defaultdict(list)
    for r in got:
        assert len(r["ids"]) == r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    least = sum(r.length for r in got) / capacity
    assert len(sequences) <= 1.1 * least + 2


def test_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 8))
    near = base[:20] + rng.normal(0, 0.12, (20, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([base, near]))]
    rows += [(100 + i, (base[0] * (i + 1)).tolist()) for i in range(30)]
    rows += [(None, base[1].tolist()), (5, base[2].tolist()), (200, None), (201, []), (202, [0.0] * 8), (203, [1.0, 2.0]),
             (204, [float("nan")] * 8), (205, [float("inf")] + [0.0] * 7), (206, [None] + [1.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("c") for c in ("key", "x", "n", "cell")})
    good = [k for k, (_, v) in enumerate(rows) if v and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)]
    unit = {k: np.array(rows[k][1]) / np.linalg.norm(rows[k][1]) for k in good}
    links = [(a, b) for a in good for b in good if a < b and unit[a] @ unit[b] >= 0.9]
    number = Counter(k for pair in links for k in pair)
    least = data.least_ids(rows, data.components(len(rows), links))
    want = [(i, number[k], least[k], i == least[k] if i is not None else least[k] is None) for k, (i, _) in enumerate(rows)]
    got = [tuple(r) for r in vectors.dedup(df).collect()]
    assert data.ordered(got) == data.ordered(want)
    assert vectors.dedup(df.limit(0)).count() == 0


def test_vector_recall_with_many_cells(spark, monkeypatch):
    monkeypatch.setattr(vectors, "PER_CELL", 25)
    monkeypatch.setattr(vectors, "BLOCK", 16)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    unit = np.array([r.embedding for r in rows], np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(1) - 1
    got = np.array([r.n_links for r in vectors.dedup(df).orderBy("vec_id").collect()])
    assert (got <= want).all() and got.sum() >= 0.9 * want.sum()


def test_lines_shuffles_documents_once(spark, docs, tmp_path):
    """Columns that are kept do not make the second pass shuffle the documents again."""
    docs.write.parquet(str(tmp_path / "docs"))
    names = ("doc_id", "n_lines", "n_dropped", "kept_text")
    kept = lines.dedup(spark.read.parquet(str(tmp_path / "docs")), keep=("lang", "source"))
    rows = kept.collect()
    assert "ReusedExchange" in kept._jdf.queryExecution().executedPlan().toString()
    assert data.ordered(tuple(r[n] for n in names) for r in rows) == data.ordered(tuple(r) for r in lines.dedup(docs).collect())


def test_passages_and_their_removal(spark):
    import random

    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    some = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    shared = [some(60 + 10 * i) for i in range(4)]
    rows, truth = [], {}
    for d in range(60):
        text = some(rnd.randint(5, 120))
        if d % 3 == 0:
            passage = list(shared[d % 4])
            if d % 9 == 0:
                passage[len(passage) // 2] = "edited"
            head = some(rnd.randint(0, 60))
            text = head + passage + some(rnd.randint(0, 60))
            truth[d] = (d % 4, len(head), len(passage))
        rows.append((d, "  ".join(text)))
    rows += [(70, None), (71, ""), (72, "short"), (None, " ".join(some(9) + shared[0])), (73, "a b " * 200), (73, "a b " * 200)]
    docs = data.table(spark, rows)
    found = passages.find(docs).collect()
    first = {}
    for d, (k, _, _) in sorted(truth.items()):
        first.setdefault(k, d)
    hit = {r.doc_id for r in found} | {r.match_id for r in found}
    assert set(truth) <= hit and {r.doc_id for r in found} - {None} <= set(truth)
    for r in found:
        if r.doc_id is not None:
            k, start, n = truth[r.doc_id]
            assert abs(r.start - start) <= 1 and abs(r.n_words - n) <= 2 and r.similarity >= 0.8
    spans = defaultdict(set)
    for r in found:
        spans[r.doc_id].update(range(r.start, r.start + r.n_words))
    for r in passages.dedup(docs).collect():
        text = dict((i, t) for i, t in rows if i is not None).get(r.doc_id) if r.doc_id is not None else rows[63][1]
        left = [w for n, w in enumerate((text or "").split()) if n not in spans[r.doc_id]]
        assert r.kept_text.split() == left and r.n_dropped == len(spans[r.doc_id])


def passage_exists(one, two):
    """Whether two texts whose words are all different share a stretch that begins and ends with equal shingles."""
    first, second = ([tuple(t[i : i + 5]) for i in range(len(t) - 4)] for t in (one, two))
    place = {s: i for i, s in enumerate(first)}
    both = [(place[s], j) for j, s in enumerate(second) if s in place]
    for u, (i, j) in enumerate(both):
        for v, (k, m) in enumerate(both[u:]):
            total = (k - i + 1) + (m - j + 1) - (v + 1)
            if min(k - i, m - j) + 5 >= 50 and v + 1 >= 0.8 * total:
                return True
    return False


def test_passages_with_edits_against_brute_force(spark):
    """Pairs of texts with 1 to 4 edits of a passage of 50 to 110 words; no pair of enough similarity is missed."""
    import random

    rnd = random.Random(11)
    fresh = (f"v{i}" for i in range(10**9))
    some = lambda n: [next(fresh) for _ in range(n)]
    rows, want = [], set()
    for d in range(400):
        passage = some(50 + d % 60)
        edited = list(passage)
        for _ in range(1 + d % 4 if d % 3 else 1):
            at = rnd.randrange(len(edited))
            edited[at : at + 1] = rnd.choice([[], some(1), [edited[at], *some(1)]])
        one, two = some(20) + passage + some(20), some(rnd.randrange(30)) + edited + some(9)
        rows += [(2 * d, " ".join(one)), (2 * d + 1, " ".join(two))]
        if passage_exists(one, two):
            want.add((2 * d + 1, 2 * d))
    found = passages.find(data.table(spark, rows)).collect()
    assert len(want) > 200 and {(r.doc_id, r.match_id) for r in found} == want


def test_passages_with_a_word_replaced(spark):
    """Passages of 50 words with one word replaced have a similarity of 0.804 and are all found."""
    fresh = (f"v{i}" for i in range(10**9))
    some = lambda n: [next(fresh) for _ in range(n)]
    rows = []
    for d in range(400):
        passage = some(50)
        at = 5 + d % 40
        rows.append((2 * d, " ".join(some(60) + passage + some(60))))
        rows.append((2 * d + 1, " ".join(some(60) + passage[:at] + some(1) + passage[at + 1 :] + some(60))))
    found = passages.find(data.table(spark, rows)).collect()
    assert {(r.doc_id, r.match_id) for r in found} == {(2 * d + 1, 2 * d) for d in range(400)}


def test_passages_whose_pieces_have_smaller_ids(spark):
    """Pieces of under 50 words with the smallest ids hold every key; those that hold the whole still find it."""
    fresh = (f"v{i}" for i in range(10**9))
    some = lambda n: [next(fresh) for _ in range(n)]
    passage = some(64)
    pieces = [some(50) + passage[i % 3 * 12 : i % 3 * 12 + 40] + some(50) for i in range(12)]
    whole = [some(30) + passage + some(40) for _ in range(15)]
    rows = [(i, " ".join(t)) for i, t in enumerate(pieces + whole)]
    found = passages.find(data.table(spark, rows)).collect()
    assert {(r.doc_id, r.n_words) for r in found} == {(i, 64) for i in range(13, 27)}
    assert all(12 <= r.match_id < r.doc_id for r in found)


def test_a_text_is_sent_to_a_cell_once(spark, monkeypatch):
    """Forty texts that all meet are not sent once for each of their 780 pairs."""
    monkeypatch.setattr(passages, "AT_ONCE", 8)
    texts = spark.createDataFrame([(d, f"text {d}", d, 7) for d in range(40)], "doc long, text string, h long, size int")
    pairs = spark.createDataFrame([(a, b) for b in range(40) for a in range(b)], "a long, b long")
    rows = passages._cells(pairs, texts).collect()
    cells = defaultdict(set)
    for r in rows:
        if not r.pair:
            assert r.doc not in cells[r.cell] and r.text == f"text {r.doc}"
            cells[r.cell].add(r.doc)
    met = [(r.doc, r.b) for r in rows if r.pair]
    assert sorted(met) == [(a, b) for a in range(40) for b in range(a + 1, 40)] and len(cells) == 9
    assert all({r.doc, r.b} <= cells[r.cell] for r in rows if r.pair) and len(rows) - len(met) <= 40 * 6


def test_stretches_that_passages_cover(spark):
    import random

    rnd = random.Random(15)
    made = {(d, d % 2, rnd.randrange(400), rnd.randrange(1, 30)) for d in range(30) for _ in range(rnd.randrange(1, 40))}
    found = spark.createDataFrame(list(made), "doc long, text_hash long, start int, n_words int")
    for r in passages._spans(found).collect():
        covered = {c for d, _, s, n in made if d == r.doc for c in range(s, s + n)}
        assert sorted(c for s in r.spans for c in range(s.start, s.stop)) == sorted(covered) and r.h == r.doc % 2
    assert passages._spans(found).count() == 30


def test_classifiers_on_odd_tables(spark, docs, none):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    tongues = langid.train(real, "doc_id", "text", "lang", 40)
    good = quality.train(real, labels, "doc_id", "text", "quality", 150)
    bad = toxicity.train(real, labels, "doc_id", "text", "toxic", 300)
    for frame, n in ((docs, len(ROWS)), (none, 0)):
        said = langid.predict(frame, tongues).collect()
        assert len(said) == n and all(0 <= r.score <= 1 for r in said)
        graded = toxicity.score(frame, bad).collect()
        assert len(graded) == n and all(0 <= r.severity <= 3 for r in graded)
        scored = quality.score(frame, good, keep=("source", "score")).collect()
        assert len(scored) == n and all(r.predicted == (r[3] >= quality.THRESHOLD) for r in scored)
    blank = {t for _, t in ROWS if not t or not any(c.isalpha() for c in t)}
    said = langid.predict(docs.withColumn("lang", F.lit(None)), tongues)
    assert said.where("lang_pred = 'und'").count() == sum(t in blank for _, t in ROWS)
    silent = quality.train(real, labels.limit(0), "doc_id", "text", "quality")
    assert {r.score for r in quality.score(docs, silent).collect()} == {0.5}
    assert toxicity.score(docs, toxicity.train(real, labels.limit(0), "doc_id", "text", "toxic")).where("toxic").count() == 0
    assert langid.predict(docs, langid.train(none, "doc_id", "text", "lang")).where("lang_pred <> 'und'").count() == 0


def test_empty_tables(none):
    for made in (
        ngram_join.join(none), exact.dedup(none), lines.dedup(none), bpe.digests(none), packing.pack(none),
        passages.find(none), passages.dedup(none),
    ):
        assert made.count() == 0
