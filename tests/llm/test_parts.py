"""The parts that run inside tasks or on the driver, against brute force and without Spark."""

from __future__ import annotations

import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tablekit.llm import bpe, exact, langid, lines, packing, passages, quality, toxicity, vectors, words
from tests.llm import data


def odd_texts(seed=2, n=600):
    rnd = random.Random(seed)
    letters = "ab'stre  \n\t\r1٣é€中\x1c\x85!?,😀\0ABCß"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80))) for _ in range(n)]
    return texts + ["", " ", "x" * 5000, " " * 300, "a b" * 2000, "ab.", "I'm it's 12 3ab", "<|endoftext|> x<|endoftext|>"]


@pytest.mark.parametrize("piece", [16, 64, 1 << 20])
def test_words_and_shingles(monkeypatch, piece):
    monkeypatch.setattr(words, "PIECE", piece)
    texts = [*odd_texts(), None]
    hashes, starts, ends, bounds, heads = words.words(*words.texts(pa.array(texts)), (2,))
    codes, cut = words.shingles(hashes, bounds, 3)
    seen, shingles, begun = {}, {}, {}
    for i, text in enumerate(texts):
        found = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
        own = hashes[bounds[i] : bounds[i + 1]]
        assert len(found) == len(own)
        for word, code, head in zip(found, own, heads[0][bounds[i] : bounds[i + 1]]):
            assert seen.setdefault(word, code) == code and begun.setdefault(word[:2], head) == head
        runs = [tuple(found[j : j + 3]) for j in range(len(found) - 2)] or ([tuple(found)] if found else [])
        assert len(runs) == cut[i + 1] - cut[i]
        for run, code in zip(runs, codes[cut[i] : cut[i + 1]]):
            assert shingles.setdefault(run, code) == code
    for known in (seen, shingles, begun):
        assert len(set(known.values())) == len(known)
    assert (ends > starts).all()


def test_compact_windows():
    rng = np.random.default_rng(1)

    def brute(values, bounds, width):
        out = []

        def split(left, right):
            if right - left + 1 >= width:
                at = left + int(np.argmin(values[left : right + 1]))
                out.append((left, at, right))
                split(left, at - 1)
                split(at + 1, right)

        for d in range(len(bounds) - 1):
            split(int(bounds[d]), int(bounds[d + 1]) - 1)
        return sorted(out)

    for _ in range(200):
        bounds = np.concatenate([[0], np.cumsum(rng.integers(0, 40, rng.integers(1, 6)))])
        values = rng.integers(1, rng.choice([5, 1000]), bounds[-1]).astype(np.uint64)
        width = int(rng.integers(1, 9))
        got = passages.compact_windows(values, bounds, width)
        assert sorted(zip(*(x.tolist() for x in got))) == brute(values, bounds, width)


def test_alignment_finds_edited_and_ignores_short_runs():
    rng = np.random.default_rng(3)
    shared = rng.integers(1, 1 << 60, 90)
    one = np.concatenate([rng.integers(1, 1 << 60, 30), shared, rng.integers(1, 1 << 60, 9)])
    two = np.concatenate([rng.integers(1, 1 << 60, 7), shared[:40], rng.integers(1, 1 << 60, 5), shared[45:]])
    found = passages.align(one, two, [(40, 17), (110, 87)])
    assert [(f[0], f[1], f[2], f[3]) for f in found] == [(7, 94, 30, 94)] and found[0][4] > 0.8
    assert passages.align(one, np.concatenate([shared[:30], one[:2]]), [(35, 5)]) == []


def test_texts_that_cannot_share_a_passage_are_not_aligned(monkeypatch):
    """Words said 22 to 35 times share shingles on very many diagonals, but no 50 words."""
    one, two = (np.repeat(np.arange(low, low + 6 * step, step), n) for low, step, n in ((1, 1, 22), (1, 2, 35)))
    places = [(i, j) for i in range(0, 18, 3) for j in range(0, 30, 3)]
    with monkeypatch.context() as patched:
        patched.setattr(passages, "_runs", lambda *_: pytest.fail("aligned"))
        assert passages.align(one[:40], two, places) == []
        assert passages.align(two, one[:40], places) == []
    assert passages.align(two, two, [(0, 0)]) == [(0, len(two) + 4, 0, len(two) + 4, 1.0)]


def test_a_stretch_that_may_hold_a_passage():
    rng = np.random.default_rng(5)
    for _ in range(300):
        equal = rng.random(rng.integers(1, 120)) < rng.choice([0.6, 0.75, 0.85])
        codes = np.where(equal, 7, 9).astype(np.uint64)
        others = np.full(60, 7, np.uint64)
        want = any(
            5 * equal[i:j].sum() >= 4 * (j - i) for i in range(len(equal)) for j in range(i + 46, len(equal) + 1)
        )
        assert passages._may_hold(codes, others) == want


def test_chains_against_brute_force():
    rng = np.random.default_rng(6)
    for _ in range(100):
        start = rng.integers(0, 120, 40)
        end, shift = start + rng.integers(1, 25, 40), rng.integers(-9, 10, 40)
        order = np.lexsort((shift, start, end))
        start, end, shift = start[order], end[order], shift[order]
        value, last, cut = (end - start) / 9, np.full(40, -1), np.zeros(40, int)
        for k in range(40):
            best = -np.inf
            for j in range(k):
                over = max(end[j] - start[k], end[j] + shift[j] - start[k] - shift[k], 0)
                here = start[k] + over - end[j]
                there = here + shift[k] - shift[j]
                if over < end[k] - start[k] and max(here, there) <= passages.GAP:
                    worth = value[j] + (end[k] - start[k] - over - 4 * (here + there)) / 9
                    if worth > best:
                        best, last[k], cut[k] = worth, j, over
            if last[k] >= 0:
                value[k] = best
        got = passages._chains(start, end, shift)
        assert got[0].tolist() == last.tolist() and got[1].tolist() == cut.tolist()


def said_again(rng, n):
    """Shingles of a text whose words are said again and again, and of some words after each other."""
    parts = [np.repeat(rng.integers(1, 12), rng.integers(1, 40)) for _ in range(n)]
    parts.append(rng.permutation(np.arange(100, 220))[: rng.integers(1, 120)])
    parts.append(np.arange(100, 220)[rng.integers(0, 60) :])
    return np.concatenate([parts[k] for k in rng.permutation(len(parts))]).astype(np.uint64)


def runs_that_hold(one, two, places):
    """Runs of equal shingles, one after the other: see ``passages._runs``."""
    runs, todo = set(), []

    def add(i, j):
        low = high = 0
        while i + low > 0 and j + low > 0 and one[i + low - 1] == two[j + low - 1]:
            low -= 1
        while i + high < len(one) and j + high < len(two) and one[i + high] == two[j + high]:
            high += 1
        run = (j + low, j + high, i - j)
        if high and run not in runs:
            runs.add(run)
            todo.append(run)

    for i, j in places:
        if one[i] == two[j]:
            add(i, j)
            for k in range(max(0, j - i), min(len(two), len(one) + j - i) - 9):
                if (one[k + i - j : k + i - j + 10] == two[k : k + 10]).all():
                    add(k + i - j, k)
    while todo:
        start, end, shift = todo.pop()
        for x in range(13):
            for y in range(13):
                for i, j in ((end + shift + x, end + y), (start + shift - 1 - x, start - 1 - y)):
                    if 0 <= i < len(one) and 0 <= j < len(two):
                        add(i, j)
    return sorted(runs, key=lambda r: (r[1], r[0], r[2]))


def test_pairs_side_by_side_against_each_alone():
    """Runs against brute force, and passages of many pairs at once against those of each pair."""
    rng = np.random.default_rng(12)
    ones, twos, places, found = [], [], [], 0
    for k in range(40):
        one, two = said_again(rng, 3), said_again(rng, 4)
        equal = np.argwhere(one[:, None] == two[None])
        ones.append(one)
        twos.append(two)
        places.append([tuple(p) for p in equal[rng.permutation(len(equal))[:5]].tolist()])
    texts = passages._Texts([*ones, *twos])
    texts.number(np.arange(80))
    pairs = passages._Pairs(texts, np.arange(40), np.arange(40, 80))
    at = tuple(np.array([(k, i, j) for k in range(40) for i, j in places[k]]).T)
    pair, *runs = passages._runs(pairs, at)
    own = passages._passages(pairs, at)
    worth = texts.worth_aligning(np.arange(40), np.arange(40, 80))
    for k in range(40):
        assert [tuple(r) for r in np.stack(runs, axis=1)[pair == k].tolist()] == runs_that_hold(ones[k], twos[k], places[k])
        alone = passages.align(ones[k], twos[k], places[k])
        got = sorted(zip(*(x[own[0] == k].tolist() for x in own[1:])))
        assert got == alone and (worth[k] or not alone)
        found += len(alone)
    assert found > 20


def test_texts_of_repeated_words_are_aligned_in_few_steps():
    """Words said 30 times share shingles on very many diagonals; these are not looked at one after the other."""
    import cProfile
    import pstats

    rng = np.random.default_rng(13)
    one, two = (np.concatenate([np.repeat(w, 26) for w in rng.permutation(40)]) for _ in range(2))
    places = [(26 * i, 26 * j) for i in range(40) for j in range(40) if one[26 * i] == two[26 * j]]
    calls = cProfile.Profile()
    calls.runcall(passages.align, one, two, places)
    assert pstats.Stats(calls).total_calls < 2000


def test_cells_cut_anywhere_hold_the_same_passages(monkeypatch):
    """Batches that end anywhere, and ids with two rows."""
    rng = np.random.default_rng(14)
    shared = [f"s{i}" for i in range(70)]
    text = {d: " ".join([*(f"d{d}w{i}" for i in range(rng.integers(0, 9))), *shared]) for d in range(9)}
    rows = []
    for cell in range(3):
        own = range(3 * cell, 3 * cell + 3)
        rows += [(cell, False, d, None, d + 100, text[d]) for d in own]
        rows.append((cell, False, 3 * cell + 1, None, 200, "no passage here"))
        rows += [(cell, True, a, b, None, None) for a in own for b in own if a < b]
    names = [part.split()[0] for part in passages._CELLS.split(", ")]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    whole = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    want = {(3 * c + b, 3 * c + a) for c in range(3) for a in range(3) for b in range(a + 1, 3)}
    for size in (1, 1 << 20):
        monkeypatch.setattr(passages, "GATHERED", size)
        for step in (1, 2, 3, 5, len(rows)):
            batches = [whole.slice(at, step) for at in range(0, len(rows), step)]
            found = [r for b in passages._verify(iter(batches)) for r in b.to_pylist()]
            assert sorted((r["doc"], r["match"]) for r in found) == sorted(want)
            assert all(r["n_words"] == 70 and r["text_hash"] == r["doc"] + 100 for r in found)


def test_codec_agrees_with_tiktoken():
    path = public_tokenizers.path(bpe.VOCABULARY)
    own = bpe.Codec(path, public_tokenizers.PATTERN)
    other = tiktoken.Encoding(
        "other", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={}
    )
    texts = odd_texts()
    for text, ids in zip(texts, own.encode_batch(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == other.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_a_full_memory_changes_no_ids(monkeypatch):
    path = public_tokenizers.path(bpe.VOCABULARY)
    texts = odd_texts(5, 200)
    want = bpe.Codec(path, public_tokenizers.PATTERN).encode_batch(texts)
    monkeypatch.setattr(bpe, "REMEMBERED", 40)
    own = bpe.Codec(path, public_tokenizers.PATTERN)
    assert [own.encode_batch([t])[0] for t in texts] == want and own.encode_batch(texts) == want


def test_encoder_agrees_with_the_tokenizer(monkeypatch):
    path = public_tokenizers.path(packing.VOCABULARY)
    whole = Tokenizer.from_file(path)
    texts = odd_texts(4)
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    for most in (packing.REMEMBERED, 10):
        monkeypatch.setattr(packing, "REMEMBERED", most)
        own = packing.Encoder(path)
        assert [np.frombuffer(own.encode(t), "<u4").tolist() for t in texts] == want


def test_plans_pack_every_piece_once_and_tightly():
    rng = np.random.default_rng(6)
    for capacity, n in ((64, 400), (2048, 3000), (2048, 3), (10, 50)):
        lengths = np.minimum(capacity, rng.geometric(4 / capacity, n))
        histogram = np.bincount(lengths, minlength=capacity + 1)
        made = packing.plan(histogram, capacity)
        used = np.zeros(capacity + 1, np.int64)
        for pieces, count in made:
            assert count > 0 and sum(pieces) <= capacity
            for length in pieces:
                used[length] += count
        assert (used == histogram).all()
        least = -(-lengths.sum() // capacity)
        if n > 100:
            assert sum(count for _, count in made) <= 1.02 * least + 1
        runs = packing.slots(made, capacity)
        assert len(np.unique(runs[:, :2], axis=0)) == len(runs)


def test_nnls_beats_nothing_and_stays_positive():
    kinds = packing.patterns(16, np.arange(17) > 0)
    target = np.bincount(np.random.default_rng(7).integers(1, 17, 500), minlength=17).astype(float)
    fitted = packing.nnls(kinds, target)
    assert (fitted >= 0).all()
    made = np.zeros(17)
    for kind, count in zip(kinds, fitted):
        for c in kind:
            made[c] += count
    assert ((made - target) ** 2).sum() < 0.3 * (target**2).sum()


def test_open_addressing_compares_contents():
    table = exact.Table(4)
    entries = [table.add(7, f"text {i}".encode()) for i in range(50)]
    assert [table.find(7, f"text {i}".encode()) for i in range(50)] == entries
    assert table.find(7, b"text 50") == -1 and table.find(8, b"text 1") == -1


def test_grace_partitions_until_buckets_fit(monkeypatch, tmp_path):
    monkeypatch.setattr(exact, "TABLE_BYTES", 700)
    rnd = random.Random(8)
    texts = [f"text {rnd.randrange(60)}".encode() * 3 for _ in range(400)]
    records = [(i, 1, i if i % 5 else None, i, exact._signed(exact._code(t)), t) for i, t in enumerate(texts)]
    got = {}
    for batch in exact._grace(iter(records), 0, str(tmp_path)):
        for row in batch.to_pylist():
            got[row["rep"]] = (row["keep_id"], row["group_size"])
    for i, text in enumerate(texts):
        same = [j for j, other in enumerate(texts) if other == text]
        assert got[i] == (max((j for j in same if j % 5), default=None), len(same))
    assert list(tmp_path.iterdir()) == []


def test_cuckoo_filter_forgets_what_is_deleted():
    rng = np.random.default_rng(9)
    keys = rng.integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    own = lines.Cuckoo(5000)
    assert own.insert(keys) and own.contains(keys).all()
    others = rng.integers(0, 1 << 63, (20000, 2)).astype(np.uint64)
    assert own.contains(others).mean() < 0.01
    own.delete(keys[:2500])
    assert own.contains(keys[2500:]).all() and own.contains(keys[:2500]).mean() < 0.01
    own.delete(keys[2500:])
    assert not own.table.any()


def test_shards_undo_insertions():
    rng = np.random.default_rng(10)
    one, two = (np.unique(rng.integers(0, 300, (200, 2)).astype(np.uint64), axis=0) for _ in range(2))
    own, alone = lines.Shard(), lines.Shard()
    for keys, sign in ((one, 1), (two, 1), (one, -1)):
        own.change(keys, np.full(len(keys), 3), sign)
    alone.change(two, np.full(len(two), 3))
    assert (own.keys == alone.keys).all() and (own.counts == alone.counts).all()
    own.change(two, np.full(len(two), 3), -1)
    assert len(own.keys) == 0 and not own.filter.table.any()


@pytest.mark.parametrize("kind", ["put in", "left out", "replaced", "said twice"])
def test_alignment_follows_edits_at_every_place(kind):
    """60 shared words with one edit; the only place given lies before or after it."""
    rng = np.random.default_rng(5)
    fold = lambda words: np.array([hash(tuple(words[i : i + 5].tolist())) for i in range(len(words) - 4)])
    shared, around = rng.integers(1, 1 << 40, 60), rng.integers(1, 1 << 40, 20)
    for at in range(5, 55):
        middle = {"put in": [7, *shared[at : at + 1]], "left out": [], "replaced": [7], "said twice": [shared[at]] * 2}[kind]
        edited = np.concatenate([shared[:at], np.array(middle, np.int64), shared[at + 1 :]])
        one = fold(np.concatenate([around[:10], shared, around[10:]]))
        two = fold(np.concatenate([around[15:], edited, around[:5]]))
        for place in [(10, 5), (65, 5 + len(edited) - 5)]:
            found = passages.align(one, two, [place])
            assert [f[:4] for f in found] == [(5, len(edited), 10, 60)] and found[0][4] >= 0.8



def test_components_of_chained_vectors_over_several_chunks():
    """Links of 1,500 home vectors and 500 guests on a circle, compared 512 rows at a time, against brute force."""
    rng = np.random.default_rng(8)
    angles = rng.uniform(0, 2 * np.pi, 2000)
    x = np.stack([np.cos(angles), np.sin(angles)], axis=1)
    threshold = float(np.cos(0.004))
    home = np.where(np.arange(2000) < 1500, 0, 1).astype(np.int32)
    close = x @ x.T >= threshold
    close[1500:, 1500:] = np.eye(500, dtype=bool)
    want = data.components(2000, [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(close, 1)))])
    rows = np.concatenate([np.arange(1500), rng.permutation(2000)])
    names = [b"%016d" % k for k in range(2000)]
    table = pa.table(
        {"cell": pa.array([0] * 3500, pa.int32()), "side": pa.array([0] * 1500 + [1] * 2000, pa.int32()),
         "home": pa.array(home[rows]), "key": pa.array([names[k] for k in rows], pa.binary()),
         "n": pa.array([1] * 3500, pa.int64()), "x": pa.array([x[k].tobytes() for k in rows], pa.binary()),
         "probes": pa.array([[0, 1]] * 3500, pa.list_(pa.int32()))}
    )
    made = vectors._compare((pa.scalar(0),), table, threshold)
    links = [(int(a), int(b)) for a, b in zip(made["key"].to_pylist(), made["root"].to_pylist())]
    assert data.components(2000, links) == want
    assert 100 < len(set(want)) < 1500


def test_spherical_kmeans_and_odd_vectors():
    rng = np.random.default_rng(11)
    truth = rng.normal(size=(5, 16))
    x = np.repeat(truth, 40, axis=0) + rng.normal(0, 0.05, (200, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres = vectors.kmeans(x, 5)
    assert np.allclose(np.linalg.norm(centres, axis=1), 1) and len(centres) == 5
    column = pa.array([[1.0, 0.0], None, [0.0, 0.0], [float("nan"), 1.0], [1.0, None], [], [1e200, 1e200], [3.0, 4.0]], pa.list_(pa.float64()))
    good, unit = vectors.normalised(column)
    assert good.tolist() == [True, False, False, False, False, False, True, True]
    assert np.allclose(np.linalg.norm(unit, axis=1), 1)


def test_gradients_of_attention():
    rng = np.random.default_rng(12)
    features, cut = rng.normal(size=(9, quality.FEATURES)), np.array([0, 1, 4, 9])
    target, weight = np.array([1.0, 0.0, 1.0]), np.array([0.2, 0.5, 0.3])
    model = quality.Model()

    def loss():
        p = model.score(features, cut)
        return -(weight * (target * np.log(p) + (1 - target) * np.log(1 - p))).sum() / weight.sum()

    got = model.gradients(features, cut, target, weight)
    for name, value in model.weights.items():
        flat = np.array(value, np.float64)
        for at in [()] if flat.ndim == 0 else [tuple(rng.integers(0, flat.shape)) for _ in range(4)]:
            sides = []
            for step in (1e-5, -1e-5):
                moved = flat.copy()
                moved[at] += step
                model.weights[name] = moved
                sides.append(loss())
            model.weights[name] = flat
            assert abs((sides[0] - sides[1]) / 2e-5 - got[name][at]) < 1e-6


def test_ordinal_regression_orders_grades():
    rng = np.random.default_rng(13)
    codes = np.arange(40)
    grades = rng.integers(0, 4, 600)
    rows = []
    for g in grades:
        noise = rng.choice(30, 5, replace=False)
        telling = 30 + rng.choice(10, 3 * g, replace=False) if g else np.zeros(0, int)
        own = np.sort(np.concatenate([noise, telling]))
        rows.append((own, np.ones(len(own), int)))
    model = toxicity.fit(rows, grades, codes)
    assert (np.diff(model.thresholds) > 0).all() and model.weights[30:].min() > model.weights[:30].max()
    cut = np.concatenate([[0], np.cumsum([len(c) for c, _ in rows])])
    eta = model.eta(np.concatenate([c for c, _ in rows]), np.concatenate([n for _, n in rows]), cut)
    severity = model.above(eta).sum(1)
    assert np.corrcoef(severity, grades)[0, 1] > 0.95 and ((severity >= toxicity.THRESHOLD) == (grades > 0)).mean() > 0.98


def test_passage_features_of_odd_texts():
    features, cut = quality.passages(pa.array([None, "", " ", "Word", "a b " * 100, "x" * 9000]))
    assert cut.tolist() == [0, 1, 2, 3, 4, 8, 9] and np.isfinite(features).all() and not features[0].any()
    assert langid.subwords(np.zeros(0, np.uint8)).sum() == 1


def test_interval_join_of_windows():
    rng = np.random.default_rng(14)
    for _ in range(200):
        n = int(rng.integers(1, 25))
        left = rng.integers(0, 60, (n, 2))
        right = left + rng.integers(0, 20, (n, 2))
        rows = np.stack([rng.integers(0, 4, n), left[:, 0], left[:, 0], right[:, 0], left[:, 1], left[:, 1], right[:, 1]], axis=1)
        want = set()
        for one in rows:
            meets = {
                two[0] for two in rows
                if two[1] <= one[3] and two[3] >= one[1] and two[4] <= one[6] and two[6] >= one[4]
            }
            if len(meets) >= passages.ENOUGH:
                want.add((int(one[2]), int(one[5])))
        assert set(passages.enough(rows)) == want


def test_line_buckets_share_a_bounded_number_of_partitions():
    buckets = -(-(1 << 40) // lines.BUCKET_BYTES)
    assert buckets == 262_144 and lines.partitions(buckets, 4000) == 64_000 and lines.partitions(buckets, 6) == 96
    assert lines.partitions(5, 8) == 5 and lines.partitions(1, 0) == 1

