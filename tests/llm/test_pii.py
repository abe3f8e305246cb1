"""Personal data: the rules against plain regular expressions, the trees, and odd tables."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from tablekit.llm import boosting, pii
from tests.llm import data

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            right = (
                True, kind == 1 and all(int(p) <= 255 for p in m.group().split(".")),
                12 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15,
            )[kind]
            if right:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def card(rnd):
    digits = "4" + "".join(rnd.choice("0123456789") for _ in range(14))
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def corpus(n=400, seed=3):
    rnd = random.Random(seed)
    words = lambda k: " ".join(rnd.choice(["here", "is", "what", "people", "say", "ñandú", "about"]) for _ in range(k))
    rows = []
    for i in range(n):
        many = rnd.randrange
        found = [
            f"u.{many(99)}@mail{many(9)}.example.com", ".".join(str(many(1, 255)) for _ in range(4)), card(rnd),
            f"+1 ({many(200, 999)}) 555-{many(1000, 9999)}", f"version {many(9)}.{many(9)}", str(many(10**13, 10**15)),
            f"300.{many(99)}.400.{many(99)}",
        ]
        rnd.shuffle(found)
        rows.append((i, ". ".join(f"{words(5)} {x} {words(4)}" for x in found[:4])))
    return rows


def spans(row):
    return [(s.start, pii.KINDS.index(s.kind), s.end) for s in row.spans if not s.added]


def test_rules_agree_with_plain_expressions():
    rnd = random.Random(1)
    pieces = ["@", ".", "-", "+", " ", "(", ")", "_", "a", "0", "12", "255", "é", "\n", "%", "4111 1111", "1.2", "a@b.c", "+1 (23"]
    for _ in range(20000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randrange(40)))
        assert pii.rules(text)[0] == brute(text), text


def test_long_runs_take_time_in_proportion():
    for text in ("x" * 200_000, "1" * 200_000, "+1 " * 70_000, "+1" + " " * 200_000, "a@" * 100_000, "a@b" * 70_000):
        assert all(b <= len(text) for _, _, b in pii.rules(text)[0]) and list(pii.candidates(text)) is not None


@pytest.fixture(scope="module")
def trained(spark):
    return pii.train(data.table(spark, corpus()))


def test_spans(spark, trained):
    rows = data.odd_rows() + corpus(60, 5) + [(900, None), (901, "a@b.cd"), (901, "a@b.cd"), (None, "mail a@b.cd"), (902, "1" * 30000)]
    docs = data.table(spark, rows)
    got = [(r.doc_id, spans(r)) for r in pii.find(docs, trained).collect()]
    assert data.ordered(got) == data.ordered((i, brute(t or "")) for i, t in rows)
    digests = {(r.doc_id, r.base_sha256): r for r in pii.digests(docs, trained).collect()}
    for i, text in rows:
        base = brute(text or "")
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        row = digests[i, hashlib.sha256(joined.encode()).hexdigest()]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == own for _, k, _ in base) for own in range(4)]
        assert set(joined.split(",")) <= set(row.spans.split(","))
    masked = {r.redacted for r in pii.redact(docs, trained).where("doc_id = 901").collect()}
    assert masked == {"[EMAIL]"}


def test_the_model_adds_what_the_rules_lose(trained):
    """Spans that a rule loses in a longer run or another way of writing; not what only looks like one."""
    number = card(random.Random(9))
    texts = [
        f"people say {number} 10.20.30.40 about", f"what is +1 (605) 555-9305 {number} here", f"here is {number} {number} about",
        "people say 10[.]20[.]30[.]40 here", "version 3.1 of 2024 is here", "no 12345 and 300.20.400.30 here",
    ]
    found = [{text[a:b] for a, _, b, _ in own} for text, own in zip(texts, pii._scan(trained, texts))]
    assert found[0] == {number, "10.20.30.40"} and found[1] == {number, "+1 (605) 555-9305"} and found[2] == {number}
    assert found[3] == {"10[.]20[.]30[.]40"} and found[4] == set() and found[5] == set()
    for text, own in zip(texts, pii._scan(trained, texts)):
        base = set(brute(text))
        added = [s for s in own if s[3]]
        assert {s[:3] for s in own if not s[3]} == base
        assert all(a >= d or c >= b for a, _, b, _ in added for c, _, d in base)


def test_without_evidence_nothing_is_added(spark):
    docs = data.table(spark, [(i, f"only {i} numbers (743) 555-3824") for i in range(30)])
    assert pii.train(docs) == {}
    assert pii.find(docs).where("size(spans) > 0").count() == 0
    assert pii.find(data.empty(spark)).count() == 0


def plain_score(model, row):
    total = model.start
    for feature, bound, value in model.trees:
        node = 0
        while node < len(feature):
            node = 2 * node + 1 + int(row[feature[node]] > bound[node])
        total += value[node - len(feature)]
    return total


def test_trees():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 6, (3000, 5)).astype(float)
    x[:, 4] = rng.normal(size=3000)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 3)).astype(float)
    model = boosting.Boosted().fit(x[:2000], y[:2000], np.ones(2000))
    raw = model.raw(x)
    assert np.allclose(raw[:200], [plain_score(model, row) for row in x[:200]])
    assert ((raw[2000:] > 0) == y[2000:]).mean() > 0.99
    loss = lambda rounds: np.log1p(np.exp(-(2 * y[:2000] - 1) * boosting.Boosted().fit(x[:2000], y[:2000], np.ones(2000), rounds).raw(x[:2000]))).mean()
    assert loss(1) > loss(5) > loss(20)


def test_calibration():
    raw, y = np.array([0.0, 1, 1, 2, 3, 4, 5]), np.array([0.0, 1, 0, 0, 1, 1, 1])
    fitted = boosting.Calibration(raw, y)(np.array([-1.0, 0, 1, 2, 3, 9]))
    assert np.allclose(fitted, [0, 0, 1 / 3, 1 / 3, 1, 1]) and (np.diff(fitted) >= 0).all()
    assert boosting.threshold(fitted[1:], np.array([0, 0, 1, 1, 1]), 0.99, 2) == 1.0
    assert boosting.threshold(fitted[1:], np.array([0, 0, 1, 1, 0]), 0.99, 1) == np.inf
