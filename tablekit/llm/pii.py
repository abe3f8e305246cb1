"""Personal data: rules, high-recall candidates beside them, and boosted trees that choose among the candidates."""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm import words
from tablekit.llm.boosting import Boosted, Calibration, threshold
from tablekit.llm.store import Shelf, ship

KINDS = ("email", "ip", "card", "phone")
#: Characters before and after a span that its features may see.
CONTEXT = 32
#: Most documents that are learnt from, and most examples of each kind in one of them; both are chosen by hashes.
SAMPLE, EXAMPLES = 3000, 24
#: Share of the held examples beyond a threshold that must be right, and the least number of right ones.
PRECISION, LEAST = 0.99, 20

# The rules of the four kinds.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CARD_DIGITS, _PHONE_DIGITS = (12, 19), (9, 15)

_GROUP = re.compile(r"[0-9]+")
_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    """Whether a string of digits passes the Luhn check."""
    odd, even = digits[-1::-2], digits[-2::-2]
    doubled = sum((2 * int(d)) // 10 + (2 * int(d)) % 10 for d in even)
    return (sum(map(int, odd)) + doubled) % 10 == 0


def _octets(text: str) -> bool:
    """Whether all parts are at most 255, however long they are written."""
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        head = text[end:at]
        start = end + len(head.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
        end = found.end() if found else at + 1
        at = text.find("@", end)


def rules(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Spans of the rules as (start, kind, end), and the matches that fail their check.

    Matches are leftmost and do not overlap within a kind; one that fails is dropped and not tried again. All take
    time in proportion to the text: runs are entered at their start only.
    """
    good = [(a, 0, b) for a, b in _emails(text)]
    bad: list[tuple[int, int, int]] = []
    if _GROUP.search(text):
        for m in _IP.finditer(text):
            (good if _octets(m.group()) else bad).append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = _DIGITS.sub("", m.group()) if m.end() - m.start() <= 2 * _CARD_DIGITS[1] else ""
            right = _CARD_DIGITS[0] <= len(digits) <= _CARD_DIGITS[1] and luhn(digits)
            (good if right else bad).append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            right = _PHONE_DIGITS[0] <= len(_DIGITS.sub("", m.group())) <= _PHONE_DIGITS[1]
            (good if right else bad).append((m.start(), 3, m.end()))
    return sorted(good), bad


_AT = re.compile(r"@|[(\[]\x20?at\x20?[)\]]|\x20at\x20", re.IGNORECASE)
_HOST = re.compile(
    r"\x20?[\w-]{1,63}(?:(?:\.|\x20?[(\[]\x20?(?:dot|\.)\x20?[)\]]\x20?|\x20dot\x20)[\w-]{1,63})+", re.IGNORECASE
)
_NAME = re.compile(r"[\w.%+-]{1,64}\x20?$")
_DOT = re.compile(r"\.|\x20?[(\[]\.[)\]]\x20?|\x20\.\x20")
_GAP = re.compile(r"[\x20().\-/]{1,3}")


def candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """Whatever may be personal data, as (start, kind, end): spans of a kind may overlap, and most are wrong.

    Digits are taken in runs of groups, from every group to every later one within the kind's number of digits.
    """
    for m in _AT.finditer(text):
        name = _NAME.search(text, max(0, m.start() - 65), m.start())
        host = _HOST.match(text, m.end())
        if name and host and name.group().strip():
            yield name.start(), 0, host.end()
    groups = [m.span() for m in _GROUP.finditer(text)]
    for i, (start, end) in enumerate(groups):
        digits, j, parts, dotted = end - start, i, 1, True
        while digits <= _CARD_DIGITS[1]:
            stop = groups[j][1]
            if parts == 4 and dotted:
                yield start, 1, stop
            if digits >= _CARD_DIGITS[0]:
                yield start, 2, stop
            if _PHONE_DIGITS[0] <= digits <= _PHONE_DIGITS[1]:
                yield _phone_start(text, start, stop), 3, stop
            j += 1
            if j == len(groups):
                break
            gap = text[stop : groups[j][0]] if groups[j][0] - stop <= 5 else ""
            dotted = dotted and bool(_DOT.fullmatch(gap))
            if not (dotted or _GAP.fullmatch(gap)):
                break
            digits += groups[j][1] - groups[j][0]
            parts += 1


def _phone_start(text: str, start: int, stop: int) -> int:
    if start and text[start - 1] == "(" and ")" in text[start:stop]:
        start -= 1
    return start - 1 if start and text[start - 1] == "+" else start


# Words before a span that speak for its kind, or against all.
_CUES = (
    re.compile(r"mail|contact|write|address", re.IGNORECASE), re.compile(r"\bip\b|server|host|addr", re.IGNORECASE),
    re.compile(r"card|visa|credit|pay", re.IGNORECASE), re.compile(r"phone|tel|call|mobile|fax", re.IGNORECASE),
)
_AGAINST = re.compile(r"version|\bv$|section|isbn|order|invoice|serial|\bid\b|#", re.IGNORECASE)
FEATURES = 32


def _class(char: str) -> int:
    if not char or char.isspace():
        return 0
    return 1 if char.isalpha() else 2 if char.isdigit() else 3 if char in ".,;:!?" else 4


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Numbers on a span's format, and on at most ``CONTEXT`` characters on either side of it."""
    span = text[start:end]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    groups = _GROUP.findall(span)
    sizes = [len(g) for g in groups] or [0]
    digits = "".join(groups)
    gaps = _GROUP.split(span)[1:-1]
    host = re.split(r"@|\bat\b", span, maxsplit=1, flags=re.IGNORECASE)[-1]
    labels = [p for p in re.split(r"[^\w-]+|\bdot\b", host) if p]
    left, right = before.rstrip(), after.lstrip()
    wide = lambda s: sum(map(str.isalpha, s)) / max(len(s), 1)
    return [
        len(span), len(digits), sum(map(str.isalpha, span)), span.count(" "), span.count("-"), span.count("."),
        span.count("(") + span.count(")"), span.count("/"), span.startswith("+"), len(groups), max(sizes), min(sizes),
        sizes[0], sizes[-1], bool(digits) and luhn(digits), max((int(g[:4]) for g in groups), default=0),
        sum(len(g) > 1 and g[0] == "0" for g in groups), len(set(digits)) / max(len(digits), 1), len(set(gaps)),
        max(map(len, gaps), default=0), span.count("@"), len(labels), len(labels[-1]) if labels else 0,
        bool(labels) and labels[-1].isalpha(), span.startswith("00"), _class(before[-1:]), _class(after[:1]),
        left[-1:].isdigit(), right[:1].isdigit(), sum(map(str.isdigit, before + after)), wide(before + after),
        2 * bool(_CUES[kind].search(before)) - 3 * bool(_AGAINST.search(before)),
    ]


# Ways to write the at sign and the dots of an address.
_WAYS = ((" at ", " dot "), ("(at)", "(dot)"), ("[at]", "[dot]"), (" (at) ", "."), (" [at] ", "[.]"), (" @ ", "."))


def _rewritten(kind: int, span: str) -> Iterator[tuple[str, int]]:
    """Other ways to write a span that a rule found (1), and what looks like it but is none (0)."""
    digits = _DIGITS.sub("", span)
    if kind == 0:
        name, host = span.split("@", 1)
        plain = re.sub(r"[0-9]+", "", name).strip("._%+-") or name, re.sub(r"[0-9]+", "", host).strip("-.") or host
        for (name, host), (at, dot) in product(((name, host), plain), _WAYS):
            yield name + at + host.replace(".", dot), 1
        for name, host in (span.split("@", 1), plain):
            yield f"{name} at {host}", 0
            yield f"{name} at {host.split('.')[0]}.{name.capitalize()}", 0
    elif kind == 1:
        parts = span.split(".")
        for dot in ("[.]", "(.)", " . "):
            yield dot.join(parts), 1
        for k in range(4):
            worse = [str(300 + int(p[-2:])) if j == k else p for j, p in enumerate(parts)]
            yield ".".join(worse), 0
            yield "[.]".join(worse), 0
    elif kind == 2:
        four = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        other = digits[:-1] + str((int(digits[-1]) + 1 + int(digits[0]) % 8) % 10)
        wrong = [other[k : k + 4] for k in range(0, len(other), 4)]
        for gap in (".", "/", "  ", " - "):
            yield gap.join(four), 1
            yield gap.join(wrong), 0
        yield other, 0
        yield " ".join(wrong), 0
    else:
        plain = span[1:]
        yield plain, 1
        yield "00" + plain, 1
        for gap in ("-", ".", " "):
            yield re.sub(r"[\x20().-]+", gap, plain).strip(gap), 1
        local = re.search(r"\([0-9]+\).*", plain)
        if local and len(_DIGITS.sub("", local.group())) >= _PHONE_DIGITS[0]:
            yield local.group(), 1
            for gap in ("-", ".", " "):
                yield re.sub(r"[\x20().-]+", gap, local.group()).strip(gap), 1
        yield digits, 0
        yield ".".join((digits[:-2], digits[-2:])), 0
        yield f"{digits[:4]}-{digits[4:6]}-{digits[6:8]} {digits[8:10]}", 0
        yield "/".join((digits[:2], digits[2:4], digits[4:])), 0
        yield " ".join(digits), 0


def examples(text: str) -> Iterator[tuple[int, int, list[float]]]:
    """(kind, target, features) from the rules: there are no labels of personal data.

    1: spans of a rule, and the same written otherwise in their place. 0: candidates that overlap one without being it
    or lie in a match that fails its check, and spans rewritten into what is none. Candidates away from all matches
    are left out: they are what the model has to judge.
    """
    good, bad = rules(text)
    spans = {(a, k, b) for a, k, b in good}
    for a, k, b in good:
        yield k, 1, features(text, k, a, b)
        before, after = text[max(0, a - CONTEXT) : a], text[b : b + CONTEXT]
        for other, target in _rewritten(k, text[a:b]):
            yield k, target, features(before + other + after, k, len(before), len(before) + len(other))
    right, wrong = _cover(len(text), good), _cover(len(text), bad)
    for a, k, b in candidates(text):
        if (a, k, b) in spans:
            continue
        failed = wrong[b] > wrong[a] and not (k == 2 and luhn(_DIGITS.sub("", text[a:b])))
        if right[b] > right[a] or failed:
            yield k, 0, features(text, k, a, b)


def _cover(size: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Of every place the number of characters before it that lie in a span."""
    edges = np.zeros(size + 1, np.int64)
    for a, _, b in spans:
        edges[a] += 1
        edges[b] -= 1
    return np.concatenate([[0], np.cumsum(np.cumsum(edges[:-1]) > 0)])


@dataclass
class Kind:
    """The trees of one kind, the calibration of their scores, and the least probability of a chosen span."""

    trees: Boosted
    calibration: Calibration
    least: float


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for ident, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found: dict[tuple[int, int], list] = {}
            for kind, target, values in examples(text or ""):
                raw = np.array(values, np.float32).tobytes()
                found.setdefault((kind, target), []).append((hashlib.md5(raw).digest(), raw))
            for (kind, target), rows in found.items():
                out += [(ident, kind, target, raw) for _, raw in sorted(rows)[:EXAMPLES]]
        if out:
            columns = list(zip(*out))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "kind", "target", "features"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> dict[int, Kind]:
    """A model of each kind from at most ``sample`` documents with a digit or ``@``, those with the smallest hashes.

    A quarter of them is held: it calibrates the scores and sets the threshold, from which on ``PRECISION`` of the held
    examples are right. A kind with too little evidence gets none, and its candidates are never chosen.
    """
    shelf = Shelf(docs.sparkSession, "pii")
    usable = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    usable = usable.where("id IS NOT NULL AND text RLIKE '@|\\\\\\\\+[0-9]|[0-9]{3}'".replace("\\\\\\\\", "\\\\"))
    hashed = usable.select("id", F.xxhash64("id").alias("h")).distinct().orderBy("h", "id").limit(sample)
    chosen = shelf.put(hashed.select("id"), "chosen")
    # At most ``sample`` ids are broadcast.
    picked = usable.join(F.broadcast(chosen), "id", "left_semi")
    rows = picked.mapInArrow(_gather, "id bigint, kind int, target int, features binary").collect()
    rows.sort(key=lambda r: (r["id"], r["kind"], r["target"], bytes(r["features"])))
    models = {}
    for kind in range(len(KINDS)):
        own = [r for r in rows if r["kind"] == kind]
        x = np.array([np.frombuffer(r["features"], np.float32) for r in own], np.float64).reshape(-1, FEATURES)
        y = np.array([r["target"] for r in own], np.float64)
        held = np.array([hashlib.md5(str(r["id"]).encode()).digest()[0] < 64 for r in own], bool)
        if not (0 < y[~held].sum() < (~held).sum() and 0 < y[held].sum() < held.sum()):
            continue
        share = y[~held].mean()
        weight = np.where(y[~held] > 0, 0.5 / share, 0.5 / (1 - share))
        trees = Boosted().fit(x[~held], y[~held], weight)
        calibration = Calibration(trees.raw(x[held]), y[held])
        models[kind] = Kind(trees, calibration, threshold(calibration(trees.raw(x[held])), y[held], PRECISION, LEAST))
    return models


def _free(taken: list[tuple[int, int]], start: int, end: int) -> int:
    """Where a span fits between sorted spans that do not overlap, or -1."""
    at = bisect.bisect_left(taken, (end,))
    return -1 if at and taken[at - 1][1] > start else at


def _merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, _, b in spans:
        if out and a < out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def choose(base: list[tuple[int, int, int]], scored: list[tuple[float, int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates to add, the likeliest first, then the longest and the first: none overlaps a base span or another."""
    taken, added = _merged(base), []
    for _, start, kind, end in sorted(scored, key=lambda s: (-s[0], s[1] - s[3], s[1], s[2])):
        at = _free(taken, start, end)
        if at >= 0:
            taken.insert(at, (start, end))
            added.append((start, kind, end))
    return added


def _scan(models: dict[int, Kind], texts: list[str]) -> Iterator[list[tuple[int, int, int, bool]]]:
    """Of every text its spans by start, kind and end, with whether the model added them."""
    bases = [rules(t)[0] for t in texts]
    open_: dict[int, list[tuple[int, int, int]]] = {k: [] for k in models}
    values: dict[int, list[list[float]]] = {k: [] for k in models}
    scored: list[list[tuple[float, int, int, int]]] = [[] for _ in texts]

    def judge(kind: int) -> None:
        model = models[kind]
        odds = model.calibration(model.trees.raw(np.array(values[kind], np.float64)))
        for (d, a, b), p in zip(open_[kind], odds.tolist()):
            if p >= model.least:
                scored[d].append((p, a, kind, b))
        open_[kind], values[kind] = [], []

    for d, (text, base) in enumerate(zip(texts, bases)):
        taken = _merged(base)
        for a, kind, b in candidates(text) if models else ():
            if kind in models and models[kind].least <= 1 and _free(taken, a, b) >= 0:
                open_[kind].append((d, a, b))
                values[kind].append(features(text, kind, a, b))
                if len(values[kind]) >= 20_000:
                    judge(kind)
    for kind in models:
        if values[kind]:
            judge(kind)
    for base, own in zip(bases, scored):
        found = [(*s, False) for s in base] + [(*s, True) for s in choose(base, own)]
        yield sorted(found)


def _apply(docs: DataFrame, models: dict[int, Kind], id_col: str, text_col: str, emit, ddl: str) -> DataFrame:
    ship(docs.sparkSession)
    handle = docs.sparkSession.sparkContext.broadcast(models)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = handle.value
        for batch in batches:
            for low, high in words.slices(batch.column(1)):
                part = batch.slice(low, high - low)
                texts = [t or "" for t in part.column(1).to_pylist()]
                out = [emit(t, s) for t, s in zip(texts, _scan(models, texts))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, emit.kind)], names=["key", "value"])

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("key"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return source.mapInArrow(apply, f"key bigint, value {ddl}")


def _spans(text: str, spans: list[tuple[int, int, int, bool]]) -> list[dict]:
    return [{"kind": KINDS[k], "start": a, "end": b, "added": added} for a, k, b, added in spans]


def _masked(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    out, at = [], 0
    for start, kind, end, _ in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


_spans.kind = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())])
)
_masked.kind = pa.string()


def find(docs: DataFrame, models: dict[int, Kind] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``spans`` (kind, start, end in code points, end exclusive, added) of every whole text, by start and kind.

    Spans of the rules are all there, with ``added`` false; they may overlap across kinds. The model adds candidates
    whose calibrated probability reaches the threshold of their kind, the likeliest first, none over another span.
    A null text is empty and has none; ids may be null or repeated; equal rows have equal spans; an empty table
    gives no rows. Without ``models`` they are trained on ``docs``.
    """
    models = train(docs, id_col, text_col) if models is None else models
    ddl = "array<struct<kind: string, start: bigint, end: bigint, added: boolean>>"
    return _apply(docs, models, id_col, text_col, _spans, ddl).toDF(id_col, "spans")


def redact(docs: DataFrame, models: dict[int, Kind] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``redacted``: the text with every span of :func:`find` replaced by its kind in brackets.

    Of spans that overlap the first names the kind and all are covered. A null text becomes empty.
    """
    models = train(docs, id_col, text_col) if models is None else models
    return _apply(docs, models, id_col, text_col, _masked, "string").toDF(id_col, "redacted")


def digests(docs: DataFrame, models: dict[int, Kind] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the number of base spans of each kind, ``base_sha256`` of the base spans, and ``spans``: all of them as text.

    A span is ``kind:start:end``, spans are joined by commas; see :func:`find`.
    """

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    found = find(docs, models, id_col, text_col)
    base = F.filter("spans", lambda s: ~s["added"])
    counts = [number(kind) for kind in KINDS]
    return found.select(F.col(f"`{id_col}`"), *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
