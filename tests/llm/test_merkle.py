"""Manifests against a plain tree, on parts of every small size and odd tables."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tablekit.llm import merkle
from tests.llm import data


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return levels


def climb(levels, at):
    """The run's nodes before and after each node on the way up."""
    for level in levels[:-1]:
        first = at // 2 * 2
        yield "".join(level[first:at]), "".join(level[at + 1 : first + 2])
        at //= 2


def brute(rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    parts = {}
    for row in rows:
        parts.setdefault(row[2], []).append(row)
    names = sorted(parts, key=lambda n: (n is not None, (n or "").encode()))
    for own in parts.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {n: tree([leaf(r) for r in parts[n]]) for n in names}
    top = tree([trees[n][-1][0] for n in names])
    root = top[-1][0] if names else None
    out = []
    for place, name in enumerate(names):
        for at, row in enumerate(parts[name]):
            steps = [*climb(trees[name], at), *climb(top, place)]
            altered = row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = leaf((*row[:3], row[3] + 1, row[4])) if altered else leaf(row)
            for before, after in steps:
                folded = h(before + folded + after)
            proof = h("".join(a + b for a, b in steps))
            out.append((row[0], leaf(row), trees[name][-1][0], root, proof, folded, folded == root))
    return data.ordered(out)


def altered(docs, stride=merkle.STRIDE):
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return merkle.audit(docs, altered={"n_chars": F.col("n_chars") + 1}, where=code % 7 == 0, stride=stride)


def table(spark, rows, parts=7):
    schema = "doc_id long, source string, lang string, n_chars long, text string, " + ", ".join(
        f"{c} string" for c in ("id", "part", "idx", "digest", "other", "height", "path", "root", "name")
    )
    return spark.createDataFrame([(*r, *"abcdefghi") for r in rows], schema).repartition(parts)


def odd():
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["a", None, "é"]), rnd.choice(["en", "de", None, "", "é", "z"]), None if t is None else len(t), t) for i, t in data.odd_rows()]
    rows += [(1000 + i, "hot", "en", i, "same") for i in range(700)]
    rows += [(5000, "s", "one", 1, "x")] * 3 + [(-3, "s", f"lang{i:02}", -1, "y") for i in range(19)]
    return rows


@pytest.mark.parametrize("stride", [1, 3, 8])
def test_manifest(spark, stride):
    rows = odd()
    got = altered(table(spark, rows), stride)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert data.ordered(map(tuple, got.collect())) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 9])
def test_small_manifests(spark, n):
    rows = [(7 * i, "s", "en" if i % 4 else "de", 1, "t") for i in range(n)]
    assert data.ordered(map(tuple, altered(table(spark, rows, 3), 2).collect())) == brute(rows)


def test_proofs_lead_to_the_root(spark):
    """Proofs as they are handed out, folded without the table; only every third level is stored."""
    manifest = merkle.build(table(spark, odd()), stride=3)
    proofs = merkle.prove(manifest).collect()
    assert all(merkle.fold(r.leaf, r.proof.split(",") if r.proof else []) == r.root for r in proofs)
    assert {r.folded for r in proofs} == {proofs[0].root}
    sizes = [layer.count() for layer in manifest.layers]
    assert all(8 * upper <= lower + 8 * 30 for lower, upper in zip(sizes, sizes[1:])) and len(sizes) == 5
