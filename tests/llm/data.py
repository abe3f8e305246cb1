"""Small tables with every odd case, and brute-force references."""

from __future__ import annotations

import random
import re

CLASHING = ["id", "key", "sig", "n", "bucket", "rid", "x", "score", "kept", "start"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def table(spark, rows, parts=3):
    """Documents with columns whose names operators use inside."""
    data = [(i, t, "en", "src0", None if t is None else len(t), *[f"c{i}"] * len(CLASHING)) for i, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def odd_rows(seed=1, copies=12):
    """Nulls, empty and long texts, repeated rows and ids, copies, near copies and shared lines."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]

    def words(n):
        return [rnd.choice(vocabulary) for _ in range(n)]

    line = " ".join(words(6)) + " a line that many documents share"
    base, long = words(120), words(4000)
    rows = [(None, None), (1, ""), (2, " \t\n "), (3, "One"), (4, "one two"), (5, "ONE  two"), (None, "one two"), (6, None)]
    rows += [(7, "repeated row of text")] * 3 + [(8, "same id, first text"), (8, "same id, second text")]
    for i in range(copies):
        edited = list(base)
        for _ in range(rnd.randrange(3)):
            edited[rnd.randrange(len(edited))] = "changed"
        rows.append((20 + i, " ".join(edited)))
        rows.append((50 + i, " ".join(base)))
        rows.append((80 + i, "\n".join([" ".join(words(8)), "  " + line.upper() + "\t", " ".join(words(8)), "short"])))
    rows += [(110, " ".join(long)), (111, " ".join(long[:3800] + words(100))), (112, "x" * 30000), (113, "é" * 25 + "\n" + "é" * 25)]
    rows += [(114 + i, " ".join(words(rnd.randrange(1, 40)))) for i in range(40)]
    return rows


def components(n, links):
    """Least member of each node's component."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def shingle_set(text, k):
    found = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    return frozenset(tuple(found[i : i + k]) for i in range(len(found) - k + 1)) or (
        frozenset([tuple(found)]) if found else frozenset()
    )


def least_ids(rows, roots):
    """Smallest id of each row's component, None if it has none."""
    best = {}
    for (ident, _), root in zip(rows, roots):
        if ident is not None:
            best[root] = min(best.get(root, ident), ident)
    return [best.get(root) for root in roots]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))
