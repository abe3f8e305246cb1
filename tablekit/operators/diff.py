"""Row-level comparison of two tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, IntegerType, LongType, ShortType

from tablekit.errors import InvalidSpec, SchemaConflict


def table_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows that differ: ``diff`` says missing or extra, ``copies`` how often. Duplicates count.

    Both sides are tagged and counted in one aggregation: equal rows cancel before they travel, and
    only distinct rows are shuffled. An empty result means the tables are equal.
    """
    left = {f.name: f.dataType.simpleString() for f in expected.schema}
    right = {f.name: f.dataType.simpleString() for f in actual.schema}
    if left != right:
        raise SchemaConflict(f"expected {left}, actual {right}")
    columns = expected.columns
    both = expected.withColumn("__side", F.lit(1)).unionByName(actual.withColumn("__side", F.lit(-1)))
    balance = both.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.sum("__side").alias("__balance"))
    return balance.where("__balance <> 0").select(
        *[F.col(f"`{c}`") for c in columns],
        F.when(F.col("__balance") > 0, "missing").otherwise("extra").alias("diff"),
        F.abs("__balance").alias("copies"),
    )


#: A differing segment is cut into so many, while it has more than LEAF_ROWS rows and few segments differ.
FANOUT = 256
LEAF_ROWS = 100_000
_WHOLE = (ByteType, ShortType, IntegerType, LongType)


@dataclass(frozen=True)
class Segment:
    """Keys from ``low`` to ``high``, both included; None for the rows whose first key is NULL."""

    low: int | None
    high: int | None
    rows: int

    def holds(self, key: Column) -> Column:
        return key.isNull() if self.low is None else key.between(F.lit(self.low), F.lit(self.high))


def _checked(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataType:
    left = {f.name: f.dataType.simpleString() for f in expected.schema}
    right = {f.name: f.dataType.simpleString() for f in actual.schema}
    if left != right:
        raise SchemaConflict(f"expected {left}, actual {right}")
    if not keys or set(keys) - set(left):
        raise InvalidSpec(f"keys {list(keys)} are not columns")
    return expected.schema[keys[0]].dataType


def _within(df: DataFrame, key: Column, segments: Sequence[Segment]) -> DataFrame:
    """Rows of the segments; neighbouring ranges are asked for as one, and the ranges reach the scan."""
    ranges: list[list[int]] = []
    for s in sorted((s for s in segments if s.low is not None), key=lambda s: s.low):
        if ranges and s.low <= ranges[-1][1] + 1:
            ranges[-1][1] = s.high
        else:
            ranges.append([s.low, s.high])
    tests = [key.between(F.lit(a), F.lit(b)) for a, b in ranges]
    tests += [key.isNull()] if any(s.low is None for s in segments) else []
    return df.where(reduce(lambda a, b: a | b, tests)) if tests else df.limit(0)


def _digests(df: DataFrame, key: Column, columns: Sequence[str], segments: Sequence[Segment]) -> DataFrame:
    """Rows and two sums of row hashes for each part of the segments.

    Sums do not depend on order and count repeated rows. They are added up in each task, so what travels is a row
    for each task and part.
    """
    parts = F.when(key.isNull(), F.struct(F.lit(None).cast("bigint").alias("low"), F.lit(None).cast("bigint").alias("high")))
    for s in segments:
        if s.low is not None:
            width = -(-(s.high - s.low + 1) // FANOUT)
            low = key - F.pmod(key - F.lit(s.low), F.lit(width))
            high = F.least(low + F.lit(width - 1), F.lit(s.high))
            parts = parts.when(s.holds(key), F.struct(low.alias("low"), high.alias("high")))
    named = [F.col(f"`{c}`") for c in columns]
    # A NULL leaves a hash as it is, so which columns are NULL is hashed too.
    nulls = [c.isNull() for c in named]
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *named, *nulls).cast("decimal(20,0)"))
    cut = _within(df, key, segments).withColumn("__part", parts)
    return cut.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), total(1).alias("one"), total(2).alias("two"))


def differing(expected: DataFrame, actual: DataFrame, keys: Sequence[str], leaf_rows: int = LEAF_ROWS) -> list[Segment]:
    """Ranges of the first key, a whole number, outside of which two tables are equal.

    The range of all keys is the root of a tree; each round digests the children of the segments that still differ,
    reading only these, and keeps those whose digests differ. It ends when no such segment has more than ``leaf_rows``
    rows, or when more than ``FANOUT`` of them differ: then most tables differ in most places. The driver holds at most
    ``FANOUT`` ** 2 segments.
    """
    kind = _checked(expected, actual, keys)
    if not isinstance(kind, _WHOLE):
        raise InvalidSpec(f"first key {keys[0]!r} is {kind.simpleString()}; ranges need whole numbers")
    key = F.col(f"`{keys[0]}`").cast("bigint")
    ends = [df.agg(F.min(key), F.max(key)).first() for df in (expected, actual)]
    known = [v for row in ends for v in row if v is not None]
    todo = [Segment(None, None, 0)] + ([Segment(min(known), max(known), leaf_rows + 1)] if known else [])
    done: list[Segment] = []
    while todo:
        sides = [_digests(df, key, expected.columns, todo) for df in (expected, actual)]
        left, right = (s.select("__part", "n", F.struct("n", "one", "two").alias("d")) for s in sides)
        both = left.join(right.select(F.col("__part").alias("p"), F.col("n").alias("m"), F.col("d").alias("e")), F.col("__part").eqNullSafe(F.col("p")), "full")
        other = both.where(~F.col("d").eqNullSafe(F.col("e")))
        part = F.coalesce("__part", "p")
        found = other.select(part["low"].alias("low"), part["high"].alias("high"), (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))
        segments = [Segment(r.low, r.high, r.n) for r in found.collect()]
        large = [s for s in segments if s.low is not None and s.rows > leaf_rows and s.high > s.low]
        if len(large) > FANOUT:
            done, todo = done + segments, []
        else:
            done, todo = done + [s for s in segments if s not in large], large
    return sorted(done, key=lambda s: (s.low is not None, s.low or 0))


def diff_keys(expected: DataFrame, actual: DataFrame, keys: Sequence[str], leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Keys whose rows differ: ``diff`` says missing, extra, changed or ambiguous, ``columns`` which columns changed.

    Keys compare NULL-safe. A key that has several rows on a side is ambiguous, if these differ from the other
    side's. Where the first key is a whole number only the segments of :func:`differing` are read again and joined;
    with other keys whole tables are.
    """
    kind = _checked(expected, actual, keys)
    others = [c for c in expected.columns if c not in keys]
    sides = [expected, actual]
    if isinstance(kind, _WHOLE):
        key = F.col(f"`{keys[0]}`").cast("bigint")
        segments = differing(expected, actual, keys, leaf_rows)
        bare = F.col(f"`{keys[0]}`")
        sides = [_within(df, bare, segments) for df in sides]

    def grouped(df: DataFrame, name: str) -> DataFrame:
        row = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(1).alias("__none"))
        whole = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in others], *[F.col(f"`{c}`").isNull() for c in others]).cast("decimal(20,0)"))
        return df.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(
            F.first(row).alias(f"__{name}"), F.count(F.lit(1)).alias(f"__{name}_n"),
            (whole if others else F.lit(0)).alias(f"__{name}_sum"),
        )

    left, right = grouped(sides[0], "l"), grouped(sides[1], "r")
    joined = _full(left, right, keys)
    single = (F.col("__l_n") == 1) & (F.col("__r_n") == 1)
    named = [F.when(~F.col("__l")[c].eqNullSafe(F.col("__r")[c]), F.lit(c)) for c in others]
    columns = F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")
    several = (F.col("__l_n") != F.col("__r_n")) | (F.col("__l_sum") != F.col("__r_sum"))
    verdict = (
        F.when(F.col("__r_n").isNull(), "missing").when(F.col("__l_n").isNull(), "extra")
        .when(single & (F.size(columns) > 0), "changed").when(~single & several, "ambiguous")
    )
    result = joined.select(
        *[F.col(f"`{c}`") for c in keys], verdict.alias("diff"),
        F.when(single, columns).otherwise(F.array().cast("array<string>")).alias("columns"),
    )
    return result.where("diff IS NOT NULL")


def _full(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join in which NULL keys match."""
    renamed = right.select(*[F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keys)], *[c for c in right.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(keys)])
    joined = left.join(renamed, same, "full")
    picked = [F.when(F.col("__l_n").isNull(), F.col(f"__k{i}")).otherwise(F.col(f"`{c}`")).alias(c) for i, c in enumerate(keys)]
    return joined.select(*picked, *[c for c in joined.columns if c.startswith(("__l", "__r"))])
