"""Positions in an order, per key or over a whole table, from Spark's own ranges.

Rows are dealt by ranges of key and order, whose bounds Spark draws from a sample, and written: a key with many rows
spans several tasks, and many small keys share one. A row's place in its task is known then; what the tasks before
hold of its key is added up from one row for each task and key. No bucket width is to be chosen, and no step gathers
more than these sums: as many as there are tasks and keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablekit.plans.windows import null_safe_join
from tablekit.session import materialize

_RUN = "__run"


def _dealt(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``df`` written in ranges, with ``__seq`` (ascending along the order) and ``__run`` (key and task)."""
    along = [*[F.col(f"`{k}`").asc_nulls_first() for k in keys], *order]
    dealt = df.repartitionByRange(*along).sortWithinPartitions(*along)
    written = materialize(dealt.withColumn("__seq", F.monotonically_increasing_id()), "order")
    parts = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]
    return written.withColumn(_RUN, F.struct(*parts, F.shiftright("__seq", 33).alias("task")))


def _offsets(runs: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """For each run the sums over the key's earlier runs, and over all of the key's."""
    whole = Window.partitionBy(*[F.col(f"{_RUN}.k{i}") for i in range(len(keys))])
    before = whole.orderBy(f"{_RUN}.task").rowsBetween(Window.unboundedPreceding, -1)
    added = [c for s in sums for c in (F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}_before"), F.sum(s).over(whole).alias(f"{s}_all"))]
    return runs.select(_RUN, *[c for c in runs.columns if c not in (_RUN, *sums)], *added)


def positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "row_number", size: str | None = None
) -> DataFrame:
    """The position of each row in its key (in the whole table without keys), from 1, and the key's row count.

    Rows with equal keys and order are numbered in any order. NULL keys are one key.
    """
    dealt = _dealt(df, keys, order)
    runs = dealt.groupBy(_RUN).agg(F.min("__seq").alias("__first"), F.count(F.lit(1)).alias("__n"))
    joined = dealt.join(_offsets(runs, keys, ["__n"]), _RUN)
    place = F.col("__seq") - F.col("__first") + F.col("__n_before") + 1
    sized = [F.col("__n_all").alias(size)] if size else []
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], place.alias(name), *sized)


def rankings(df: DataFrame, keys: Sequence[str], value: str, ties: Sequence[str] = ()) -> DataFrame:
    """``row_number`` (by value, then ``ties``), ``size``, ``rank``, ``dense_rank``, ``percent_rank``, ``cume_dist``.

    Ascending, NULL values first. Rows with one value rank alike: their first and last position come from one
    aggregate, and the positions of the values among themselves are the dense ranks.
    """
    order = [F.col(f"`{c}`").asc_nulls_first() for c in (value, *ties)]
    numbered = materialize(positions(df, keys, order, "row_number", "size"), "numbered")
    peers = numbered.groupBy(*[F.col(f"`{c}`") for c in (*keys, value)]).agg(
        F.min("row_number").alias("rank"), F.max("row_number").alias("__last")
    )
    dense = materialize(positions(peers, keys, [F.col(f"`{value}`").asc_nulls_first()], "dense_rank"), "peers")
    joined = null_safe_join(numbered, dense, [*keys, value])
    share = F.coalesce(F.try_divide(F.col("rank") - 1, F.col("size") - 1), F.lit(0.0))
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns], "row_number", "size", "rank", "dense_rank", share.alias("percent_rank"),
        (F.col("__last") / F.col("size")).alias("cume_dist"),
    )


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """Interpolated quantiles per key, like ``percentile_cont``; NULL values don't count.

    Rows become ``(key, value, count)``, in order; the running count picks the two values around each target position.
    """
    present = df.where(F.col(f"`{value}`").isNotNull())
    counted = present.groupBy(*[F.col(f"`{c}`") for c in (*keys, value)]).agg(F.count(F.lit(1)).alias("__c"))
    dealt = _dealt(counted, keys, [F.col(f"`{value}`")])
    offsets = _offsets(dealt.groupBy(_RUN).agg(F.sum("__c").alias("__n")), keys, ["__n"])
    upto = Window.partitionBy(_RUN).orderBy("__seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumn("__upto", F.sum("__c").over(upto)).join(offsets, _RUN)
    last = F.col("__n_before") + F.col("__upto") - 1
    first = last - F.col("__c") + 1
    aggregates = []
    for name, p in probabilities.items():
        at = F.lit(p) * (F.col("__n_all") - 1)
        low, high = F.floor(at), F.ceil(at)
        own = F.col(f"`{value}`")
        aggregates += [
            F.max(F.when(first.between(F.lit(0), low) & (last >= low), own)).alias(f"__lo_{name}"),
            F.max(F.when(first.between(F.lit(0), high) & (last >= high), own)).alias(f"__hi_{name}"),
            F.max(at - low).alias(f"__w_{name}"),
        ]
    picked = placed.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*aggregates)
    mixed = [
        (F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__w_{n}")).alias(n) for n in probabilities
    ]
    return picked.select(*[F.col(f"`{k}`") for k in keys], *mixed)
