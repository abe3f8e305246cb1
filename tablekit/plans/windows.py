"""Window functions that survive a hot key.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task. The functions here cut
each key into ordered buckets, run the window inside ``(key, bucket)``, and add what the earlier
buckets contribute from a summary of one row per ``(key, bucket)``. ``buckets`` is a list of
columns that never decreases along the ordering, for example
``[F.date_trunc("day", "ts")]`` or ``[F.floor(F.col("price") / 1000)]``; pick its width so one
bucket fits one task. All results are exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

AT = "__at"


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; the right copies of the keys are dropped."""
    renamed = right.select(
        *[F.col(c).alias(f"__r_{c}") for c in on], *[c for c in right.columns if c not in on]
    )
    condition = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on])
    return left.join(renamed, condition, how).drop(*[f"__r_{c}" for c in on])


def tag(df: DataFrame, keys: Sequence[str], buckets: Sequence[Column]) -> DataFrame:
    """Add the struct ``(keys, buckets)`` that windows, summaries and joins all partition by.

    A struct is never NULL and equal structs may hold NULLs, so NULL keys need no care; and since
    the window and the join ask for the same partitioning, rows are shuffled once.
    """
    parts = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    return df.withColumn(AT, F.struct(*parts, *[b.alias(f"b{i}") for i, b in enumerate(buckets)]))


def inside(*order: Column | str) -> WindowSpec:
    """Window over the rows of one key and bucket."""
    return Window.partitionBy(AT).orderBy(*order)


def whole_key(keys: Sequence[str]) -> WindowSpec:
    """Window over a key's bucket summaries."""
    return Window.partitionBy(*[F.col(f"{AT}.k{i}") for i in range(len(keys))])


def across(keys: Sequence[str]) -> WindowSpec:
    """The same in bucket order: within a key the struct sorts by its bucket fields."""
    return whole_key(keys).orderBy(AT)


def before(keys: Sequence[str]) -> WindowSpec:
    """The buckets before the current one."""
    return across(keys).rowsBetween(Window.unboundedPreceding, -1)


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    buckets: Sequence[Column],
    name: str = "row_number",
    size: str | None = None,
) -> DataFrame:
    """``row_number`` per key (over the whole table when ``keys`` is empty), and the key's row count.

    With empty ``keys`` only the bucket summary meets in one task, never the rows.
    """
    tagged = tag(df, keys, buckets)
    summary = tagged.groupBy(AT).agg(F.count(F.lit(1)).alias("__n"))
    summary = summary.select(
        AT,
        F.coalesce(F.sum("__n").over(before(keys)), F.lit(0)).alias("__offset"),
        F.sum("__n").over(whole_key(keys)).alias("__size"),
    )
    numbered = tagged.withColumn("__rn", F.row_number().over(inside(*order)))
    joined = numbered.join(summary, AT).withColumn(name, F.col("__offset") + F.col("__rn"))
    if size:
        joined = joined.withColumn(size, F.col("__size"))
    return joined.drop(AT, "__rn", "__offset", "__size")


def tiles(row_number: Column, size: Column, n: int) -> Column:
    """``ntile(n)`` from a row number and the group's row count."""
    low = F.floor(size / F.lit(n))
    extra = size % F.lit(n)
    head = extra * (low + 1)
    return (
        F.when(row_number <= head, F.ceil(row_number / (low + 1)))
        .otherwise(extra + F.ceil(F.try_divide(row_number - head, low)))
        .cast("int")
    )


def value_ranks(df: DataFrame, keys: Sequence[str], value: str, buckets: Sequence[Column]) -> DataFrame:
    """``rank``, ``dense_rank``, ``percent_rank`` and ``cume_dist`` of ``value`` (ascending) per key.

    Ranks depend only on how many rows hold each value, so rows are first counted per
    ``(key, value)`` with map-side partial sums: a value shared by a third of all rows is one row.
    """
    counted = tag(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n")), keys, buckets)
    summary = counted.groupBy(AT).agg(F.sum("__n").alias("__rows"), F.count(F.lit(1)).alias("__values"))
    summary = summary.select(
        AT,
        F.coalesce(F.sum("__rows").over(before(keys)), F.lit(0)).alias("__rows_before"),
        F.coalesce(F.sum("__values").over(before(keys)), F.lit(0)).alias("__values_before"),
        F.sum("__rows").over(whole_key(keys)).alias("__size"),
    )
    ordered = inside(F.col(value).asc_nulls_first())
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = counted.withColumn("__upto", F.sum("__n").over(upto)).withColumn(
        "__dense", F.row_number().over(ordered)
    )
    ranked = local.join(summary, AT)
    rank = F.col("__rows_before") + F.col("__upto") - F.col("__n") + 1
    ranked = ranked.select(
        *keys,
        value,
        rank.alias("rank"),
        (F.col("__values_before") + F.col("__dense")).alias("dense_rank"),
        F.coalesce(F.try_divide(rank - 1, F.col("__size") - 1), F.lit(0.0)).alias("percent_rank"),
        ((F.col("__rows_before") + F.col("__upto")) / F.col("__size")).alias("cume_dist"),
    )
    return null_safe_join(df, ranked, [*keys, value])


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    buckets: Sequence[Column],
    value: Column,
    name: str,
) -> DataFrame:
    """Sum of ``value`` from the first row of the key to the current row."""
    tagged = tag(df.withColumn("__v", value), keys, buckets)
    summary = tagged.groupBy(AT).agg(F.sum("__v").alias("__total"))
    summary = summary.select(AT, F.sum("__total").over(before(keys)).alias("__offset"))
    upto = inside(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = tagged.withColumn("__local", F.sum("__v").over(upto)).join(summary, AT)
    total = F.when(F.col("__offset").isNull(), F.col("__local")).otherwise(
        F.col("__offset") + F.coalesce(F.col("__local"), F.lit(0))
    )
    return joined.withColumn(name, total).drop(AT, "__v", "__local", "__offset")


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    buckets: Sequence[Column],
    value: str,
) -> DataFrame:
    """``lag``, ``lead``, ``first_value``, ``last_value`` of ``value`` along ``order`` (ascending).

    ``order`` must be unique per key. Values are wrapped in a struct so that a NULL value is
    told apart from a missing neighbour.
    """
    tagged = tag(df, keys, buckets).withColumn("__v", F.struct(F.col(value).alias("v")))
    position = F.struct(*order)
    summary = tagged.groupBy(AT).agg(
        F.min_by("__v", position).alias("__first"), F.max_by("__v", position).alias("__last")
    )
    whole = across(keys).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summary = summary.select(
        AT,
        F.lag("__last").over(across(keys)).alias("__prev"),
        F.lead("__first").over(across(keys)).alias("__next"),
        F.first("__first").over(whole).alias("__key_first"),
        F.last("__last").over(whole).alias("__key_last"),
    )
    local = tagged.withColumns(
        {"__lag": F.lag("__v").over(inside(*order)), "__lead": F.lead("__v").over(inside(*order))}
    )
    joined = local.join(summary, AT)
    return joined.select(
        *df.columns,
        F.coalesce("__lag", "__prev")["v"].alias("lag"),
        F.coalesce("__lead", "__next")["v"].alias("lead"),
        F.col("__key_first")["v"].alias("first_value"),
        F.col("__key_last")["v"].alias("last_value"),
    )


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float], buckets: Sequence[Column]
) -> DataFrame:
    """Interpolated quantiles per key, like ``percentile_cont``, without one big buffer per key.

    Rows become ``(key, value, count)``; the running count picks, for every probability, the two
    values around the target position. ``buckets`` are columns over ``value``.
    """
    present = df.where(F.col(value).isNotNull())
    counted = tag(present.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n")), keys, buckets)
    summary = counted.groupBy(AT).agg(F.sum("__n").alias("__rows"))
    summary = summary.select(
        AT,
        F.coalesce(F.sum("__rows").over(before(keys)), F.lit(0)).alias("__rows_before"),
        F.sum("__rows").over(whole_key(keys)).alias("__size"),
    )
    upto = inside(F.col(value)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counted.withColumn("__upto", F.sum("__n").over(upto)).join(summary, AT)
    last = F.col("__rows_before") + F.col("__upto") - 1
    first = last - F.col("__n") + 1
    aggs = []
    for name, p in probabilities.items():
        position = F.lit(p) * (F.col("__size") - 1)
        low, high = F.floor(position), F.ceil(position)
        holds_low = (first <= low) & (low <= last)
        holds_high = (first <= high) & (high <= last)
        aggs += [
            F.max(F.when(holds_low, F.col(value))).alias(f"__lo_{name}"),
            F.max(F.when(holds_high, F.col(value))).alias(f"__hi_{name}"),
            F.max(position - low).alias(f"__w_{name}"),
        ]
    picked = placed.groupBy(*keys).agg(*aggs) if keys else placed.agg(*aggs)
    return picked.select(
        *keys,
        *[
            (
                F.col(f"__lo_{name}")
                + (F.col(f"__hi_{name}") - F.col(f"__lo_{name}")) * F.col(f"__w_{name}")
            ).alias(name)
            for name in probabilities
        ],
    )


def exact_mode(df: DataFrame, keys: Sequence[str], value: str, name: str = "mode") -> DataFrame:
    """Most frequent value per key, the smallest one on ties; two partial aggregations, no buffer."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    rarest_last = F.struct((-F.col("__n")).alias("n"), F.col(value).alias("v"))
    return counted.groupBy(*keys).agg(F.min_by(value, rarest_last).alias(name))
