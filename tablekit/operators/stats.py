"""Table statistics and column profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    MapType,
    NumericType,
    StructField,
    StructType,
    VariantType,
)

# Above this many exact distinct counts a fused aggregate repeats every row too often
# (Spark expands each row once per distinct column), so each column gets its own pruned scan.
MAX_FUSED_DISTINCT = 3

# Size of the quantile sketch: about 0.3 % error in rank, some kilobytes per column and task.
QUANTILE_K = 1000


def _orderable(dtype: DataType) -> bool:
    return not isinstance(dtype, (ArrayType, MapType, StructType, BinaryType, VariantType))


def _text(column: Column, dtype: DataType) -> Column:
    return column.cast("string") if _orderable(dtype) else F.to_json(column)


def _distinct(field: StructField) -> Column:
    column = F.col(f"`{field.name}`")
    # Arrays compare as they are; maps and variants do not group, their JSON text does.
    return F.to_json(column) if isinstance(field.dataType, (MapType, VariantType)) else column


def exact_distinct(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, distinct_count)``: non-NULL distinct values per column.

    One column-pruned scan per column, each a plain two-step aggregation that shuffles distinct
    values only, whatever their frequency.
    """
    fields = [f for f in df.schema if columns is None or f.name in columns]
    parts = [
        df.select(_distinct(f).alias("v"))
        .where("v IS NOT NULL")
        .distinct()
        .agg(F.lit(f.name).alias("column_name"), F.count(F.lit(1)).alias("distinct_count"))
        for f in fields
    ]
    return reduce(DataFrame.unionByName, parts)


def _base_profile(df: DataFrame, quantiles: Sequence[float], approx_distinct: bool) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, f in enumerate(df.schema):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count(c).alias(f"__n{i}"))
        if approx_distinct:
            aggs.append(F.approx_count_distinct(_distinct(f)).alias(f"__d{i}"))
        if _orderable(f.dataType):
            aggs += [F.min(c).alias(f"__lo{i}"), F.max(c).alias(f"__hi{i}")]
        if isinstance(f.dataType, NumericType):
            aggs.append(F.avg(c.cast("double")).alias(f"__avg{i}"))
            if quantiles:
                aggs.append(F.kll_sketch_agg_double(c.cast("double"), QUANTILE_K).alias(f"__q{i}"))
    one = df.agg(*aggs)
    entries = []
    for i, f in enumerate(df.schema):
        orderable, numeric = _orderable(f.dataType), isinstance(f.dataType, NumericType)
        parts = [
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("__rows").alias("row_count"),
            (F.col("__rows") - F.col(f"__n{i}")).alias("null_count"),
            (_text(F.col(f"__lo{i}"), f.dataType) if orderable else F.lit(None).cast("string")).alias("min_value"),
            (_text(F.col(f"__hi{i}"), f.dataType) if orderable else F.lit(None).cast("string")).alias("max_value"),
            (F.col(f"__avg{i}") if numeric else F.lit(None).cast("double")).alias("mean"),
        ]
        if approx_distinct:
            parts.append(F.col(f"__d{i}").alias("approx_distinct"))
        if quantiles:
            empty = F.lit(None).cast("array<double>")
            ranks = F.array(*[F.lit(float(q)) for q in quantiles])
            found = F.when(F.col(f"__n{i}") > 0, F.kll_sketch_get_quantile_double(F.col(f"__q{i}"), ranks))
            parts.append((found if numeric else empty).alias("quantiles"))
        entries.append(F.struct(*parts))
    return one.select(F.inline(F.array(*entries)))


def table_stats(df: DataFrame, exact: bool = False) -> DataFrame:
    """Rows, NULLs, distinct values, smallest and largest value of every column, never cached.

    One scan with a distinct-count sketch; ``exact=True`` adds one pruned scan per column.
    """
    base = _base_profile(df, (), approx_distinct=not exact)
    if exact:
        base = base.join(exact_distinct(df), "column_name")
    else:
        base = base.withColumnRenamed("approx_distinct", "distinct_count")
    return base.select(
        "column_name", "data_type", "row_count", F.lit(len(df.columns)).alias("column_count"),
        "null_count", "distinct_count", "min_value", "max_value",
    )


def column_profile(
    df: DataFrame, columns: Sequence[str] | None = None, quantiles: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """Profile of each column in one pass: counts, NULL share, range, mean, sketched distinct and quantiles."""
    chosen = df.select(*columns) if columns else df
    base = _base_profile(chosen, quantiles, approx_distinct=True)
    return base.withColumn("null_fraction", F.try_divide(F.col("null_count"), F.col("row_count")))


def analyze_table(spark, table: str) -> None:
    """Store table and column statistics for Spark's join planner."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
