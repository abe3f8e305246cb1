"""The query surface: SQL text, relational chains and result profiles."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sql_text(
    spark: SparkSession, sql: str, args: dict[str, Any] | None = None, limit: int | None = None
) -> DataFrame:
    """Run SQL; values go in through ``:name`` markers. ``limit`` cuts before anything is fetched."""
    df = spark.sql(sql, args=args or {})
    return df if limit is None or limit < 0 else df.limit(limit)


def relational(
    df: DataFrame, where: str | None = None, columns: str | list[str] = "*", aggregate: str | None = None
) -> DataFrame:
    """Filter, then either aggregate or project.

    ``aggregate`` is a select list; its plain columns become the group keys, and ``columns`` is
    ignored when it is given.
    """
    if where:
        df = df.where(F.expr(where))
    if aggregate:
        text = aggregate.replace("{", "{{").replace("}", "}}")
        return df.sparkSession.sql(f"SELECT {text} FROM {{rows}} GROUP BY ALL", rows=df)
    return df.selectExpr(*([columns] if isinstance(columns, str) else columns))


def result_profile(df: DataFrame, text_bytes: bool = False) -> DataFrame:
    """One row per column: position, name, type, row count and (optionally) bytes as text.

    The schema costs nothing; counts come from one aggregate on the executors.
    """
    aggs = [F.count(F.lit(1)).alias("__rows")]
    if text_bytes:
        aggs += [
            F.coalesce(F.sum(F.octet_length(F.col(f"`{f.name}`").cast("string"))), F.lit(0)).alias(f"__b{i}")
            for i, f in enumerate(df.schema)
        ]
    one = df.agg(*aggs)
    entries = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("__rows").alias("row_count"),
            (F.col(f"__b{i}") if text_bytes else F.lit(None).cast("bigint")).alias("text_bytes"),
        )
        for i, f in enumerate(df.schema)
    ]
    return one.select(F.inline(F.array(*entries)))
