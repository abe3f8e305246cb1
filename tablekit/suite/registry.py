"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


@dataclass(frozen=True)
class Case:
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


CASES: dict[str, Case] = {}


def case(name: str, oracle: str | None = None):
    """Register a query under ``name``."""

    def add(build):
        if name in CASES:
            raise ValueError(f"query {name} registered twice")
        CASES[name] = Case(build, oracle.strip() if oracle else None)
        return build

    return add


def table_path(sf: str, name: str) -> str:
    return f"{sf.rstrip('/')}/{name}.parquet"


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf, name))


def sql(spark: SparkSession, sf: str, text: str, **args) -> DataFrame:
    """Spark SQL in which ``{orders}`` stands for the table ``orders``."""
    used = {t: read(spark, sf, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, args=args, **used)
