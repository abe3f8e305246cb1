"""Database tables as source and sink over JDBC.

The database must be reachable from every executor: a database that lives inside one process
(embedded, in-memory) only works in local mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablekit.errors import InvalidSpec


def read_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **properties: str,
) -> dict[str, str]:
    """Options of a JDBC read; with ``partition_column`` the read is split into range queries."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **properties}
    if partition_column:
        if bounds is None or not partitions:
            raise InvalidSpec("a partitioned read needs bounds=(low, high) and partitions=")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def column_bounds(spark: SparkSession, url: str, table: str, column: str, **properties: str) -> tuple:
    """Smallest and largest value of ``column``, computed by the database."""
    query = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(url=url, query=query, **properties).load().first()
    return row[0], row[1]


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int | None = None,
    **properties: str,
) -> DataFrame:
    """One database table. Filters, column pruning and limits are pushed into the database.

    Without ``partition_column`` everything arrives through one connection; give it for anything
    that is not small. Missing ``bounds`` are asked from the database.
    """
    if partition_column and bounds is None:
        bounds = column_bounds(spark, url, table, partition_column, **properties)
    options = read_options(url, table, partition_column, bounds, partitions, **properties)
    return spark.read.format("jdbc").options(**options).load()


def scan_jdbc_tables(spark: SparkSession, url: str, tables: list[str], **properties: str) -> dict[str, DataFrame]:
    """Several tables of one database, by name."""
    return {table: scan_jdbc(spark, url, table, **properties) for table in tables}


def sink_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    connections: int = 8,
    batch_size: int = 10_000,
    **properties: str,
) -> None:
    """Write to a database table over at most ``connections`` parallel connections.

    ``overwrite`` truncates, so the table keeps its definition. A retried task may send its rows
    again: give the table a key, or load a staging table, where that matters.
    """
    writer = df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, **properties)
    writer.options(
        numPartitions=str(connections), batchsize=str(batch_size), truncate=str(mode == "overwrite").lower()
    ).save()
