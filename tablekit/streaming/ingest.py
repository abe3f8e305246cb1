"""Continuous forms of the loads and checks, on Structured Streaming.

Every function takes a checkpoint folder: restart with the same one and each file is processed
once. ``available_now`` (the default) processes what is there and stops.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType, TimestampNTZType

from tablekit.operators import loads
from tablekit.operators.checks import Check, verify


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    pattern: str | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """New files of a folder as a stream, in batches of about ``max_bytes`` (all that is there without it)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def _start(writer: DataStreamWriter, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if not available_now:
        return writer.start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def ingest(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream to a parquet folder; the file sink commits each batch exactly once."""
    return _start(stream.writeStream.format("parquet").option("path", path), checkpoint, available_now)


def upsert(
    stream: DataFrame,
    table: str,
    keys: Sequence[str],
    checkpoint: str,
    order_by: Sequence[str] = (),
    path: str | None = None,
    available_now: bool = True,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Merge every micro-batch into a table. A batch replayed after a failure changes nothing.

    Partition a large table by some of its key columns: a batch then rewrites only the partitions
    it touches, while any other table is rewritten as a whole by every batch.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        loads.merge(batch.sparkSession, batch, table, keys, order_by, path, partition_by)

    query = _start(stream.writeStream.foreachBatch(apply), checkpoint, available_now)
    return _refreshed(query, stream.sparkSession, table, available_now)


def _refreshed(query: StreamingQuery, session: SparkSession, table: str, ended: bool) -> StreamingQuery:
    """Batches run in a session of their own: the caller's forgets which files of the table it knew."""
    if ended and session.catalog.tableExists(table):
        session.catalog.refreshTable(table)
    return query


def daily(
    stream: DataFrame,
    ts: str,
    keys: Sequence[str],
    aggregates: dict[str, Column],
    lateness: str = "1 day",
) -> DataFrame:
    """Aggregates per key and UTC day; rows later than ``lateness`` behind the newest are dropped."""
    if isinstance(stream.schema[ts].dataType, TimestampNTZType):
        # A watermark needs an instant: read the wall-clock time as UTC, whatever the session's zone.
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        stream = stream.withColumn(ts, F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col(ts))))
    grouped = stream.withWatermark(ts, lateness).groupBy(F.window(ts, "1 day"), *keys)
    result = grouped.agg(*[column.alias(name) for name, column in aggregates.items()])
    day = F.date_from_unix_date(F.floor(F.unix_seconds("window.start") / 86_400).cast("int"))
    return result.select(day.alias("day"), *keys, *aggregates)


def snapshot(
    aggregate: DataFrame, table: str, checkpoint: str, path: str | None = None, available_now: bool = True
) -> StreamingQuery:
    """Keep a table equal to the whole running aggregate (complete mode); readers see full versions only."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        loads.replace(batch.sparkSession, batch, table, path)

    return _start(aggregate.writeStream.outputMode("complete").foreachBatch(apply), checkpoint, available_now)


def closed(
    aggregate: DataFrame,
    table: str,
    keys: Sequence[str],
    checkpoint: str,
    path: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep a table, partitioned by day, of the days of a :func:`daily` aggregate that the watermark has closed.

    Append mode: a day's rows leave the state when it closes, so the state holds the open days only, and each reaches
    the table once. A batch rewrites the partitions of the days it closed; replayed after a failure it writes the same
    rows again. Rows that arrive after their day has closed are dropped by the stream.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if session.catalog.tableExists(table) and batch.isEmpty():
            return
        loads.merge(session, batch, table, ["day", *keys], path=path, partition_by=["day"])

    query = _start(aggregate.writeStream.outputMode("append").foreachBatch(apply), checkpoint, available_now)
    return _refreshed(query, aggregate.sparkSession, table, available_now)


class ChecksFailed(Exception):
    """A micro-batch failed its checks and ``fail_fast`` was set."""


def check_stream(
    stream: DataFrame,
    checks: Sequence[Check],
    results: str,
    checkpoint: str,
    contract: str = "contract",
    dataset: str = "stream",
    fail_fast: bool = False,
    available_now: bool = True,
    then: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Verify every micro-batch and keep the results, one folder per batch.

    Failed checks are recorded and the stream goes on, unless ``fail_fast``. ``then`` gets each
    batch after its checks, for example to load it.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        outcome = verify(batch, checks, contract, dataset, run_id=f"{contract}-{batch_id}")
        folder = os.path.join(results, f"batch={batch_id}")
        outcome.write.mode("overwrite").parquet(folder)
        if fail_fast:
            failed = batch.sparkSession.read.schema(outcome.schema).parquet(folder).where(~F.col("passed"))
            names = [r.check_name for r in failed.select("check_name").collect()]
            if names:
                raise ChecksFailed(f"batch {batch_id}: {names}")
        if then:
            then(batch, batch_id)

    return _start(stream.writeStream.foreachBatch(apply), checkpoint, available_now)
