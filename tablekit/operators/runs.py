"""The run log, and analytics over runs, logs, sizes and labels."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablekit.errors import InvalidSpec

RUN_LOG = (
    "run_id string, kind string, target string, status string, started_at timestamp, "
    "completed_at timestamp, rows_written bigint, disposition string, metrics map<string,double>, "
    "logs array<string>"
)


class RunLog:
    """Append-only table of run states: one row when a run starts and one when it ends."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _append(self, row: tuple) -> None:
        self.spark.createDataFrame([row], RUN_LOG).coalesce(1).write.mode("append").parquet(self.path)

    def start(self, kind: str, target: str, disposition: str | None = None) -> dict:
        run = {
            "run_id": uuid.uuid4().hex,
            "kind": kind,
            "target": target,
            "disposition": disposition,
            "started_at": datetime.now(timezone.utc),
        }
        self._append(self._row(run, "RUNNING", None, None, {}, []))
        return run

    def finish(self, run: dict, rows: int | None, metrics: dict | None = None, logs: Sequence[str] = ()) -> None:
        self._append(self._row(run, "SUCCESS", datetime.now(timezone.utc), rows, metrics or {}, list(logs)))

    def fail(self, run: dict, error: BaseException) -> None:
        self._append(self._row(run, "FAILURE", datetime.now(timezone.utc), None, {}, [str(error)]))

    @staticmethod
    def _row(run, status, completed, rows, metrics, logs) -> tuple:
        return (
            run["run_id"], run["kind"], run["target"], status, run["started_at"], completed, rows,
            run["disposition"], metrics, logs,
        )

    def read(self) -> DataFrame:
        """The latest state of every run."""
        return latest_state(self.spark.read.schema(RUN_LOG).parquet(self.path))


def latest_state(log: DataFrame) -> DataFrame:
    """One row per run: its end state if there is one, else RUNNING."""
    newest = Window.partitionBy("run_id").orderBy(F.col("completed_at").desc_nulls_last())
    return log.withColumn("__rn", F.row_number().over(newest)).where("__rn = 1").drop("__rn")


def recent_runs(
    log: DataFrame, target: str | None = None, status: str | None = None, limit: int | None = None
) -> DataFrame:
    """The runs, newest first, filtered first and cut afterwards if a ``limit`` is asked for."""
    if target is not None:
        log = log.where(F.col("target") == target)
    if status is not None:
        log = log.where(F.col("status") == status)
    newest = log.orderBy(F.col("started_at").desc(), F.col("run_id"))
    return newest if limit is None else newest.limit(limit)


def run_metrics(log: DataFrame) -> DataFrame:
    """Runs, successes, failures, success rate and mean/approximate-p95 duration per target."""
    seconds = F.timestamp_diff("SECOND", F.col("started_at"), F.col("completed_at"))
    ok, failed = F.count_if(F.col("status") == "SUCCESS"), F.count_if(F.col("status") == "FAILURE")
    return log.groupBy("target").agg(
        F.count(F.lit(1)).alias("total_runs"),
        ok.alias("successful_runs"),
        failed.alias("failed_runs"),
        F.try_divide(ok, F.count(F.lit(1))).alias("success_rate"),
        F.avg(seconds).alias("avg_seconds"),
        F.percentile_approx(seconds, 0.95).alias("approx_p95_seconds"),
    )


def run_logs(log: DataFrame, run_id: str | None = None) -> DataFrame:
    """Log lines of one run (or all) as rows; an unknown run has none."""
    if run_id is not None:
        log = log.where(F.col("run_id") == run_id)
    return log.select("run_id", "target", "status", F.posexplode("logs").alias("line_no", "line"))


# Duration suffix -> SQL interval unit.
_UNITS = {"s": "SECOND", "m": "MINUTE", "h": "HOUR", "d": "DAY"}


def _since(df: DataFrame, ts: str, since: str | datetime, now: str | datetime | Column | None) -> Column:
    dtype = df.schema[ts].dataType
    if isinstance(since, str) and since[:-1].isdigit() and since[-1:] in _UNITS:
        base = F.current_timestamp() if now is None else (now if isinstance(now, Column) else F.lit(now))
        return base.cast(dtype) - F.expr(f"INTERVAL '{since[:-1]}' {_UNITS[since[-1]]}")
    return F.lit(since).cast(dtype)


def tail_since(
    df: DataFrame, ts: str, n: int, since: str | datetime | None = None, now=None, ties: Sequence[str] = ()
) -> DataFrame:
    """The newest ``n`` rows, optionally only those since a timestamp or a duration like ``5m``.

    ``now`` is what a duration counts back from (default: the current time).
    """
    if since is not None:
        df = df.where(F.col(ts) >= _since(df, ts, since, now))
    return df.orderBy(F.col(ts).desc(), *ties).limit(n)


def tail_per_group(df: DataFrame, group: Sequence[str], ts: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The newest ``n`` rows of every group.

    Spark keeps only ``n`` rows per group and task before it shuffles, so a hot group costs no more
    than its ``n`` rows per task.
    """
    if n < 1:
        raise InvalidSpec("n must be at least 1")
    newest = Window.partitionBy(*group).orderBy(F.col(ts).desc(), *ties)
    return df.withColumn("__rn", F.row_number().over(newest)).where(F.col("__rn") <= n).drop("__rn")


# Bytes per unit.
MIB = 1_048_576
GIB = 1_073_741_824


def size_rollup(df: DataFrame, kind: str | Column, size: Column) -> DataFrame:
    """Bytes per kind (missing sizes count as 0), also in MiB (1 decimal) and GiB (2 decimals)."""
    kind = F.col(kind) if isinstance(kind, str) else kind
    totals = df.groupBy(kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("items"), F.sum(F.coalesce(size, F.lit(0))).alias("bytes")
    )
    return totals.withColumns(
        {"mib": F.round(F.col("bytes") / MIB, 1), "gib": F.round(F.col("bytes") / GIB, 2)}
    )


def label_filter(
    df: DataFrame, labels: str, key: str | None = None, value: str | None = None,
    name: str | None = None, contains: str | None = None,
) -> DataFrame:
    """Rows whose label map has ``key`` (equal to ``value`` if given) and whose name contains a text."""
    if key is not None:
        held = F.try_element_at(F.col(labels), F.lit(key))
        df = df.where(F.map_contains_key(F.col(labels), key) if value is None else held == value)
    if contains is not None:
        df = df.where(F.col(name).contains(contains))
    return df
