"""Models evaluated over day intervals: evaluate, materialise, find and fill gaps."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablekit.errors import InvalidSpec
from tablekit.operators import loads
from tablekit.operators.runs import RunLog

INTERVAL_LOG = "model string, start_date date, end_date date, run_id string, loaded_at timestamp"

# First day of a model that names none, and the usual ``limit`` of a preview.
DEFAULT_START = "2024-01-01"
PREVIEW_ROWS = 1000


def _day(value: str | date) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def interval(df: DataFrame, ts: str, start: str | date | None, end: str | date | None) -> Column:
    """Rows of the days ``start`` to ``end``, both included. Compares the bare column, so it is pushed down."""
    dtype = df.schema[ts].dataType
    condition = F.lit(True)
    if start is not None:
        condition = condition & (F.col(ts) >= F.lit(_day(start)).cast(dtype))
    if end is not None:
        condition = condition & (F.col(ts) < F.lit(_day(end) + timedelta(days=1)).cast(dtype))
    return condition


@dataclass(frozen=True)
class Model:
    """A named query over an interval.

    ``query(spark, start, end)`` returns the model's rows; days are inclusive and None means open.
    An incremental model's rows carry their day in ``day_column``.
    """

    name: str
    query: Callable[[SparkSession, date | None, date | None], DataFrame]
    day_column: str = "day"
    start: str = DEFAULT_START


def evaluate(
    spark: SparkSession, model: Model, start: str | date, end: str | date, limit: int | None = None
) -> DataFrame:
    """The model's rows for an interval; a ``limit`` that is asked for cuts before anything is fetched."""
    first, last = _day(start), _day(end)
    if last < first:
        raise InvalidSpec(f"interval ends ({last}) before it starts ({first})")
    df = model.query(spark, first, last)
    return df if limit is None else df.limit(limit)


class IntervalLog:
    """Append-only table of the intervals each model has loaded."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def add(self, model: str, start: date, end: date, run_id: str) -> None:
        row = (model, start, end, run_id, datetime.now(timezone.utc))
        self.spark.createDataFrame([row], INTERVAL_LOG).coalesce(1).write.mode("append").parquet(self.path)

    def forget(self, model: str, ranges: Sequence[tuple[date, date]]) -> None:
        """These days are stale until they are loaded again: rows without a run."""
        now = datetime.now(timezone.utc)
        rows = [(model, start, end, None, now) for start, end in ranges]
        if rows:
            self.spark.createDataFrame(rows, INTERVAL_LOG).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        """The intervals that hold; days that were forgotten count from their next load on."""
        try:
            rows = self.spark.read.schema(INTERVAL_LOG).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], INTERVAL_LOG)
        if rows.where("run_id IS NULL").isEmpty():
            return rows
        day = F.explode(F.sequence("start_date", "end_date")).alias("day")
        days = rows.where("start_date <= end_date").select("model", day, F.struct("loaded_at", "run_id").alias("last"))
        held = days.groupBy("model", "day").agg(F.max("last").alias("last")).where("last.run_id IS NOT NULL")
        return held.select("model", F.col("day").alias("start_date"), F.col("day").alias("end_date"), "last.run_id", "last.loaded_at")


class Written(int):
    """Rows written, and in ``outside`` how many rows of the model were left out."""

    outside: int

    def __new__(cls, rows: int, outside: int) -> Written:
        self = super().__new__(cls, rows)
        self.outside = outside
        return self


def run(
    spark: SparkSession,
    model: Model,
    start: str | date,
    end: str | date,
    table: str,
    path: str | None = None,
    intervals: IntervalLog | None = None,
    log: RunLog | None = None,
) -> Written:
    """Materialise an interval: its day partitions are replaced, all others stay.

    Returns the rows written. Days of the interval that now have no rows lose their old partition, so running twice,
    or after late deletes, leaves exactly what the model says. Rows of the model outside the interval, or without
    a day, are left out: their number is the result's ``outside`` and is logged.
    """
    first, last = _day(start), _day(end)
    with loads.logged(log, "model", table, "partitions") as result:
        rows = evaluate(spark, model, first, last)
        stale = _partition_days(spark, table, model.day_column, first, last)
        day = F.col(model.day_column)
        inside = F.coalesce(day.between(F.lit(first), F.lit(last)), F.lit(False))
        # Counted while the rows are written, so the model is computed once; at most one day per day asked for.
        days = F.concat_ws(",", F.collect_set(F.when(inside, day.cast("date").cast("string"))))
        seen = Observation()
        watched = rows.observe(seen, F.count_if(~inside).alias("outside"), days.alias("days"))
        result["rows"] = loads.overwrite_partitions(spark, watched.where(inside), table, [model.day_column], path)
        found = seen.get
        if found["outside"]:
            result["logs"].append(f"{found['outside']} rows outside {first} to {last} left out")
        written = {date.fromisoformat(d) for d in found["days"].split(",") if d}
        for gone in sorted(stale - written):
            loads.drop_partition(spark, table, {model.day_column: gone.isoformat()})
        if intervals:
            intervals.add(model.name, first, last, uuid.uuid4().hex)
    return Written(result["rows"], found["outside"])


def _partition_days(spark: SparkSession, table: str, column: str, first: date, last: date) -> set[date]:
    """Existing day partitions inside the interval (at most one per day asked for)."""
    if not spark.catalog.tableExists(table):
        return set()
    days = spark.sql(f"SHOW PARTITIONS {table}").select(
        F.regexp_extract("partition", f"{column}=([0-9-]+)", 1).cast("date").alias("d")
    )
    return {r.d for r in days.where(F.col("d").between(F.lit(first), F.lit(last))).distinct().collect()}


def full_refresh(
    spark: SparkSession, model: Model, table: str, path: str | None = None, log: RunLog | None = None
) -> int:
    """Rebuild a model as a whole and replace its table."""
    return loads.load(spark, model.query(spark, None, None), table, "replace", path=path, log=log)


def missing_days(
    intervals: DataFrame, start: str | date, end: str | date, models: Sequence[str] | None = None
) -> DataFrame:
    """``(model, day)`` for every day of ``[start, end]`` that no logged interval of the model covers.

    ``models`` adds models that may have no log row at all. Intervals are cut to the asked range
    before they are listed by day, so a model has at most as many rows as there are days.
    """
    first, last = F.lit(_day(start)), F.lit(_day(end))
    known = intervals.select("model").distinct()
    if models is not None:
        asked = intervals.sparkSession.createDataFrame([(m,) for m in models], "model string")
        known = asked
        intervals = intervals.join(asked, "model", "left_semi")
    spine = known.select("model", F.explode(F.sequence(first, last)).alias("day"))
    covered = intervals.where((F.col("start_date") <= last) & (F.col("end_date") >= first)).where(
        F.col("start_date") <= F.col("end_date")
    )
    loaded = covered.select(
        "model",
        F.explode(F.sequence(F.greatest("start_date", first), F.least("end_date", last))).alias("day"),
    ).distinct()
    return spine.join(loaded, ["model", "day"], "left_anti")


def day_ranges(days: DataFrame) -> DataFrame:
    """Runs of consecutive days as ``(model, start_date, end_date, days)``."""
    position = F.row_number().over(Window.partitionBy("model").orderBy("day"))
    islands = days.withColumn("__island", F.date_sub("day", position))
    return (
        islands.groupBy("model", "__island")
        .agg(F.min("day").alias("start_date"), F.max("day").alias("end_date"), F.count(F.lit(1)).alias("days"))
        .drop("__island")
    )


def backfill(
    spark: SparkSession,
    model: Model,
    start: str | date,
    end: str | date,
    table: str,
    intervals: IntervalLog,
    path: str | None = None,
    log: RunLog | None = None,
) -> list[tuple[date, date]]:
    """Load what is missing in ``[start, end]``, one job per run of missing days; returns these runs."""
    gaps = day_ranges(missing_days(intervals.read(), start, end, [model.name]))
    todo = [(r.start_date, r.end_date) for r in gaps.orderBy("start_date").collect()]
    for first, last in todo:
        run(spark, model, first, last, table, path, intervals, log)
    return todo
