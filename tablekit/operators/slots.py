"""Models in partitions other than days: slots of an hour, a day or a month, and lists of keys."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablekit.errors import InvalidSpec
from tablekit.operators import intervals, loads
from tablekit.operators.models import Written
from tablekit.operators.runs import RunLog

SLOT_LOG = "model string, start timestamp_ntz, end timestamp_ntz, run_id string, loaded_at timestamp"
KEY_LOG = "model string, key string, run_id string, loaded_at timestamp"


class LoadLog:
    """Append-only table of what models have loaded: intervals of any grain, or keys."""

    def __init__(self, spark: SparkSession, path: str, schema: str = SLOT_LOG):
        self.spark, self.path, self.schema = spark, path, schema

    def add(self, *rows: tuple) -> None:
        stamp = (uuid.uuid4().hex, datetime.now(timezone.utc))
        data = [(*row, *stamp) for row in rows]
        self.spark.createDataFrame(data, self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)


@dataclass(frozen=True)
class SlotModel:
    """A model in slots of a grain (hour, day, month).

    ``query(spark, start, end)`` returns its rows from ``start`` to before ``end``; ``ts_column`` is a row's time. The
    table gets the slot as text in ``slot_column`` and is partitioned by it.
    """

    name: str
    query: Callable[[SparkSession, datetime, datetime], DataFrame]
    grain: str = "hour"
    ts_column: str = "ts"
    slot_column: str = "slot"


def run_slots(
    spark: SparkSession,
    model: SlotModel,
    start: str | date | datetime,
    end: str | date | datetime,
    table: str,
    path: str | None = None,
    slots: LoadLog | None = None,
    log: RunLog | None = None,
) -> Written:
    """Materialise the slots that ``[start, end)`` touches: their partitions are replaced, all others stay.

    Like :func:`~tablekit.operators.models.run`, with slots of the model's grain in place of days.
    """
    low, high = _aligned(model.grain, start, end)
    ts = F.col(model.ts_column)
    with loads.logged(log, "model", table, "partitions") as result:
        rows = model.query(spark, low, high)
        kind = rows.schema[model.ts_column].dataType
        inside = F.coalesce((ts >= F.lit(low).cast(kind)) & (ts < F.lit(high).cast(kind)), F.lit(False))
        named = rows.withColumn(model.slot_column, intervals.slot(ts, model.grain))
        first, last = (intervals.slot(F.lit(t).cast("timestamp_ntz"), model.grain) for t in (low, high))
        held = F.col(model.slot_column)
        written, outside, gone = _replace_partitions(
            spark, named, inside, table, model.slot_column, (held >= first) & (held < last), path
        )
        if outside:
            result["logs"].append(f"{outside} rows outside {low} to {high} left out")
        result["rows"] = written
        if slots:
            slots.add((model.name, low, high))
    return Written(written, outside)


def _aligned(grain: str, start: str | date | datetime, end: str | date | datetime) -> tuple[datetime, datetime]:
    low, high = intervals.instant(start), intervals.instant(end)
    if high <= low:
        raise InvalidSpec(f"interval ends ({high}) before it starts ({low})")

    def floor(t: datetime) -> datetime:
        t = t.replace(minute=0, second=0, microsecond=0)
        t = t if grain == "hour" else t.replace(hour=0)
        return t.replace(day=1) if grain == "month" else t

    top = floor(high)
    if top < high:
        top = floor(top + timedelta(days=32)) if grain == "month" else top + timedelta(**{f"{grain}s": 1})
    return floor(low), top


def _replace_partitions(
    spark: SparkSession, rows: DataFrame, inside: Column, table: str, column: str, asked: Column, path: str | None
) -> tuple[int, int, int]:
    """Write the rows ``inside`` over their partitions; drop partitions that were ``asked`` for and have no rows now.

    Returns rows written, rows left out, partitions dropped. The rows are computed once.
    """
    stale = set()
    if spark.catalog.tableExists(table):
        cut = F.substring_index("partition", "=", -1)
        held = spark.sql(f"SHOW PARTITIONS {table}").select(F.url_decode(F.replace(cut, F.lit("+"), F.lit("%2B"))).alias(column))
        stale = {r[0] for r in held.where(asked).collect()}
    seen = Observation()
    filled = F.to_json(F.collect_set(F.when(inside, F.col(column))))
    watched = rows.observe(seen, F.count_if(~inside).alias("outside"), filled.alias("filled"))
    written = loads.overwrite_partitions(spark, watched.where(inside), table, [column], path)
    found = seen.get
    gone = sorted(stale - set(json.loads(found["filled"] or "[]")))
    for value in gone:
        loads.drop_partition(spark, table, {column: value})
    return written, found["outside"], len(gone)


def backfill_slots(
    spark: SparkSession,
    model: SlotModel,
    start: str | date | datetime,
    end: str | date | datetime,
    table: str,
    slots: LoadLog,
    path: str | None = None,
    log: RunLog | None = None,
) -> list[tuple[datetime, datetime]]:
    """Load the slots of ``[start, end)`` that are missing, one job per run of them; returns these runs."""
    low, high = _aligned(model.grain, start, end)
    found = intervals.gaps(slots.read(), low, high, model.grain, [model.name])
    todo = [(r.start, r.end) for r in found.orderBy("start").collect()]
    for first, last in todo:
        run_slots(spark, model, first, last, table, path, slots, log)
    return todo


@dataclass(frozen=True)
class KeyedModel:
    """A model in partitions by a text key: ``query(spark, keys)`` returns the rows of these keys."""

    name: str
    query: Callable[[SparkSession, Sequence[str]], DataFrame]
    key_column: str = "key"


def missing_keys(log: DataFrame, model: str, keys: Sequence[str]) -> list[str]:
    """The asked keys that the model has not loaded, in the order asked."""
    asked = log.sparkSession.createDataFrame([(k,) for k in keys], "key string")
    done = {r.key for r in asked.join(log.where(F.col("model") == model), "key", "left_semi").collect()}
    return [k for k in dict.fromkeys(keys) if k not in done]


def run_keys(
    spark: SparkSession,
    model: KeyedModel,
    keys: Sequence[str],
    table: str,
    path: str | None = None,
    loaded: LoadLog | None = None,
    log: RunLog | None = None,
) -> Written:
    """Materialise some keys: their partitions are replaced, or dropped if a key has no rows now; all others stay."""
    if not keys:
        raise InvalidSpec("no keys given")
    with loads.logged(log, "model", table, "partitions") as result:
        rows = model.query(spark, keys)
        own = F.col(model.key_column)
        listed = own.isin(list(keys))
        written, outside, _ = _replace_partitions(
            spark, rows, F.coalesce(listed, F.lit(False)), table, model.key_column, listed, path
        )
        if outside:
            result["logs"].append(f"{outside} rows of other keys left out")
        result["rows"] = written
        if loaded:
            loaded.add(*[(model.name, k) for k in dict.fromkeys(keys)])
    return Written(written, outside)


def backfill_keys(
    spark: SparkSession, model: KeyedModel, keys: Sequence[str], table: str, loaded: LoadLog, path: str | None = None,
    log: RunLog | None = None,
) -> list[str]:
    """Load the keys that are missing, in one job; returns them."""
    todo = missing_keys(loaded.read(), model.name, keys)
    if todo:
        run_keys(spark, model, todo, table, path, loaded, log)
    return todo
