"""Streaming loads and checks; each reads its files to the end and returns what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.operators.checks import CHECK_RESULT, Check
from tablekit.session import scratch_path, scratch_table
from tablekit.streaming import ingest
from tablekit.suite.registry import case, read

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def _events(spark: SparkSession, sf: str, batches: int = 4) -> DataFrame:
    """The events table as a stream of files that is read in batches of a part of its bytes."""
    path = scratch_path(spark, "arrivals")
    read(spark, sf, "events").repartition(2 * batches).write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return ingest.file_stream(spark, path, EVENTS, max_bytes=max(1, size // batches))


@case("stream_ingest", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "ingested")
    stream = _events(spark, sf)
    for _ in range(2):
        # The second run starts from the checkpoint and must add nothing.
        ingest.ingest(stream, path, f"{path}-checkpoint")
    return spark.read.schema(EVENTS).parquet(path)


@case(
    "stream_upsert",
    """
    SELECT user_id, event_type, ts, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Latest event per user and type, partitioned by type. The second half of the month arrives before the first."""
    arrivals, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "checkpoint")
    table = scratch_table(spark, "latest")
    path = scratch_path(spark, table)
    events = read(spark, sf, "events")
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    for second in (True, False):
        events.where((F.col("ts") >= half).eqNullSafe(second) if second else ~(F.col("ts") >= half).eqNullSafe(True)).write.mode("append").parquet(arrivals)
        stream = ingest.file_stream(spark, arrivals, EVENTS)
        ingest.upsert(
            stream, table, ["user_id", "event_type"], checkpoint, ["ts", "event_id"], path, partition_by=["event_type"]
        )
    return spark.table(table).select("user_id", "event_type", "ts", "value")


@case(
    "stream_daily",
    """
    SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS events, round(sum(value), 2) AS value
    FROM events GROUP BY ALL
    """,
)
def stream_daily(spark: SparkSession, sf: str) -> DataFrame:
    daily = ingest.daily(
        _events(spark, sf, 2), "ts", ["event_type"], {"events": F.count(F.lit(1)), "value": F.sum("value")}, "30 days"
    )
    table = scratch_table(spark, "daily")
    ingest.snapshot(daily, table, scratch_path(spark, "checkpoint"), scratch_path(spark, table))
    return spark.table(table).withColumn("value", F.round("value", 2))


# Events arrive in waves of eight days; errors come a wave late, some of them after their day has closed.
WAVE = 8
_WAVES = f"""
    WITH waves AS (SELECT *, CAST(floor((day(ts) - 1) / {WAVE}) AS INTEGER) + CASE event_type WHEN 'error' THEN 1 ELSE 0 END
                   AS wave FROM events WHERE ts IS NOT NULL),
    marks AS (SELECT w.wave, (SELECT max(ts) FROM waves e WHERE e.wave < w.wave) - INTERVAL 1 DAY AS mark
              FROM (SELECT DISTINCT wave FROM waves) w),
    taken AS (SELECT waves.*, CAST(ts AS DATE) AS d FROM waves JOIN marks USING (wave)
              WHERE mark IS NULL OR CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) > mark)
"""


@case(
    "stream_daily_closed",
    _WAVES
    + """
    SELECT d AS day, event_type, count(*) AS events, round(sum(value), 2) AS value FROM taken
    WHERE CAST(d + 1 AS TIMESTAMP) <= (SELECT max(ts) FROM waves) - INTERVAL 1 DAY GROUP BY ALL
    """,
)
def stream_daily_closed(spark: SparkSession, sf: str) -> DataFrame:
    """Days in a table once the watermark has closed them, a day behind the newest event; later rows are dropped.

    Every wave is a run of its own that goes on from the checkpoint, so watermark and open days survive a stop.
    """
    arrivals, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "checkpoint")
    table = scratch_table(spark, "closed")
    events = read(spark, sf, "events").where("ts IS NOT NULL")
    late = F.when(F.col("event_type") == "error", 1).otherwise(0)
    wave = F.floor((F.dayofmonth("ts") - 1) / WAVE) + late
    for n in range(31 // WAVE + 2):
        events.where(wave == n).write.mode("append").parquet(arrivals)
        stream = ingest.file_stream(spark, arrivals, EVENTS)
        aggregates = {"events": F.count(F.lit(1)), "value": F.sum("value")}
        daily = ingest.daily(stream, "ts", ["event_type"], aggregates, "1 day")
        ingest.closed(daily, table, ["event_type"], checkpoint, scratch_path(spark, table))
    return spark.table(table).select("day", "event_type", "events", F.round("value", 2).alias("value"))


@case(
    "stream_checks",
    """
    SELECT check_name, CAST(metric AS DOUBLE) AS metric FROM (
      SELECT 'rows' AS check_name, count(*) AS metric FROM events
      UNION ALL SELECT 'value below 200', count(*) FILTER (WHERE NOT value < 200) FROM events
      UNION ALL SELECT 'user known', count(*) FILTER (WHERE user_id IS NULL) FROM events)
    """,
)
def stream_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Checks per micro-batch; their metrics add up to those of the whole table."""
    results = scratch_path(spark, "results")
    wanted = [
        Check("rows", "row_count", operator="must_be_greater_than"),
        Check("value below 200", "audit", expr="value < 200"),
        Check("user known", "missing_count", ("user_id",)),
    ]
    ingest.check_stream(_events(spark, sf), wanted, results, scratch_path(spark, "checkpoint"), "events", "events")
    saved = spark.read.schema(CHECK_RESULT + ", batch int").parquet(results)
    return saved.groupBy("check_name").agg(F.sum("metric").alias("metric"))
