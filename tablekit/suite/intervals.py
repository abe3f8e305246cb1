"""Interval models, lineage, and run analytics over the given tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.functions import redact
from tablekit.operators import edges, models, plan, runs, slots
from tablekit.operators import intervals as sets
from tablekit.session import scratch_path, scratch_table
from tablekit.suite.registry import case, read


def daily_model(sf: str) -> models.Model:
    """Events per day and type."""

    def query(spark: SparkSession, start: date | None, end: date | None) -> DataFrame:
        events = read(spark, sf, "events")
        return (
            events.where(models.interval(events, "ts", start, end))
            .groupBy(F.col("ts").cast("date").alias("day"), "event_type")
            .agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("value"))
        )

    return models.Model("daily_events", query)


_DAILY = """
    SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS events, round(sum(value), 2) AS value FROM events
    {where} GROUP BY ALL
"""


@case("model_evaluate", _DAILY.format(where="WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'"))
def model_evaluate(spark: SparkSession, sf: str) -> DataFrame:
    return models.evaluate(spark, daily_model(sf), "2024-01-08", "2024-01-14")


@case("model_evaluate_rows", "SELECT CAST(ts AS DATE) AS day, event_id, value FROM events WHERE ts < TIMESTAMP '2024-02-01'")
def model_evaluate_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A model with a row per event, for the whole month."""

    def query_(session: SparkSession, start: date | None, end: date | None) -> DataFrame:
        events = read(session, sf, "events").where(models.interval(read(session, sf, "events"), "ts", start, end))
        return events.select(F.col("ts").cast("date").alias("day"), "event_id", "value")

    return models.evaluate(spark, models.Model("events", query_), "2024-01-01", "2024-01-31")


@case(
    "model_rerun",
    _DAILY.format(where="WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-09' "
                        "AND CAST(ts AS DATE) <> DATE '2024-01-02'"),
)
def model_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """A day vanishes at the source, its interval runs again, then other days are loaded: it stays away."""
    table = scratch_table(spark, "daily")
    path = scratch_path(spark, table)
    model = daily_model(sf)
    models.run(spark, model, "2024-01-01", "2024-01-05", table, path)
    thinner = models.Model("daily_events", lambda s, a, b: model.query(s, a, b).where("day <> DATE '2024-01-02'"))
    models.run(spark, thinner, "2024-01-01", "2024-01-03", table, path)
    models.run(spark, thinner, "2024-01-06", "2024-01-08", table, path)
    return spark.table(table)


@case("model_run", _DAILY.format(where="WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-21'"))
def model_run(spark: SparkSession, sf: str) -> DataFrame:
    """Two overlapping intervals; the second replaces the shared days."""
    table = scratch_table(spark, "daily")
    path = scratch_path(spark, table)
    log = models.IntervalLog(spark, f"{path}-intervals")
    model = daily_model(sf)
    models.run(spark, model, "2024-01-03", "2024-01-12", table, path, log)
    models.run(spark, model, "2024-01-10", "2024-01-20", table, path, log)
    return spark.table(table)


@case("model_full", _DAILY.format(where=""))
def model_full(spark: SparkSession, sf: str) -> DataFrame:
    table = scratch_table(spark, "daily")
    models.full_refresh(spark, daily_model(sf), table, scratch_path(spark, table))
    return spark.table(table)


def _user_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as an interval log: a user's purchase covers its day and the next one."""
    return read(spark, sf, "events").where("event_type = 'purchase'").select(
        F.concat(F.lit("user_"), F.col("user_id")).alias("model"),
        F.col("ts").cast("date").alias("start_date"),
        F.date_add(F.col("ts").cast("date"), 1).alias("end_date"),
    )


_GAPS = """
    WITH log AS (SELECT DISTINCT 'user_' || user_id AS model, CAST(ts AS DATE) AS d FROM events
                 WHERE event_type = 'purchase'),
    spine AS (SELECT model, CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE)
              AS day FROM (SELECT DISTINCT model FROM log)),
    gaps AS (SELECT model, day FROM spine WHERE NOT EXISTS (
               SELECT 1 FROM log WHERE log.model = spine.model AND spine.day BETWEEN log.d AND log.d + 1))
"""


@case("interval_gaps", _GAPS + "SELECT model, day FROM gaps")
def interval_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return models.missing_days(_user_log(spark, sf), "2024-01-01", "2024-01-31")


@case(
    "interval_ranges",
    _GAPS
    + """
    SELECT model, min(day) AS start_date, max(day) AS end_date, count(*) AS days
    FROM (SELECT model, day, day - CAST(row_number() OVER (PARTITION BY model ORDER BY day) AS INTEGER) AS island FROM gaps)
    GROUP BY model, island
    """,
)
def interval_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return models.day_ranges(models.missing_days(_user_log(spark, sf), "2024-01-01", "2024-01-31"))


@case("interval_backfill", _DAILY.format(where="WHERE ts < TIMESTAMP '2024-01-31'"))
def interval_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """A table with a hole in the middle and missing ends, filled by one job per run of missing days."""
    table = scratch_table(spark, "daily")
    path = scratch_path(spark, table)
    log = models.IntervalLog(spark, f"{path}-intervals")
    model = daily_model(sf)
    models.run(spark, model, "2024-01-05", "2024-01-09", table, path, log)
    models.run(spark, model, "2024-01-15", "2024-01-22", table, path, log)
    models.backfill(spark, model, "2024-01-01", "2024-01-30", table, log, path)
    return spark.table(table)


@case(
    "interval_hours",
    """
    SELECT strftime(ts, '%Y-%m-%dT%H') AS slot, event_type, count(*) AS events, round(sum(value), 2) AS value
    FROM events WHERE ts >= TIMESTAMP '2024-01-02 22:00:00' AND ts < TIMESTAMP '2024-01-07' GROUP BY ALL
    """,
)
def interval_hours(spark: SparkSession, sf: str) -> DataFrame:
    """A model by the hour with a hole of some hours and missing ends, filled by one job per run of missing hours."""

    def query(session: SparkSession, start: datetime, end: datetime) -> DataFrame:
        events = read(session, sf, "events").where((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(end)))
        hour = sets.floor(F.col("ts"), "hour").alias("ts")
        return events.groupBy(hour, "event_type").agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("value"))

    table = scratch_table(spark, "hourly")
    path = scratch_path(spark, table)
    log = slots.LoadLog(spark, f"{path}-slots")
    model = slots.SlotModel("hourly_events", query)
    slots.run_slots(spark, model, "2024-01-03", "2024-01-05 07:00:00", table, path, log)
    slots.run_slots(spark, model, "2024-01-05 12:30:00", "2024-01-06 03:15:00", table, path, log)
    slots.backfill_slots(spark, model, "2024-01-02 22:00:00", "2024-01-07", table, log, path)
    return spark.table(table).select("slot", "event_type", "events", "value")


@case(
    "interval_months",
    """
    SELECT strftime(l_shipdate, '%Y-%m') AS slot, l_returnflag, count(*) AS lines, round(sum(l_quantity), 2) AS quantity
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1997-01-01' GROUP BY ALL
    """,
)
def interval_months(spark: SparkSession, sf: str) -> DataFrame:
    """A model by the month; a month is loaded only if all of it is."""

    def query(session: SparkSession, start: datetime, end: datetime) -> DataFrame:
        lines = read(session, sf, "lineitem").where((F.col("l_shipdate") >= F.lit(start)) & (F.col("l_shipdate") < F.lit(end)))
        month = sets.floor(F.col("l_shipdate"), "month").alias("ts")
        return lines.groupBy(month, "l_returnflag").agg(
            F.count(F.lit(1)).alias("lines"), F.round(F.sum("l_quantity"), 2).alias("quantity")
        )

    table = scratch_table(spark, "monthly")
    path = scratch_path(spark, table)
    log = slots.LoadLog(spark, f"{path}-slots")
    model = slots.SlotModel("monthly_lines", query, "month")
    slots.run_slots(spark, model, "1995-03-15", "1995-06-02", table, path, log)
    slots.run_slots(spark, model, "1996-02-01", "1996-03-01", table, path, log)
    slots.backfill_slots(spark, model, "1995-01-01", "1996-12-31", table, log, path)
    return spark.table(table).select("slot", "l_returnflag", "lines", "quantity")


@case(
    "partition_keys",
    """
    SELECT c_mktsegment AS segment, c_nationkey, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
    FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD') GROUP BY ALL
    """,
)
def partition_keys(spark: SparkSession, sf: str) -> DataFrame:
    """A model in partitions by key: two keys are loaded, one of them empty at first, then what is missing of a list."""

    def query(session: SparkSession, keys: list[str]) -> DataFrame:
        customers = read(session, sf, "customer").where(F.col("c_mktsegment").isin(list(keys)))
        return customers.groupBy("c_nationkey", F.col("c_mktsegment").alias("segment")).agg(
            F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")
        )

    table = scratch_table(spark, "segments")
    path = scratch_path(spark, table)
    log = slots.LoadLog(spark, f"{path}-keys", slots.KEY_LOG)
    model = slots.KeyedModel("segments", query, "segment")
    slots.run_keys(spark, model, ["BUILDING", "no such segment"], table, path, log)
    slots.run_keys(spark, model, ["BUILDING"], table, path, log)
    slots.backfill_keys(spark, model, ["MACHINERY", "BUILDING", "AUTOMOBILE", "HOUSEHOLD", "no such segment"], table, log, path)
    return spark.table(table).select("segment", "c_nationkey", "customers", "balance")


def _spells(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Events of a type as intervals of their value in minutes, by the last digit of the user."""
    length = F.make_dt_interval(secs=F.round(F.col("value") * 60, 0))
    return read(spark, sf, "events").where(F.col("event_type") == kind).select(
        (F.col("user_id") % 10).alias("model"), F.date_trunc("second", "ts").cast("timestamp_ntz").alias("start"),
        (F.date_trunc("second", "ts").cast("timestamp_ntz") + length).alias("end"),
    )


_SPELLS = """
    WITH spells AS (
      SELECT event_type, user_id % 10 AS model, date_trunc('second', ts) AS "start",
        date_trunc('second', ts) + to_seconds(CAST(round(value * 60, 0) AS BIGINT)) AS "end" FROM events),
    ends AS (
      SELECT model, "start" AS t, CASE event_type WHEN 'view' THEN 1 ELSE 0 END AS l, CASE event_type WHEN 'error' THEN 1 ELSE 0 END AS r
      FROM spells WHERE "start" < "end" AND event_type IN ('view', 'error')
      UNION ALL SELECT model, "end", CASE event_type WHEN 'view' THEN -1 ELSE 0 END, CASE event_type WHEN 'error' THEN -1 ELSE 0 END
      FROM spells WHERE "start" < "end" AND event_type IN ('view', 'error')),
    steps AS (SELECT model, t, sum(l) AS l, sum(r) AS r FROM ends GROUP BY model, t),
    swept AS (SELECT model, t AS "start", lead(t) OVER w AS "end", sum(l) OVER w AS l, sum(r) OVER w AS r
              FROM steps WINDOW w AS (PARTITION BY model ORDER BY t)),
    kept AS (SELECT model, "start", "end", "start" IS DISTINCT FROM lag("end") OVER (PARTITION BY model ORDER BY "start") AS fresh
             FROM swept WHERE {where}),
    runs AS (SELECT *, count(*) FILTER (WHERE fresh) OVER (PARTITION BY model ORDER BY "start") AS run FROM kept)
    SELECT model, min("start") AS "start", max("end") AS "end" FROM runs GROUP BY model, run
"""


@case("interval_merge", _SPELLS.format(where="l > 0"))
def interval_merge(spark: SparkSession, sf: str) -> DataFrame:
    return sets.merge(_spells(spark, sf, "view"), ["model"])


@case("interval_subtract", _SPELLS.format(where="l > 0 AND r = 0"))
def interval_subtract(spark: SparkSession, sf: str) -> DataFrame:
    return sets.subtract(_spells(spark, sf, "view"), _spells(spark, sf, "error"), ["model"])


@case("interval_intersect", _SPELLS.format(where="l > 0 AND r > 0"))
def interval_intersect(spark: SparkSession, sf: str) -> DataFrame:
    return sets.intersect(_spells(spark, sf, "view"), _spells(spark, sf, "error"), ["model"])


@case(
    "model_selection",
    """
    WITH days AS (SELECT CAST(ts AS DATE) AS day, count(*) AS events, round(sum(value), 2) AS value FROM events
                  WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-21' GROUP BY 1)
    SELECT day, events, value, events - coalesce(lag(events) OVER (ORDER BY day), 0) AS more FROM days
    """,
)
def model_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Three models, each reading the one before: events by type, all events, and the change since the day before.

    All run while four days of the first are missing. Then the first is selected with all that need it: its hole is
    filled, and the days that this changes further down, with the day after them, are loaded again.
    """
    names = ("by_type", "by_day", "change")
    tables = {n: scratch_table(spark, n) for n in names}
    first = daily_model(sf)

    def by_day(session: SparkSession, start: date | None, end: date | None) -> DataFrame:
        rows = session.table(tables["by_type"])
        return rows.where(models.interval(rows, "day", start, end)).groupBy("day").agg(
            F.sum("events").alias("events"), F.round(F.sum("value"), 2).alias("value")
        )

    def change(session: SparkSession, start: date | None, end: date | None) -> DataFrame:
        rows = session.table(tables["by_day"])
        own = rows.where(models.interval(rows, "day", start, end))
        last = rows.select(F.date_add("day", 1).alias("day"), F.col("events").alias("last"))
        joined = own.join(last, "day", "left")
        return joined.select("events", "value", (F.col("events") - F.coalesce("last", F.lit(0))).alias("more"), "day")

    def node(name: str, query, needs: tuple[str, ...] = (), reach: int = 0) -> plan.Node:
        return plan.Node(models.Model(name, query), tables[name], needs, reach, scratch_path(spark, tables[name]))

    by_type = node("by_type", first.query)
    nodes = [node("change", change, ("by_day",), 1), node("by_day", by_day, ("by_type",)), by_type]
    log = models.IntervalLog(spark, scratch_path(spark, "intervals"))
    for start, end in (("2024-01-01", "2024-01-05"), ("2024-01-10", "2024-01-20")):
        models.run(spark, by_type.model, start, end, by_type.table, by_type.path, log)
    plan.apply(spark, nodes, "2024-01-01", "2024-01-20", log, "by_day, change")
    plan.apply(spark, nodes, "2024-01-01", "2024-01-20", log, "by_type+")
    return spark.table(tables["change"]).select("day", "events", "value", "more")


def lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Edges region -> nation -> customer -> order, and nation -> supplier."""

    def link(df: DataFrame, src: str, src_key: str, dst: str, dst_key: str) -> DataFrame:
        return df.select(
            F.concat(F.lit(f"{src}:"), F.col(src_key)).alias("src"),
            F.concat(F.lit(f"{dst}:"), F.col(dst_key)).alias("dst"),
        )

    return (
        link(read(spark, sf, "nation"), "region", "n_regionkey", "nation", "n_nationkey")
        .unionByName(link(read(spark, sf, "customer"), "nation", "c_nationkey", "customer", "c_custkey"))
        .unionByName(link(read(spark, sf, "supplier"), "nation", "s_nationkey", "supplier", "s_suppkey"))
        .unionByName(link(read(spark, sf, "orders"), "customer", "o_custkey", "order", "o_orderkey"))
    )


_EDGES = """
    WITH RECURSIVE edges AS (
      SELECT 'region:' || n_regionkey AS src, 'nation:' || n_nationkey AS dst FROM nation
      UNION ALL SELECT 'nation:' || c_nationkey, 'customer:' || c_custkey FROM customer
      UNION ALL SELECT 'nation:' || s_nationkey, 'supplier:' || s_suppkey FROM supplier
      UNION ALL SELECT 'customer:' || o_custkey, 'order:' || o_orderkey FROM orders)
"""


@case(
    "edge_neighbors",
    _EDGES
    + "SELECT dst AS node, src AS dependency, count(*) OVER (PARTITION BY dst) AS dependencies FROM (SELECT DISTINCT * FROM edges)",
)
def edge_neighbors(spark: SparkSession, sf: str) -> DataFrame:
    return edges.neighbors(lineage(spark, sf))


@case(
    "edge_closure",
    _EDGES
    + """
    , reach AS (SELECT src, dst, 1 AS depth FROM edges WHERE starts_with(src, 'region:')
                UNION ALL SELECT r.src, e.dst, r.depth + 1 FROM reach r JOIN edges e ON r.dst = e.src WHERE r.depth < 3)
    SELECT src AS node, dst AS related, 'downstream' AS direction, min(depth) AS depth FROM reach GROUP BY ALL
    """,
)
def edge_closure(spark: SparkSession, sf: str) -> DataFrame:
    """All that three steps from any region reach."""
    regions = read(spark, sf, "region").select(F.concat(F.lit("region:"), F.col("r_regionkey")).alias("start"))
    return edges.closure(lineage(spark, sf), regions, "downstream", 3)


@case(
    "edge_closure_node",
    _EDGES
    + """
    , down AS (SELECT dst, 1 AS depth FROM edges WHERE src = 'nation:3'
               UNION ALL SELECT e.dst, d.depth + 1 FROM down d JOIN edges e ON d.dst = e.src),
    up AS (SELECT src, 1 AS depth FROM edges WHERE dst = 'nation:3'
           UNION ALL SELECT e.src, u.depth + 1 FROM up u JOIN edges e ON u.src = e.dst)
    SELECT 'nation:3' AS node, dst AS related, 'downstream' AS direction, min(depth) AS depth FROM down GROUP BY ALL
    UNION ALL SELECT 'nation:3', src, 'upstream', min(depth) FROM up GROUP BY ALL
    """,
)
def edge_closure_node(spark: SparkSession, sf: str) -> DataFrame:
    return edges.closure(lineage(spark, sf), ["nation:3"])


# Events read as a run log. Errors are failed runs, views are still running.
_RUNS = """
    SELECT 'run-' || event_id AS run_id, 'user_' || user_id AS target,
           CASE event_type WHEN 'error' THEN 'FAILURE' WHEN 'view' THEN 'RUNNING' ELSE 'SUCCESS' END AS status,
           ts AS started_at, CAST(floor(value) AS BIGINT) AS seconds FROM events
"""


def run_table(spark: SparkSession, sf: str) -> DataFrame:
    seconds = F.floor("value")
    status = (
        F.when(F.col("event_type") == "error", "FAILURE")
        .when(F.col("event_type") == "view", "RUNNING")
        .otherwise("SUCCESS")
    )
    started = F.col("ts").cast("timestamp")
    ended = F.when(F.col("event_type") != "view", started + F.make_dt_interval(secs=seconds))
    return read(spark, sf, "events").select(
        F.concat(F.lit("run-"), F.col("event_id")).alias("run_id"),
        F.lit("load").alias("kind"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("target"),
        status.alias("status"),
        started.alias("started_at"),
        ended.alias("completed_at"),
        F.col("event_id").alias("rows_written"),
        F.lit("append").alias("disposition"),
        F.create_map(F.lit("value"), F.col("value")).alias("metrics"),
        F.array(F.concat(F.lit("type "), F.col("event_type")), F.concat(F.lit("props "), F.col("props"))).alias("logs"),
    )


@case(
    "runs_recent",
    f"SELECT run_id, target, status, started_at FROM ({_RUNS}) WHERE status = 'FAILURE' "
    "ORDER BY started_at DESC, run_id LIMIT 50",
)
def runs_recent(spark: SparkSession, sf: str) -> DataFrame:
    newest = runs.recent_runs(run_table(spark, sf), status="FAILURE", limit=50)
    return newest.select("run_id", "target", "status", F.col("started_at").cast("timestamp_ntz").alias("started_at"))


@case(
    "run_metrics",
    f"""
    SELECT target, count(*) AS total_runs, count(*) FILTER (WHERE status = 'SUCCESS') AS successful_runs,
           count(*) FILTER (WHERE status = 'FAILURE') AS failed_runs,
           round(count(*) FILTER (WHERE status = 'SUCCESS') / count(*), 6) AS success_rate,
           round(avg(CASE WHEN status <> 'RUNNING' THEN seconds END), 6) AS avg_seconds,
           CAST(quantile_disc(CASE WHEN status <> 'RUNNING' THEN seconds END, 0.95) AS BIGINT) AS approx_p95_seconds
    FROM ({_RUNS}) GROUP BY target
    """,
)
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    metrics = runs.run_metrics(run_table(spark, sf))
    return metrics.withColumns({c: F.round(c, 6) for c in ("success_rate", "avg_seconds")})


@case(
    "run_logs",
    f"""
    SELECT run_id, target, status, line_no, line FROM (
      SELECT r.run_id, r.target, r.status, 0 AS line_no, 'type ' || event_type AS line
      FROM ({_RUNS}) r JOIN events ON r.run_id = 'run-' || event_id
      UNION ALL SELECT r.run_id, r.target, r.status, 1, 'props ' || props
      FROM ({_RUNS}) r JOIN events ON r.run_id = 'run-' || event_id)
    """,
)
def run_logs(spark: SparkSession, sf: str) -> DataFrame:
    return runs.run_logs(run_table(spark, sf))


@case(
    "tail_since",
    """
    SELECT event_id, ts, event_type FROM events
    WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 6 HOUR ORDER BY ts DESC, event_id LIMIT 100
    """,
)
def tail_since(spark: SparkSession, sf: str) -> DataFrame:
    """The newest 100 events of the six hours before the last one."""
    events = read(spark, sf, "events").select("event_id", "ts", "event_type")
    last = events.agg(F.max("ts")).scalar()
    return runs.tail_since(events, "ts", 100, "6h", now=last, ties=["event_id"])


@case(
    "tail_per_group",
    """
    SELECT user_id, event_id, ts, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) <= 5
    """,
)
def tail_per_group(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    return runs.tail_per_group(events, ["user_id"], "ts", 5, ["event_id"])


@case(
    "size_rollup",
    """
    SELECT source AS kind, count(*) AS items, CAST(sum(coalesce(size, 0)) AS BIGINT) AS bytes,
           round(sum(coalesce(size, 0)) / 1048576, 1) AS mib, round(sum(coalesce(size, 0)) / 1073741824, 2) AS gib
    FROM (SELECT source, CASE WHEN lang <> 'es' THEN n_chars * 1000 END AS size FROM documents) GROUP BY source
    """,
)
def size_rollup(spark: SparkSession, sf: str) -> DataFrame:
    size = F.when(F.col("lang") != "es", F.col("n_chars") * 1000)
    return runs.size_rollup(read(spark, sf, "documents"), "source", size)


def _env() -> Column:
    """Every event as KEY=value pairs, one of them with a second equals sign, one without any."""
    return F.array(
        F.concat(F.lit("USER="), F.col("user_id")),
        F.concat(F.lit("db_password=p"), F.col("event_id")),
        F.concat(F.lit("QUERY=a="), F.col("value")),
        F.concat(F.lit("Session_Token=t"), F.col("user_id")),
        F.upper("event_type"),
    )


@case(
    "redact_keys",
    """
    SELECT event_id, 'user=' || user_id || ';db_password=***REDACTED***;query=a=' || value || ';token=***REDACTED***;'
           || upper(event_type) || '=' AS env,
           '***REDACTED***' AS api_key, event_type AS plain, '***REDACTED***' AS inner_secret, value AS inner_value
    FROM events
    """,
)
def redact_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs, a map and a nested struct; the masked forms are spread out as columns."""
    events = read(spark, sf, "events").select(
        "event_id",
        "event_type",
        redact.redact_pairs(_env()).alias("env"),
        F.create_map(F.lit("api_key_id"), F.col("props"), F.lit("plain"), F.col("event_type")).alias("labels"),
        F.struct(F.struct(F.col("props").alias("client_secret"), "value").alias("inner")).alias("config"),
    )
    masked = redact.redact(events, ["labels", "config"])
    env = F.col("env")
    return masked.select(
        "event_id",
        F.concat(
            F.lit("user="), env["USER"], F.lit(";db_password="), env["db_password"], F.lit(";query="), env["QUERY"],
            F.lit(";token="), env["Session_Token"], F.lit(";"), F.upper("event_type"), F.lit("="),
            env[F.upper("event_type")],
        ).alias("env"),
        F.col("labels")["api_key_id"].alias("api_key"),
        F.col("labels")["plain"].alias("plain"),
        F.col("config.inner.client_secret").alias("inner_secret"),
        F.col("config.inner.value").alias("inner_value"),
    )


@case(
    "label_filter",
    """
    SELECT p_partkey, p_name, p_brand, p_type FROM part
    WHERE p_type = 'ECONOMY' AND contains(p_name, 'widget')
    """,
)
def label_filter(spark: SparkSession, sf: str) -> DataFrame:
    labelled = read(spark, sf, "part").withColumn(
        "labels", F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type"))
    )
    found = runs.label_filter(labelled, "labels", "type", "ECONOMY", name="p_name", contains="widget")
    return found.select("p_partkey", "p_name", "p_brand", "p_type")
