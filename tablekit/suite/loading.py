"""Sinks and loads, each read back from the table it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.operators import history, loads, runs, schema
from tablekit.session import scratch_path, scratch_table
from tablekit.sources import files, records
from tablekit.suite.registry import case, read, table_path
from tablekit.suite.scans import ORDERS, ORDERS_SQL, _orders

LINES_SQL = """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus, l_shipdate FROM lineitem
"""


def _export(spark: SparkSession, sf: str, fmt: str) -> DataFrame:
    lines = read(spark, sf, "lineitem")
    path = scratch_path(spark, "export")
    loads.export(lines, path, fmt)
    return files.scan(spark, path, fmt, lines.schema)


@case("export_parquet", LINES_SQL)
def export_parquet(spark: SparkSession, sf: str) -> DataFrame:
    return _export(spark, sf, "parquet")


@case("export_csv", LINES_SQL)
def export_csv(spark: SparkSession, sf: str) -> DataFrame:
    return _export(spark, sf, "csv")


@case("export_json", LINES_SQL)
def export_json(spark: SparkSession, sf: str) -> DataFrame:
    return _export(spark, sf, "json")


@case("ctas", "SELECT p_brand, p_type, count(*) AS parts, max(p_retailprice) AS top_price FROM part GROUP BY ALL")
def ctas(spark: SparkSession, sf: str) -> DataFrame:
    table = scratch_table(spark, "part")
    loads.create_table(files.scan(spark, table_path(sf, "part")), table, scratch_path(spark, table))
    return spark.table(table).groupBy("p_brand", "p_type").agg(
        F.count(F.lit(1)).alias("parts"), F.max("p_retailprice").alias("top_price")
    )


@case("import_append", ORDERS_SQL)
def import_append(spark: SparkSession, sf: str) -> DataFrame:
    """Finished orders first, then a file with the others whose columns come in another order."""
    orders = _orders(read(spark, sf, "orders"))
    table, path = scratch_table(spark, "orders"), scratch_path(spark, "orders")
    finished = F.col("o_orderstatus").eqNullSafe("F")
    loads.create_table(orders.where(finished), table, path)
    rest = orders.where(~finished).select(*reversed(orders.columns))
    loads.export(rest, f"{path}-rest.csv")
    loads.append(spark, files.scan(spark, f"{path}-rest.csv", schema=rest.schema), table)
    return spark.table(table)


@case(
    "insert_records",
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
           o_totalprice, o_orderdate, o_orderpriority
    FROM orders
    """,
)
def insert_records(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as JSON records, ragged where the status is P."""
    orders = _orders(read(spark, sf, "orders"))
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus")
    ragged = orders.select(*[status if c == "o_orderstatus" else F.col(c) for c in orders.columns])
    text = ragged.select(F.to_json(F.struct(*ragged.columns)).alias("record"))
    table = scratch_table(spark, "orders")
    loads.insert_records(spark, records.parse_records(text, "record", ORDERS), table, scratch_path(spark, table))
    return spark.table(table)


@case(
    "load_append",
    """
    SELECT event_type, 2 * count(*) AS events, round(2 * sum(value), 2) AS value, 2 AS successful_loads
    FROM events GROUP BY event_type
    """,
)
def load_append(spark: SparkSession, sf: str) -> DataFrame:
    table = scratch_table(spark, "events")
    path = scratch_path(spark, table)
    log = runs.RunLog(spark, f"{path}-runs")
    for _ in range(2):
        loads.load(spark, read(spark, sf, "events"), table, "append", path=path, log=log)
    done = log.read().where("status = 'SUCCESS'").agg(F.count(F.lit(1)).cast("int").alias("n"))
    return (
        spark.table(table)
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("value"))
        .withColumn("successful_loads", done.scalar())
    )


@case("load_replace", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000")
def load_replace(spark: SparkSession, sf: str) -> DataFrame:
    """The second load reads the table it replaces."""
    table = scratch_table(spark, "orders")
    path = scratch_path(spark, table)
    orders = read(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    loads.load(spark, orders, table, "replace", path=path)
    loads.load(spark, spark.table(table).where("o_totalprice > 100000"), table, "replace", path=path)
    return spark.table(table)


@case(
    "load_merge",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice * 2 END AS o_totalprice,
           CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 2 END AS seq
    FROM orders
    """,
)
def load_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Target: orders with status F or O. Batch: two versions of every O (changed) and P (new) order."""
    table = scratch_table(spark, "orders")
    path = scratch_path(spark, table)
    orders = _orders(read(spark, sf, "orders"))
    partial, finished = F.col("o_orderstatus").eqNullSafe("P"), F.col("o_orderstatus").eqNullSafe("F")
    loads.load(spark, orders.where(~partial).withColumn("seq", F.lit(0)), table, path=path)
    versions = (
        orders.where(~finished)
        .withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2))))
        .withColumn("o_totalprice", F.col("o_totalprice") * F.col("seq"))
    )
    loads.load(spark, versions, table, "merge", keys=["o_orderkey"], order_by=["seq"])
    return spark.table(table)


@case(
    "load_merge_partitioned",
    """
    SELECT event_id, event_type, user_id, props, CAST(ts AS DATE) AS day,
           CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' AND event_type = 'click'
                THEN value + 1000 ELSE value END AS value
    FROM events
    """,
)
def load_merge_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """The key holds the partition column, so only the three touched days are rewritten."""
    table = scratch_table(spark, "events")
    events = read(spark, sf, "events").withColumn("day", F.col("ts").cast("date")).drop("ts")
    loads.overwrite_partitions(spark, events, table, ["day"], scratch_path(spark, table))
    changed = events.where("day BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' AND event_type = 'click'")
    loads.load(
        spark, changed.withColumn("value", F.col("value") + 1000), table, "merge", keys=["event_id", "day"]
    )
    return spark.table(table)


@case("load_file", "SELECT s_nationkey, count(*) AS suppliers, round(sum(s_acctbal), 2) AS balance FROM supplier GROUP BY ALL")
def load_file(spark: SparkSession, sf: str) -> DataFrame:
    table = scratch_table(spark, "supplier")
    loads.load_file(
        spark, table_path(sf, "supplier"), table, disposition="replace", path=scratch_path(spark, table)
    )
    return spark.table(table).groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("suppliers"), F.round(F.sum("s_acctbal"), 2).alias("balance")
    )


@case(
    "load_source",
    """
    SELECT lang, count(*) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars, 'SUCCESS' AS status,
           (SELECT count(*) FROM documents) AS rows_written
    FROM documents GROUP BY lang
    """,
)
def load_source(spark: SparkSession, sf: str) -> DataFrame:
    table = scratch_table(spark, "documents")
    path = scratch_path(spark, table)
    log = runs.RunLog(spark, f"{path}-runs")
    loads.load_source(
        spark,
        lambda s: files.scan_glob(s, sf, "documents.parquet"),
        table, disposition="append", path=path, log=log,
    )
    last = log.read().where(F.col("kind") == "source")
    return (
        spark.table(table)
        .groupBy("lang")
        .agg(F.count(F.lit(1)).alias("docs"), F.sum("n_chars").alias("chars"))
        .withColumns(
            {"status": last.select("status").scalar(), "rows_written": last.select("rows_written").scalar()}
        )
    )


@case("load_late", "SELECT o_orderkey, o_totalprice, 2 AS seq FROM orders WHERE o_orderkey % 3 <> 0 "
      "UNION ALL SELECT o_orderkey, o_totalprice * 10, 3 FROM orders WHERE o_orderkey % 3 = 0")
def load_late(spark: SparkSession, sf: str) -> DataFrame:
    """Batches in any order: of every order versions 2, then 1 (late) and for some 3 (newer)."""
    table = scratch_table(spark, "orders")
    orders = read(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.lit(2).alias("seq"))
    loads.load(spark, orders, table, path=scratch_path(spark, table))
    late = orders.withColumn("o_totalprice", F.col("o_totalprice") * 5).withColumn("seq", F.lit(1))
    newer = orders.where("o_orderkey % 3 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 10)
    for batch in (late, newer.withColumn("seq", F.lit(3))):
        loads.load(spark, batch, table, "merge", keys=["o_orderkey"], order_by=["seq"])
    return spark.table(table)


@case(
    "partition_overwrite",
    """
    SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS events FROM events
    WHERE NOT (CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' AND event_type = 'error')
    GROUP BY ALL
    """,
)
def partition_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    table = scratch_table(spark, "events")
    events = read(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("date").alias("day"))
    path = scratch_path(spark, table)
    loads.load(spark, events, table, "partitions", partition_by=["day"], path=path)
    redone = events.where("day BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' AND event_type <> 'error'")
    loads.load(spark, redone, table, "partitions")
    return spark.table(table).groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("events"))


@case(
    "load_evolve",
    """
    SELECT CAST(c_custkey AS BIGINT) AS key, CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment,
           CAST(NULL AS DOUBLE) AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_suppkey + s_nationkey, NULL, s_acctbal FROM supplier
    """,
)
def load_evolve(spark: SparkSession, sf: str) -> DataFrame:
    """The batch lacks a column, brings a new one, and needs a wider type for a third."""
    table = scratch_table(spark, "parties")
    path = scratch_path(spark, table)
    customers = read(spark, sf, "customer").selectExpr(
        "c_custkey AS key", "c_nationkey AS nation", "c_mktsegment AS segment"
    )
    suppliers = read(spark, sf, "supplier").selectExpr(
        "s_suppkey AS key", "s_suppkey + s_nationkey AS nation", "s_acctbal AS balance"
    )
    loads.load(spark, customers, table, path=path)
    loads.load(spark, suppliers, table, evolve_schema=True, widen=True)
    return spark.table(table)


@case(
    "evolve_widths",
    """
    SELECT CAST(l_orderkey AS DOUBLE) AS amount, 'key' AS kind FROM lineitem
    UNION ALL SELECT CAST(CAST(l_discount AS REAL) AS DOUBLE), 'share' FROM lineitem
    """,
)
def evolve_widths(spark: SparkSession, sf: str) -> DataFrame:
    """Whole numbers and floats meet as doubles, which hold both."""
    lines = read(spark, sf, "lineitem")
    keys = lines.select(F.col("l_orderkey").alias("amount"), F.lit("key").alias("kind"))
    shares = lines.select(F.col("l_discount").cast("float").alias("amount"), F.lit("share").alias("kind"))
    return schema.evolve_union(keys, shares, widen=True)


@case(
    "evolve_union",
    """
    SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region FROM nation
    UNION ALL SELECT r_regionkey, r_name, NULL FROM region
    """,
)
def evolve_union(spark: SparkSession, sf: str) -> DataFrame:
    nations = read(spark, sf, "nation").toDF("key", "name", "region")
    return schema.evolve_union(nations, read(spark, sf, "region").toDF("key", "name"))


# Events read as changes of a user's row; an error deletes it. Of two at one time the greater counts.
_CHANGES = """
    WITH changes AS (
      SELECT user_id, ts, event_type = 'error' AS gone, event_id, event_type, value FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY gone DESC, event_id DESC) = 1),
    linked AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS until FROM changes)
"""


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select(
        "user_id", "ts", (F.col("event_type") == "error").alias("gone"), "event_id", "event_type", "value"
    )


def _history(spark: SparkSession, sf: str, buckets: int) -> DataFrame:
    """All changes in three batches, the middle of the month last; the first batch comes again at the end."""
    table = scratch_table(spark, "history")
    path = scratch_path(spark, table)
    changes = _changes(spark, sf)
    day = F.dayofmonth("ts")
    batches = [changes.where(day > 20), changes.where(day <= 10), changes.where(day.between(11, 20)), changes.where(day > 20)]
    for batch in batches:
        history.merge(spark, batch, table, ["user_id"], "ts", "gone", path, buckets)
    return spark.table(table)


@case(
    "load_history",
    _CHANGES + "SELECT user_id, ts AS valid_from, until AS valid_to, gone AS is_deleted, event_id, event_type, value FROM linked",
)
def load_history(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf, 16).select("user_id", "valid_from", "valid_to", "is_deleted", "event_id", "event_type", "value")


@case(
    "history_as_of",
    _CHANGES
    + """
    SELECT user_id, event_id, event_type, value FROM linked
    WHERE ts <= TIMESTAMP '2024-01-15 12:00:00' AND coalesce(until > TIMESTAMP '2024-01-15 12:00:00', true) AND NOT gone
    """,
)
def history_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Users as they were at noon of a day."""
    return history.as_of(_history(spark, sf, 0), "2024-01-15 12:00:00").select("user_id", "event_id", "event_type", "value")

