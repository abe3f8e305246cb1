"""Sources, the query surface, statistics, schema operations and user functions."""

from __future__ import annotations

import os
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.functions import udf
from tablekit.operators import loads, query, schema, stats
from tablekit.session import scratch_path, scratch_table
from tablekit.sources import files, records, rest
from tablekit.streaming import ingest
from tablekit.suite.registry import case, read, sql, table_path

ORDERS = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)
ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


def _orders(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@case("scan_csv", ORDERS_SQL)
def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "orders") + ".csv"
    loads.export(read(spark, sf, "orders"), path, "csv")
    return files.scan(spark, path, "csv", ORDERS)


@case("scan_csv_header", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def scan_csv_header(spark: SparkSession, sf: str) -> DataFrame:
    """The file has the columns in another order, and one more than the schema."""
    customers = read(spark, sf, "customer")
    path = scratch_path(spark, "customer") + ".csv"
    loads.export(customers.select(*reversed(customers.columns)), path)
    return files.scan(spark, path, schema="c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string")


@case(
    "scan_parquet",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem "
    "WHERE l_quantity > 25 AND l_shipdate >= TIMESTAMP '1998-01-01'",
)
def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    lines = files.scan(spark, table_path(sf, "lineitem"), "parquet")
    wanted = lines.where("l_quantity > 25 AND l_shipdate >= TIMESTAMP_NTZ '1998-01-01'")
    return wanted.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@case("scan_json", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def scan_json(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "events")
    events = read(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    # JSON timestamps default to milliseconds; the events have microseconds.
    fine = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    events.write.option("timestampNTZFormat", fine).json(path)
    return files.scan(spark, path, "json", events.schema, timestampNTZFormat=fine)


@case(
    "scan_auto",
    """
    SELECT format, c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
    FROM customer, (VALUES ('csv'), ('json'), ('parquet')) AS f(format) GROUP BY ALL
    """,
)
def scan_auto(spark: SparkSession, sf: str) -> DataFrame:
    customers = read(spark, sf, "customer")
    base = scratch_path(spark, "customer")
    found = None
    for suffix in ("csv", "json", "parquet"):
        path = f"{base}.{suffix}"
        loads.export(customers, path)
        one = files.scan(spark, path, schema=customers.schema).withColumn("format", F.lit(suffix))
        found = one if found is None else found.unionByName(one)
    return found.groupBy("format", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@case("scan_glob", "SELECT o_orderstatus, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'")
def scan_glob(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "orders")
    orders = read(spark, sf, "orders")
    finished, opened = F.col("o_orderstatus").eqNullSafe("F"), F.col("o_orderstatus").eqNullSafe("O")
    orders.where(opened).write.parquet(f"{base}/open")
    orders.where(~finished & ~opened).write.parquet(f"{base}/partial")
    orders.where(finished).write.json(f"{base}/finished")
    found = files.scan_glob(spark, base, "*.parquet", schema=orders.schema, recursive=True, source_column="file")
    folder = F.regexp_extract("file", "/(open|partial)/", 1)
    return found.where(opened == (folder == "open")).select(
        "o_orderstatus", "o_orderkey", "o_totalprice"
    )


@case("list_files")
def list_files(spark: SparkSession, sf: str) -> DataFrame:
    return files.list_files(spark, sf, "*.parquet")


@case(
    "register_records",
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           CAST(NULL AS VARCHAR) AS note, user_id
    FROM events
    """,
)
def register_records(spark: SparkSession, sf: str) -> DataFrame:
    view = scratch_table(spark, "records")
    text = read(spark, sf, "events").select(
        F.to_json(F.struct("event_id", "user_id", F.from_json("props", "k bigint")["k"].alias("k"))).alias("record")
    )
    records.register_records(spark, view, text, "record", "event_id bigint, k bigint, note string, user_id bigint")
    return spark.table(view)


def _serve(orders: DataFrame, path: str, first: int = 0) -> int:
    """Write orders as pages ``<path>/<n>.json``, page n with the keys from n thousand on; returns the number of pages.

    Pages before ``first`` are there already. The pages are read as ``file:`` URLs, so the scratch folder must be mounted as a file system.
    """
    folder = path.removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    last = orders.agg(F.max(F.floor(F.col("o_orderkey") / 1000))).first()[0]
    pages = 0 if last is None else last + 1
    filled = orders.where(F.col("o_orderkey") >= first * 1000).groupBy(F.floor(F.col("o_orderkey") / 1000).alias("id")).agg(
        F.collect_list(F.struct(*orders.columns)).alias("items")
    )
    every = orders.sparkSession.range(first, max(first, pages)).join(filled, "id", "left")
    following = F.when(F.col("id") + 1 < pages, (F.col("id") + 1).cast("string"))
    body = F.to_json(F.struct(F.coalesce("items", F.array()).alias("items"), following.alias("next")))

    def write(rows) -> None:
        for row in rows:
            os.makedirs(folder, exist_ok=True)
            with open(f"{folder}/{row.id}.json", "w", encoding="utf-8") as file:
                file.write(row.body)

    every.select("id", body.alias("body")).foreachPartition(write)
    return pages


@case("scan_rest", ORDERS_SQL)
def scan_rest(spark: SparkSession, sf: str) -> DataFrame:
    """Orders served as numbered pages, read back in ranges of ten pages a task."""
    path = scratch_path(spark, "pages")
    pages = _serve(read(spark, sf, "orders"), path)
    endpoint = {"name": "orders", "path": f"{path.removeprefix('file:')}/{{page}}.json", "pages": pages, "pages_per_task": 10}
    return _orders(rest.scan_rest(spark, "file://", [{**endpoint, "records": "items"}], schema=ORDERS))


@case("rest_incremental", ORDERS_SQL)
def rest_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Orders served as numbered pages and, once more, as pages linked by cursors; some are added after each run.

    The last page of a run grows before the next one, and a run may find nothing new. Both ways must load every order
    once: one that they load differently often is left out, one that both load twice comes out twice.
    """
    path, checkpoint = scratch_path(spark, "pages"), scratch_path(spark, "checkpoint")
    folder = path.removeprefix("file:")
    orders = read(spark, sf, "orders")
    most = orders.agg(F.max("o_orderkey")).first()[0] or 0
    endpoints = [
        {"name": "numbered", "path": f"{folder}/{{page}}.json", "records": "items", "pages_per_task": 10, "sparse": True},
        {"name": "linked", "path": f"{folder}/{{cursor}}.json", "records": "items", "next": "next", "cursor": "0"},
    ]
    loaded = scratch_path(spark, "loaded")
    pages = 0
    for share in (0.3, 0.3, 0.77, 1.0):
        # Of the pages that are there only the last one grows, and gets a link to the next.
        pages = _serve(orders.where(F.col("o_orderkey") <= F.lit(int(most * share))), path, max(pages - 1, 0))
        stream = rest.stream_rest(spark, "file://", endpoints, checkpoint=checkpoint)
        ingest.ingest(stream, loaded, checkpoint)
    stored = spark.read.schema("endpoint string, page int, record string").parquet(loaded)
    parsed = records.parse_records(stored, "record", ORDERS, keep=["endpoint"])
    loads_of = parsed.groupBy(*_orders(orders).columns).agg(
        F.count_if(F.col("endpoint") == "numbered").alias("a"), F.count_if(F.col("endpoint") == "linked").alias("b")
    )
    return _orders(loads_of.where("a = b").withColumn("n", F.explode(F.sequence(F.lit(1), F.col("a")))))


@case(
    "sql_text",
    """
    SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_discount <= 0.05 GROUP BY l_returnflag
    """,
)
def sql_text(spark: SparkSession, sf: str) -> DataFrame:
    view = scratch_table(spark, "lineitem")
    read(spark, sf, "lineitem").createOrReplaceTempView(view)
    return query.sql_text(
        spark,
        f"""
        SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM {view}
        WHERE l_shipdate >= CAST(:since AS TIMESTAMP_NTZ) AND l_discount <= :most GROUP BY l_returnflag
        """,
        {"since": "1997-01-01", "most": 0.05},
    )


@case(
    "sql_limit",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def sql_limit(spark: SparkSession, sf: str) -> DataFrame:
    view = scratch_table(spark, "orders")
    read(spark, sf, "orders").createOrReplaceTempView(view)
    text = f"SELECT o_orderkey, o_totalprice FROM {view} ORDER BY o_totalprice DESC, o_orderkey"
    return query.sql_text(spark, text, limit=100)


@case("filter_expr", "SELECT * FROM customer WHERE c_acctbal > 2500 AND c_mktsegment <> 'BUILDING'")
def filter_expr(spark: SparkSession, sf: str) -> DataFrame:
    return query.relational(read(spark, sf, "customer"), "c_acctbal > 2500 AND c_mktsegment <> 'BUILDING'")


@case("project", "SELECT p_partkey, upper(p_name) AS name, p_size * 2 AS double_size FROM part")
def project(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["p_partkey", "upper(p_name) AS name", "p_size * 2 AS double_size"]
    return query.relational(read(spark, sf, "part"), columns=columns)


@case(
    "relational_agg",
    """
    SELECT c_mktsegment, c_nationkey, round(sum(c_acctbal), 2) AS balance, count(*) AS customers
    FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment, c_nationkey
    """,
)
def relational_agg(spark: SparkSession, sf: str) -> DataFrame:
    return query.relational(
        read(spark, sf, "customer"),
        where="c_acctbal > 0",
        aggregate="c_mktsegment, c_nationkey, round(sum(c_acctbal), 2) AS balance, count(*) AS customers",
    )


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


_ORDER_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}


@case(
    "result_profile",
    _union(
        [
            f"SELECT {i + 1} AS position, '{c}' AS column_name, '{t}' AS data_type, count(*) AS row_count, "
            f"CAST(sum(strlen(CAST({c} AS VARCHAR))) AS BIGINT) AS text_bytes FROM orders"
            for i, (c, t) in enumerate(_ORDER_TYPES.items())
        ]
    ),
)
def result_profile(spark: SparkSession, sf: str) -> DataFrame:
    return query.result_profile(_orders(read(spark, sf, "orders")), text_bytes=True)


_CUSTOMER_TYPES = {
    "c_custkey": "bigint",
    "c_name": "string",
    "c_nationkey": "int",
    "c_acctbal": "double",
    "c_mktsegment": "string",
}


@case(
    "table_stats",
    _union(
        [
            f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS row_count, 5 AS column_count, "
            f"count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count, "
            f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM customer"
            for c, t in _CUSTOMER_TYPES.items()
        ]
    ),
)
def table_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats.table_stats(read(spark, sf, "customer"), exact=True)


_LINE_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


@case(
    "column_profile",
    _union(
        [
            f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS row_count, "
            f"count(*) - count({c}) AS null_count, (count(*) - count({c})) / count(*) AS null_fraction, "
            f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, "
            + (
                f"round(avg(CAST({c} AS DOUBLE)), 6)"
                if t in ("bigint", "int", "double")
                else "CAST(NULL AS DOUBLE)"
            )
            + " AS mean FROM lineitem"
            for c, t in _LINE_TYPES.items()
        ]
    ),
)
def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    # The sketched columns (distinct counts, quantiles) are compared in column_profile_approx.
    profile = stats.column_profile(read(spark, sf, "lineitem"), list(_LINE_TYPES))
    exact = ["column_name", "data_type", "row_count", "null_count", "null_fraction", "min_value", "max_value"]
    return profile.select(*exact, F.round("mean", 6).alias("mean"))


@case(
    "column_profile_approx",
    _union(
        [
            f"SELECT '{c}' AS column_name, true AS distinct_close, true AS quantiles_close"
            for c in _LINE_TYPES
        ]
    ),
)
def column_profile_approx(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each sketch is within its error: distinct counts by a sixth (three standard errors), quantiles by 1 %
    of the ranks; columns that are no numbers have no quantiles."""
    lines = read(spark, sf, "lineitem")
    profile = stats.column_profile(lines)
    numbers = [c for c, t in _LINE_TYPES.items() if t in ("bigint", "int", "double")]
    found = {r.column_name: r.quantiles for r in profile.where("quantiles IS NOT NULL").collect()}
    near = []
    for c in numbers:
        tests = [F.lit(True)]
        for share, q in zip((0.25, 0.5, 0.75), found[c]):
            known = F.count(c)
            tests.append(F.count_if(F.col(c) < q) <= (share + 0.01) * known)
            tests.append(F.count_if(F.col(c) <= q) >= (share - 0.01) * known)
        near.append(F.struct(F.lit(c).alias("column_name"), reduce(lambda a, b: a & b, tests).alias("ok")).alias(c))
    ranks = lines.agg(*near).select(F.inline(F.array(*numbers)))
    exact = stats.exact_distinct(lines)
    both = profile.join(exact, "column_name").join(ranks, "column_name", "left")
    close = F.abs(F.col("approx_distinct") - F.col("distinct_count")) <= F.col("distinct_count") / 6 + 1
    return both.select("column_name", close.alias("distinct_close"), F.coalesce("ok", F.lit(True)).alias("quantiles_close"))


@case(
    "suggest_schema",
    """
    SELECT key AS column_name,
           CASE json_type(props, '$."' || key || '"') WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'BIGINT' THEN 'BIGINT'
                WHEN 'VARCHAR' THEN 'STRING' ELSE json_type(props, '$."' || key || '"') END AS data_type,
           count(*) AS sample_count
    FROM (SELECT props, unnest(json_keys(props)) AS key FROM events) GROUP BY ALL
    """,
)
def suggest_schema(spark: SparkSession, sf: str) -> DataFrame:
    return schema.suggest_schema(read(spark, sf, "events"), "props")


@case(
    "schema_override",
    """
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
           CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE) AS price, CAST(o_orderdate AS DATE) AS o_orderdate,
           TRY_CAST(o_orderpriority AS BIGINT) AS o_orderpriority, CAST(NULL AS VARCHAR) AS note
    FROM orders
    """,
)
def schema_override(spark: SparkSession, sf: str) -> DataFrame:
    changed = schema.override_schema(
        read(spark, sf, "orders").withColumn("price", F.col("o_totalprice")),
        {
            "o_custkey": "string",
            "price": "decimal(12,2)",
            "o_orderdate": "date",
            "o_orderpriority": "bigint",
            "o_totalprice": None,
            "note": "string",
        },
    )
    return changed.withColumn("price", F.col("price").cast("double"))


@case(
    "schema_lossy",
    """
    SELECT 'o_orderpriority' AS column_name, 'bigint' AS data_type,
           count(*) FILTER (WHERE o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS BIGINT) IS NULL) AS lost
    FROM orders
    UNION ALL SELECT 'o_custkey', 'tinyint', count(*) FILTER (WHERE TRY_CAST(o_custkey AS TINYINT) IS NULL) FROM orders
    """,
)
def schema_lossy(spark: SparkSession, sf: str) -> DataFrame:
    return schema.lossy_casts(read(spark, sf, "orders"), {"o_orderpriority": "bigint", "o_custkey": "tinyint"})


@case(
    "schema_compare",
    """
    WITH n AS (SELECT count(*) AS c, count(*) FILTER (WHERE event_type = 'error') AS e FROM events)
    SELECT column_name, left_type, right_type, status,
           CASE WHEN left_type IS NULL THEN 0 ELSE c END AS left_sample_count,
           CASE WHEN right_type IS NULL THEN 0 WHEN column_name = 'error' THEN e ELSE c END AS right_sample_count,
           right_sample_count - left_sample_count AS presence_delta
    FROM n, (VALUES ('event_id', 'BIGINT', 'BIGINT', 'same'), ('user_id', 'BIGINT', 'STRING', 'type_changed'),
             ('event_type', 'STRING', NULL, 'removed'), ('error', NULL, 'BOOLEAN', 'added'))
         AS v(column_name, left_type, right_type, status)
    """,
)
def schema_compare(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events")
    before = events.select(F.to_json(F.struct("event_id", "user_id", "event_type")).alias("record"))
    failed = F.when(F.col("event_type") == "error", F.lit(True)).alias("error")
    after = events.select(
        F.to_json(F.struct("event_id", F.concat(F.lit("u"), F.col("user_id")).alias("user_id"), failed)).alias("record")
    )
    return schema.schema_drift(before, after, "record")


@case(
    "layout_rewrite",
    """
    SELECT o_orderpriority, count(*) AS lines, round(sum(l_extendedprice), 2) AS price
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderpriority
    """,
)
def layout_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """Both tables bucketed alike: the join below needs no shuffle of either."""
    orders, lines = scratch_table(spark, "orders"), scratch_table(spark, "lines")
    left = read(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    right = read(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice")
    buckets = schema.bucket_count(left, right)
    schema.write_layout(
        left, orders, scratch_path(spark, "orders"), bucket_by=(buckets, ["o_orderkey"]), sort_by=["o_orderkey"]
    )
    schema.write_layout(
        right, lines, scratch_path(spark, "lines"), bucket_by=(buckets, ["l_orderkey"]), sort_by=["l_orderkey"]
    )
    joined = spark.table(orders).join(spark.table(lines), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("price")
    )


@case(
    "layout_partitioned",
    "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')",
)
def layout_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Partition folders by priority; the filter below reads two of them."""
    table = scratch_table(spark, "orders")
    orders = read(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    schema.write_layout(
        orders, table, scratch_path(spark, "orders"), partition_by=["o_orderpriority"], sort_by=["o_orderkey"]
    )
    return spark.table(table).where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))


@case(
    "layout_curve",
    """
    WITH b AS (
        SELECT min(l_partkey) + (max(l_partkey) - min(l_partkey)) * 0.3::DOUBLE AS p0,
               min(l_partkey) + (max(l_partkey) - min(l_partkey)) * 0.4::DOUBLE AS p1,
               min(l_extendedprice) + (max(l_extendedprice) - min(l_extendedprice)) * 0.3::DOUBLE AS e0,
               min(l_extendedprice) + (max(l_extendedprice) - min(l_extendedprice)) * 0.4::DOUBLE AS e1
        FROM lineitem
    )
    SELECT l_returnflag, count(*) AS lines, sum(l_partkey)::BIGINT AS parts, true AS few_files
    FROM lineitem, b WHERE l_partkey BETWEEN p0 AND p1 AND l_extendedprice BETWEEN e0 AND e1
    GROUP BY l_returnflag
    """,
)
def layout_curve(spark: SparkSession, sf: str) -> DataFrame:
    """Lines along a curve over part and price. A box in both is read, and ``few_files`` says that the ranges of less
    than a quarter of the files meet it."""
    table = scratch_table(spark, "lines")
    lines = read(spark, sf, "lineitem").select("l_partkey", "l_extendedprice", "l_returnflag")
    schema.write_curve(
        lines, table, ["l_partkey", "l_extendedprice"], scratch_path(spark, "lines"), schema.size_of(lines) // 64
    )
    written = spark.table(table)
    share = "min({0}) + (max({0}) - min({0})) * 0.{1}D AS {2}"
    p0, p1, e0, e1 = lines.selectExpr(
        share.format("l_partkey", 3, "p0"), share.format("l_partkey", 4, "p1"),
        share.format("l_extendedprice", 3, "e0"), share.format("l_extendedprice", 4, "e1"),
    ).first()
    spans = written.groupBy(F.input_file_name().alias("file")).agg(
        F.min("l_partkey").alias("p_low"), F.max("l_partkey").alias("p_high"),
        F.min("l_extendedprice").alias("e_low"), F.max("l_extendedprice").alias("e_high"),
    )
    meets = (F.col("p_low") <= p1) & (F.col("p_high") >= p0)
    meets &= (F.col("e_low") <= e1) & (F.col("e_high") >= e0)
    few = spans.agg((4 * F.count_if(meets) < F.count(F.lit(1))).alias("few_files"))
    inside = written.where(
        F.col("l_partkey").between(p0, p1) & F.col("l_extendedprice").between(e0, e1)
    )
    found = inside.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_partkey").alias("parts"))
    return found.withColumn("few_files", F.lit(few.first().few_files))


@case(
    "udf_scalar",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * (1 - l_discount) AS net FROM lineitem",
)
def udf_scalar(spark: SparkSession, sf: str) -> DataFrame:
    def net(price: pd.Series, discount: pd.Series) -> pd.Series:
        return price * (1 - discount)

    udf.register_scalar(spark, "net_price", net, "double")
    lines = read(spark, sf, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.expr("net_price(l_extendedprice, l_discount) AS net")
    )


@case(
    "udf_sql",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS tier
    FROM customer
    """,
)
def udf_sql(spark: SparkSession, sf: str) -> DataFrame:
    body = "CASE WHEN balance < 0 THEN 'debt' WHEN balance < 5000 THEN 'low' ELSE 'high' END"
    udf.register_sql(spark, "balance_tier", "balance DOUBLE", "STRING", body)
    return sql(spark, sf, "SELECT c_custkey, balance_tier(c_acctbal) AS tier FROM {customer}")
