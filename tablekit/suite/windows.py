"""Window families. Row-level windows run split by buckets so that a hot key spreads out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablekit.plans import joins, order, windows
from tablekit.suite.registry import case, read


@case(
    "win_rank",
    """
    SELECT o_custkey, o_orderkey, o_totalprice,
           row_number() OVER w AS row_number, ntile(4) OVER w AS tile, rank() OVER p AS rank, dense_rank() OVER p AS dense_rank,
           round(percent_rank() OVER p, 6) AS percent_rank, round(cume_dist() OVER p, 6) AS cume_dist
    FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey),
           p AS (PARTITION BY o_custkey ORDER BY o_totalprice)
    """,
)
def win_rank(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    ranked = order.rankings(orders, ["o_custkey"], "o_totalprice", ["o_orderkey"])
    return ranked.select(
        "o_custkey", "o_orderkey", "o_totalprice", "row_number",
        windows.tiles(F.col("row_number"), F.col("size"), 4).cast("bigint").alias("tile"),
        "rank", "dense_rank", F.round("percent_rank", 6).alias("percent_rank"),
        F.round("cume_dist", 6).alias("cume_dist"),
    )


@case(
    "win_analytic",
    """
    SELECT event_id, user_id, ts, value, lag(value) OVER w AS lag, lead(value) OVER w AS lead,
           first_value(value) OVER w AS first_value,
           last_value(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_value
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """,
)
def win_analytic(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return windows.neighbours(events, ["user_id"], ["ts", "event_id"], [F.date_trunc("day", "ts")], "value")


@case(
    "win_nth_value",
    """
    SELECT DISTINCT user_id, nth_value(value, 3) OVER (PARTITION BY user_id ORDER BY ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS third_value
    FROM events
    """,
)
def win_nth_value(spark: SparkSession, sf: str) -> DataFrame:
    """The third event of each user, NULL if there are fewer: only three rows per user are shuffled per task."""
    ordered = Window.partitionBy("user_id").orderBy("ts", "event_id")
    first = read(spark, sf, "events").withColumn("rn", F.row_number().over(ordered)).where("rn <= 3")
    return first.groupBy("user_id").agg(F.max(F.when(F.col("rn") == 3, F.col("value"))).alias("third_value"))


@case(
    "win_running",
    """
    SELECT event_id, user_id, ts, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
           ROWS UNBOUNDED PRECEDING), 2) AS running
    FROM events
    """,
)
def win_running(spark: SparkSession, sf: str) -> DataFrame:
    """Running sum over the rows of a user."""
    events = read(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    along = [F.col("ts"), F.col("event_id")]
    summed = windows.running_sum(
        events, ["user_id"], along, [F.date_trunc("day", "ts")], F.col("value"), "running"
    )
    return summed.select("event_id", "user_id", "ts", F.round("running", 2).alias("running"))


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    """One row per user and day: what follows windows over days, whose number data volume does not change."""
    return (
        read(spark, sf, "events")
        .groupBy("user_id", F.col("ts").cast("date").alias("day"))
        .agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("events"))
    )


_DAILY = "(SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS total, count(*) AS events FROM events GROUP BY ALL)"


@case(
    "win_rows",
    f"""
    SELECT user_id, day, round(sum(total) OVER (w ROWS UNBOUNDED PRECEDING), 2) AS running,
           round(avg(total) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS last_three,
           CAST(max(events) OVER (w ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS BIGINT) AS around
    FROM {_DAILY} WINDOW w AS (PARTITION BY user_id ORDER BY day)
    """,
)
def win_rows(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("day")
    return _daily(spark, sf).select(
        "user_id",
        "day",
        F.round(F.sum("total").over(w.rowsBetween(Window.unboundedPreceding, 0)), 2).alias("running"),
        F.round(F.avg("total").over(w.rowsBetween(-2, 0)), 6).alias("last_three"),
        F.max("events").over(w.rowsBetween(-1, 1)).alias("around"),
    )


@case(
    "win_range",
    f"""
    SELECT user_id, day, round(sum(total) OVER (w RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), 2) AS week,
           CAST(sum(events) OVER (PARTITION BY user_id ORDER BY day - DATE '2024-01-01'
                                  RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS BIGINT) AS around
    FROM {_DAILY} WINDOW w AS (PARTITION BY user_id ORDER BY day)
    """,
)
def win_range(spark: SparkSession, sf: str) -> DataFrame:
    """Seven-day sums, once over an interval and once over a day number."""
    week = "PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL '6' DAY PRECEDING AND CURRENT ROW"
    number = Window.partitionBy("user_id").orderBy(F.date_diff("day", F.lit("2024-01-01"))).rangeBetween(-3, 3)
    return _daily(spark, sf).select(
        "user_id",
        "day",
        F.expr(f"round(sum(total) OVER ({week}), 2)").alias("week"),
        F.sum("events").over(number).alias("around"),
    )


@case(
    "win_qualify",
    """
    SELECT p_brand, p_partkey, p_retailprice, row_number() OVER w AS place FROM part
    WINDOW w AS (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) QUALIFY row_number() OVER w <= 3
    """,
)
def win_qualify(spark: SparkSession, sf: str) -> DataFrame:
    """Spark SQL has no QUALIFY: filter over a subquery, which Spark turns into a per-group limit."""
    best = Window.partitionBy("p_brand").orderBy(F.col("p_retailprice").desc(), "p_partkey")
    parts = read(spark, sf, "part").select("p_brand", "p_partkey", "p_retailprice")
    ranked = parts.withColumn("place", F.row_number().over(best)).where("place <= 3")
    return ranked.withColumn("place", F.col("place").cast("bigint"))


@case(
    "sort_nulls",
    """
    SELECT p_partkey, size, row_number() OVER (ORDER BY size DESC NULLS LAST, p_partkey) AS position
    FROM (SELECT p_partkey, CASE WHEN p_brand <> 'Brand#5' THEN p_size END AS size FROM part)
    """,
)
def sort_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Position in a total order with NULLs last; what one task gathers is a count for each task."""
    parts = read(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_brand") != "Brand#5", F.col("p_size")).alias("size")
    )
    return order.positions(parts, [], [F.col("size").desc_nulls_last(), F.col("p_partkey")], name="position")


@case(
    "distinct_on",
    """
    SELECT md5(text) AS text_hash, doc_id, lang, source FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1
    """,
)
def distinct_on(spark: SparkSession, sf: str) -> DataFrame:
    """First document per text. Groups and travels by a 256-bit digest, not by the text itself."""
    docs = read(spark, sf, "documents").select(
        F.md5("text").alias("text_hash"), F.sha2("text", 256).alias("digest"), "doc_id", "lang", "source"
    )
    first = Window.partitionBy("digest").orderBy("doc_id")
    return docs.withColumn("rn", F.row_number().over(first)).where("rn = 1").drop("rn", "digest")


@case(
    "join_asof",
    """
    SELECT l.event_id, l.user_id, l.ts, r.event_id AS view_id, r.value AS view_value
    FROM (SELECT * FROM events WHERE event_type = 'purchase') l
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') r ON l.user_id = r.user_id AND l.ts >= r.ts
    """,
)
def join_asof(spark: SparkSession, sf: str) -> DataFrame:
    """For each purchase the user's latest view."""
    events = read(spark, sf, "events")
    views = events.where("event_type = 'view'").select(
        "user_id", "ts", F.col("event_id").alias("view_id"), F.col("value").alias("view_value")
    )
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return joins.asof_join(
        purchases, views, ["user_id"], "ts", ["view_id", "view_value"], F.date_trunc("day", "ts"), tie="view_id"
    )


@case(
    "agg_quantile",
    """
    SELECT event_type, round(quantile_cont(value, 0.1), 6) AS p10, round(median(value), 6) AS p50,
           round(quantile_cont(value, 0.95), 6) AS p95, count(value) AS n
    FROM events GROUP BY event_type
    """,
)
def agg_quantile(spark: SparkSession, sf: str) -> DataFrame:
    """Exact quantiles of few large groups, without holding a group's values in one buffer."""
    events = read(spark, sf, "events").select("event_type", "value")
    found = order.quantiles(events, ["event_type"], "value", {"p10": 0.1, "p50": 0.5, "p95": 0.95})
    counts = events.groupBy("event_type").agg(F.count("value").alias("n"))
    rounded = found.select("event_type", *[F.round(c, 6).alias(c) for c in ("p10", "p50", "p95")])
    return rounded.join(counts, "event_type")


@case(
    "agg_mode",
    """
    SELECT o_custkey, m AS mode FROM (
      SELECT o_custkey, month(o_orderdate) AS m, count(*) AS n FROM orders GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, m) = 1
    """,
)
def agg_mode(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer's most frequent order month."""
    orders = read(spark, sf, "orders").select("o_custkey", F.month("o_orderdate").cast("bigint").alias("m"))
    return windows.exact_mode(orders, ["o_custkey"], "m")
