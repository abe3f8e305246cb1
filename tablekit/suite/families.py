"""SQL families every engine answers, in Spark's own DataFrame and SQL forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.plans import joins
from tablekit.plans.windows import null_safe_join
from tablekit.suite.registry import case, read, sql

# ---------------------------------------------------------------- joins


@case(
    "join_inner",
    """
    SELECT n_name, o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS price
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
    """,
)
def join_inner(spark: SparkSession, sf: str) -> DataFrame:
    """Spark broadcasts a side only below its size threshold and shuffles otherwise."""
    return (
        read(spark, sf, "orders")
        .join(read(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("price"))
    )


@case(
    "join_outer",
    """
    SELECT 'left' AS kind, n_name, s_suppkey FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey AND s_acctbal > 5000
    UNION ALL SELECT 'right', n_name, s_suppkey FROM nation RIGHT JOIN supplier ON n_nationkey = s_nationkey AND n_regionkey > 1
    UNION ALL SELECT 'full', n_name, s_suppkey FROM nation FULL JOIN supplier
              ON n_nationkey = s_nationkey AND s_acctbal > 5000 AND n_regionkey > 1
    """,
)
def join_outer(spark: SparkSession, sf: str) -> DataFrame:
    nation, supplier = read(spark, sf, "nation"), read(spark, sf, "supplier")
    same = F.col("n_nationkey") == F.col("s_nationkey")
    rich, eastern = F.col("s_acctbal") > 5000, F.col("n_regionkey") > 1
    parts = [("left", same & rich), ("right", same & eastern), ("full", same & rich & eastern)]
    out = None
    for how, condition in parts:
        one = nation.join(supplier, condition, how).select(F.lit(how).alias("kind"), "n_name", "s_suppkey")
        out = one if out is None else out.unionByName(one)
    return out


@case(
    "join_semi",
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
    """,
)
def join_semi(spark: SparkSession, sf: str) -> DataFrame:
    returned = read(spark, sf, "lineitem").where("l_returnflag = 'R'")
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return orders.join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")


@case(
    "join_anti",
    """
    SELECT c_custkey, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
    """,
)
def join_anti(spark: SparkSession, sf: str) -> DataFrame:
    urgent = read(spark, sf, "orders").where("o_orderpriority = '1-URGENT'")
    customers = read(spark, sf, "customer").select("c_custkey", "c_name")
    return customers.join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@case(
    "join_not_in",
    """
    SELECT 'no nulls' AS kind, doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT 'nulls', doc_id, lang FROM documents
    WHERE doc_id NOT IN (SELECT CASE WHEN toxic = 0 THEN doc_id END FROM labels)
    UNION ALL SELECT 'empty', doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 7)
    """,
)
def join_not_in(spark: SparkSession, sf: str) -> DataFrame:
    documents, labels = read(spark, sf, "documents").select("doc_id", "lang"), read(spark, sf, "labels")
    keys = {
        "no nulls": labels.select(F.col("doc_id").alias("k")),
        "nulls": labels.select(F.when(F.col("toxic") == 0, F.col("doc_id")).alias("k")),
        "empty": labels.where("quality = 7").select(F.col("doc_id").alias("k")),
    }
    out = None
    for kind, right in keys.items():
        one = joins.not_in(documents, right, "doc_id", "k").select(F.lit(kind).alias("kind"), "doc_id", "lang")
        out = one if out is None else out.unionByName(one)
    return out


_BANDS = """
    SELECT p_brand AS brand, p_size AS size, min(p_retailprice) - 900 AS low,
      min(p_retailprice) - 900 + 0.01 * power(2, p_size % 18) AS high FROM {part} GROUP BY p_brand, p_size
"""


@case(
    "join_range",
    f"""
    WITH bands AS ({_BANDS.format(part="part")})
    SELECT brand, size, count(*) AS events, round(sum(value), 2) AS value
    FROM events JOIN bands ON value BETWEEN low AND high GROUP BY ALL
    """,
)
def join_range(spark: SparkSession, sf: str) -> DataFrame:
    """Events per price band; bands are 0.01 to 1310 long. Equal values are merged first, so a frequent one joins once."""
    values = read(spark, sf, "events").groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
    bands = sql(spark, sf, _BANDS)
    joined = joins.range_join(values, bands, "value", "low", "high")
    return joined.groupBy("brand", "size").agg(F.sum("n").alias("events"), F.round(F.sum("v"), 2).alias("value"))


@case(
    "join_cross",
    """
    SELECT r_name, n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
    FROM region CROSS JOIN nation JOIN customer ON n_nationkey = c_nationkey GROUP BY ALL
    """,
)
def join_cross(spark: SparkSession, sf: str) -> DataFrame:
    """Every region beside every nation's totals: the product is taken after aggregating, of two tiny tables."""
    per_nation = (
        read(spark, sf, "customer")
        .groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
        .join(read(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("n_name", "customers", "balance")
    )
    return read(spark, sf, "region").select("r_name").crossJoin(per_nation)


@case(
    "subquery_correlated",
    """
    SELECT p_partkey, p_brand, p_retailprice,
           (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey) AS lines
    FROM part p WHERE p_retailprice > (SELECT avg(q.p_retailprice) FROM part q WHERE q.p_brand = p.p_brand)
    """,
)
def subquery_correlated(spark: SparkSession, sf: str) -> DataFrame:
    """Spark turns both correlated subqueries into joins on aggregates."""
    return sql(
        spark,
        sf,
        """
        SELECT p_partkey, p_brand, p_retailprice,
               (SELECT count(*) FROM {lineitem} WHERE l_partkey = p_partkey) AS lines
        FROM {part} p WHERE p_retailprice > (SELECT avg(q.p_retailprice) FROM {part} q WHERE q.p_brand = p.p_brand)
        """,
    )


@case(
    "subquery_lateral",
    """
    SELECT n_name, s.suppliers, s.best FROM nation, LATERAL (
      SELECT count(*) AS suppliers, max(s_acctbal) AS best FROM supplier WHERE s_nationkey = n_nationkey) s
    """,
)
def subquery_lateral(spark: SparkSession, sf: str) -> DataFrame:
    return sql(
        spark,
        sf,
        """
        SELECT n_name, s.suppliers, s.best FROM {nation}, LATERAL (
          SELECT count(*) AS suppliers, max(s_acctbal) AS best FROM {supplier} WHERE s_nationkey = n_nationkey) s
        """,
    )


# ---------------------------------------------------------------- aggregates


@case(
    "agg_group",
    """
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base,
           round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_disc, round(avg(l_quantity), 6) AS avg_qty,
           count(*) FILTER (WHERE l_tax > 0.05) AS taxed, count(*) AS lines
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-09-02' GROUP BY l_returnflag, l_linestatus HAVING count(*) > 10
    """,
)
def agg_group(spark: SparkSession, sf: str) -> DataFrame:
    """Pricing summary."""
    return (
        read(spark, sf, "lineitem")
        .where("l_shipdate <= TIMESTAMP_NTZ '2001-09-02'")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
            F.round(F.sum("l_extendedprice"), 2).alias("sum_base"),
            F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("sum_disc"),
            F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
            F.count_if(F.col("l_tax") > 0.05).alias("taxed"),
            F.count(F.lit(1)).alias("lines"),
        )
        .where("lines > 10")
    )


@case(
    "agg_distinct",
    """
    SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT CAST(ts AS DATE)) AS days,
           count(DISTINCT props) AS props, count(*) AS events
    FROM events GROUP BY event_type
    """,
)
def agg_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users"),
        F.count_distinct(F.col("ts").cast("date")).alias("days"),
        F.count_distinct("props").alias("props"),
        F.count(F.lit(1)).alias("events"),
    )


_CUSTOMER_AGG = "count(*) AS customers, round(sum(c_acctbal), 2) AS balance"
_GROUPED = "SELECT c_nationkey, c_mktsegment, " + _CUSTOMER_AGG + " FROM {customer} GROUP BY "


def _customer_aggs() -> list:
    return [F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")]


@case("agg_rollup", (_GROUPED + "ROLLUP (c_nationkey, c_mktsegment)").format(customer="customer"))
def agg_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "customer").rollup("c_nationkey", "c_mktsegment").agg(*_customer_aggs())


@case("agg_cube", (_GROUPED + "CUBE (c_nationkey, c_mktsegment)").format(customer="customer"))
def agg_cube(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "customer").cube("c_nationkey", "c_mktsegment").agg(*_customer_aggs())


@case("agg_grouping_sets", (_GROUPED + "GROUPING SETS ((c_nationkey), (c_mktsegment), ())").format(customer="customer"))
def agg_grouping_sets(spark: SparkSession, sf: str) -> DataFrame:
    return sql(spark, sf, _GROUPED + "GROUPING SETS ((c_nationkey), (c_mktsegment), ())")


@case(
    "agg_stats",
    """
    SELECT l_returnflag, round(stddev(l_quantity), 6) AS sd, round(var_pop(l_discount), 8) AS var,
           round(corr(l_quantity, l_extendedprice), 8) AS corr, round(covar_samp(l_quantity, l_tax), 8) AS covar,
           round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(skewness(l_quantity), 2) AS skew_sign
    FROM lineitem GROUP BY l_returnflag
    """,
)
def agg_stats(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.stddev("l_quantity"), 6).alias("sd"),
        F.round(F.var_pop("l_discount"), 8).alias("var"),
        F.round(F.corr("l_quantity", "l_extendedprice"), 8).alias("corr"),
        F.round(F.covar_samp("l_quantity", "l_tax"), 8).alias("covar"),
        F.round(F.regr_slope("l_extendedprice", "l_quantity"), 4).alias("slope"),
        F.round(F.skewness("l_quantity"), 2).alias("skew_sign"),
    )


@case(
    "agg_approx",
    """
    SELECT event_type, true AS users_close, true AS events_close, true AS quantiles_close
    FROM events GROUP BY event_type
    """,
)
def agg_approx(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches have bounded buffers whatever the group size; here each is held against the exact value.

    Distinct counts within three standard errors, quantiles within 0.1 % of the ranks.
    """
    events = read(spark, sf, "events")
    sketched = events.groupBy("event_type").agg(
        F.approx_count_distinct("user_id", 0.02).alias("users"),
        F.percentile_approx("value", [0.5, 0.95]).alias("quantiles"),
        F.hll_sketch_estimate(F.hll_sketch_agg("event_id", F.lit(12))).alias("events"),
    )
    users = events.where("user_id IS NOT NULL").select("event_type", "user_id").distinct()
    ids = events.where("event_id IS NOT NULL").select("event_type", "event_id").distinct()
    users = users.groupBy("event_type").agg(F.count(F.lit(1)).alias("exact_users"))
    ids = ids.groupBy("event_type").agg(F.count(F.lit(1)).alias("exact_events"))
    middle, high = F.col("quantiles")[0], F.col("quantiles")[1]
    ranked = events.join(sketched.select("event_type", "quantiles"), "event_type").groupBy("event_type").agg(
        F.count("value").alias("n"),
        *[F.count_if(F.col("value") < q).alias(f"below{i}") for i, q in enumerate((middle, high))],
        *[F.count_if(F.col("value") <= q).alias(f"upto{i}") for i, q in enumerate((middle, high))],
    )
    both = sketched.join(users, "event_type").join(ids, "event_type").join(ranked, "event_type")
    ranks = F.lit(True)
    for i, share in enumerate((0.5, 0.95)):
        ranks = ranks & (F.col(f"below{i}") <= (share + 0.001) * F.col("n") + 1)
        ranks = ranks & (F.col(f"upto{i}") >= (share - 0.001) * F.col("n") - 1)
    return both.select(
        "event_type",
        (F.abs(F.col("users") - F.col("exact_users")) <= 0.06 * F.col("exact_users") + 1).alias("users_close"),
        (F.abs(F.col("events") - F.col("exact_events")) <= 0.05 * F.col("exact_events") + 1).alias("events_close"),
        ranks.alias("quantiles_close"),
    )


@case(
    "agg_argmax",
    """
    SELECT user_id, arg_max(event_id, (value, event_id)) AS top_event, arg_min(event_type, (ts, event_id)) AS first_type,
           bool_and(value > 0) AS all_positive, bool_or(event_type = 'error') AS any_error,
           any_value(user_id % 7) AS any_bucket
    FROM events GROUP BY user_id
    """,
)
def agg_argmax(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").groupBy("user_id").agg(
        F.max_by("event_id", F.struct("value", "event_id")).alias("top_event"),
        F.min_by("event_type", F.struct("ts", "event_id")).alias("first_type"),
        F.bool_and(F.col("value") > 0).alias("all_positive"),
        F.bool_or(F.col("event_type") == "error").alias("any_error"),
        F.any_value(F.col("user_id") % 7, F.lit(True)).alias("any_bucket"),
    )


@case(
    "agg_collect",
    """
    SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS types,
           string_agg(CAST(n AS VARCHAR), ',' ORDER BY event_type) AS counts, count(*) AS kinds
    FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY user_id
    """,
)
def agg_collect(spark: SparkSession, sf: str) -> DataFrame:
    """Event types and their counts per user. Counting first keeps each list as short as the set of types."""
    counted = read(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.array_sort(F.collect_list(F.struct("event_type", "n"))).alias("pairs")
    listed = counted.groupBy("user_id").agg(
        pairs, F.expr("listagg(event_type, ',') WITHIN GROUP (ORDER BY event_type)").alias("types")
    )
    return listed.select(
        "user_id",
        "types",
        F.concat_ws(",", F.transform("pairs", lambda p: p["n"].cast("string"))).alias("counts"),
        F.size("pairs").cast("bigint").alias("kinds"),
    )


# ---------------------------------------------------------------- order, sets, shape


@case("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 5")
def topk(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").offset(5).limit(20)


@case("distinct_rows", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select("o_custkey", "o_orderpriority").distinct()


@case("sample_rows", "SELECT true AS count_close, true AS only_rows_of_the_table")
def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A tenth of the lines: as many as chance allows (six standard deviations), and no row more often than it is."""
    lines = read(spark, sf, "lineitem")
    sample = lines.sample(fraction=0.1, seed=7)
    counted = lines.groupBy(*lines.columns).agg(F.count(F.lit(1)).alias("held"))
    taken = sample.groupBy(*lines.columns).agg(F.count(F.lit(1)).alias("taken"))
    excess = null_safe_join(taken, counted, lines.columns, "left").where("held IS NULL OR taken > held")
    sizes = lines.agg(F.count(F.lit(1)).alias("n")).select(
        "n", sample.agg(F.count(F.lit(1))).scalar().alias("k"), excess.agg(F.count(F.lit(1))).scalar().alias("bad")
    )
    near = F.abs(F.col("k") - 0.1 * F.col("n")) <= 6 * F.sqrt(0.09 * F.col("n")) + 1
    return sizes.select(near.alias("count_close"), (F.col("bad") == 0).alias("only_rows_of_the_table"))


@case(
    "set_union",
    """
    SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
    UNION ALL BY NAME SELECT s_nationkey AS nation, s_name AS name FROM supplier
    """,
)
def set_union(spark: SparkSession, sf: str) -> DataFrame:
    customers = read(spark, sf, "customer").selectExpr("c_name AS name", "c_nationkey AS nation", "c_mktsegment AS segment")
    suppliers = read(spark, sf, "supplier").selectExpr("s_nationkey AS nation", "s_name AS name")
    return customers.unionByName(suppliers, allowMissingColumns=True)


def _per_copy(rows: DataFrame) -> DataFrame:
    return rows.groupBy("nation").agg(F.count(F.lit(1)).alias("copies"))


def _both_copies(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """How often each side holds a value; the ALL forms follow from these counts, without one row per copy."""
    return null_safe_join(_per_copy(left), _per_copy(right).withColumnRenamed("copies", "others"), ["nation"], how)


@case(
    "set_intersect",
    """
    SELECT 'distinct' AS kind, nation, count(*) AS copies FROM (
      SELECT c_nationkey AS nation FROM customer WHERE c_acctbal < 0 INTERSECT SELECT s_nationkey FROM supplier) GROUP BY ALL
    UNION ALL SELECT 'all', nation, count(*) FROM (
      SELECT c_nationkey AS nation FROM customer WHERE c_acctbal < 0 INTERSECT ALL SELECT s_nationkey FROM supplier) GROUP BY ALL
    """,
)
def set_intersect(spark: SparkSession, sf: str) -> DataFrame:
    indebted = read(spark, sf, "customer").where("c_acctbal < 0").selectExpr("c_nationkey AS nation")
    suppliers = read(spark, sf, "supplier").selectExpr("s_nationkey AS nation")
    once = _per_copy(indebted.intersect(suppliers)).select(F.lit("distinct").alias("kind"), "nation", "copies")
    fewer = F.least("copies", "others").alias("copies")
    every = _both_copies(indebted, suppliers, "inner").select(F.lit("all").alias("kind"), "nation", fewer)
    return once.unionByName(every)


@case(
    "set_except",
    """
    SELECT 'distinct' AS kind, nation, count(*) AS copies FROM (
      SELECT c_nationkey AS nation FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 7000) GROUP BY ALL
    UNION ALL SELECT 'all', nation, count(*) FROM (
      SELECT c_nationkey AS nation FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier WHERE s_acctbal > 7000) GROUP BY ALL
    """,
)
def set_except(spark: SparkSession, sf: str) -> DataFrame:
    customers = read(spark, sf, "customer").selectExpr("c_nationkey AS nation")
    rich = read(spark, sf, "supplier").where("s_acctbal > 7000").selectExpr("s_nationkey AS nation")
    once = _per_copy(customers.subtract(rich)).select(F.lit("distinct").alias("kind"), "nation", "copies")
    rest = (F.col("copies") - F.coalesce("others", F.lit(0))).alias("copies")
    every = _both_copies(customers, rich, "left").select(F.lit("all").alias("kind"), "nation", rest).where("copies > 0")
    return once.unionByName(every)


_SPINE = """
    WITH RECURSIVE span AS (
      SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last FROM {orders}),
    spine(month, last){limit} AS (
      SELECT first, last FROM span
      UNION ALL SELECT CAST({next} AS DATE), last FROM spine WHERE CAST({next} AS DATE) <= last),
    monthly AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS orders,
                       round(sum(o_totalprice), 2) AS price
                FROM {orders} WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
    SELECT spine.month, coalesce(orders, 0) AS orders, coalesce(price, 0.0) AS price
    FROM spine LEFT JOIN monthly ON spine.month = monthly.month
"""


@case("cte_recursive", _SPINE.format(orders="orders", next="month + INTERVAL 1 MONTH", limit=""))
def cte_recursive(spark: SparkSession, sf: str) -> DataFrame:
    """Urgent orders per month on a gapless month spine."""
    # As many levels as there are months in the data; the default of 100 would stop after eight years.
    span = read(spark, sf, "orders").agg(F.months_between(F.max("o_orderdate"), F.min("o_orderdate")).alias("m")).first()
    levels = int(span.m or 0) + 3
    text = _SPINE.replace("{next}", "add_months(month, 1)").replace("{limit}", f" MAX RECURSION LEVEL {levels}")
    return sql(spark, sf, text)


@case(
    "pivot",
    """
    SELECT user_id, round(sum(value) FILTER (WHERE event_type = 'click'), 2) AS click,
           round(sum(value) FILTER (WHERE event_type = 'error'), 2) AS error,
           round(sum(value) FILTER (WHERE event_type = 'purchase'), 2) AS purchase,
           round(sum(value) FILTER (WHERE event_type = 'signup'), 2) AS signup,
           round(sum(value) FILTER (WHERE event_type = 'view'), 2) AS "view",
           round(sum(value) FILTER (WHERE event_type IS NULL
             OR event_type NOT IN ('click', 'error', 'purchase', 'signup', 'view')), 2) AS other
    FROM events GROUP BY user_id
    """,
)
def pivot(spark: SparkSession, sf: str) -> DataFrame:
    kinds = ["click", "error", "purchase", "signup", "view"]
    # Whatever is no column of its own is summed under "other".
    kind = F.when(F.col("event_type").isin(kinds), F.col("event_type")).otherwise("other")
    kinds.append("other")
    wide = read(spark, sf, "events").withColumn("kind", kind).groupBy("user_id").pivot("kind", kinds).agg(F.sum("value"))
    return wide.select("user_id", *[F.round(k, 2).alias(k) for k in kinds])


@case(
    "unpivot",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, measure, amount FROM (
      SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem)
    UNPIVOT (amount FOR measure IN (l_quantity, l_discount, l_tax))
    """,
)
def unpivot(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").unpivot(
        ["l_orderkey", "l_partkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "measure", "amount"
    )


# ---------------------------------------------------------------- functions


@case(
    "fn_string",
    """
    SELECT doc_id, lower(source) AS source, length(text) AS chars, CAST(instr(text, 'the') AS INTEGER) AS first_the,
           replace(lang, 'e', 'E') AS lang, md5(regexp_replace(text, '[^a-zA-Z ]', '', 'g')) AS letters,
           regexp_matches(text, 'th[ea]n') AS has_then, trim(substr(text, 1, 12)) AS head,
           length(text) - length(replace(text, ' ', '')) AS blanks, split_part(source, 'c', 2) AS number,
           lpad(CAST(doc_id AS VARCHAR), 6, '0') AS padded, starts_with(text, 'Th') AS th, left(text, 3) || right(lang, 1) AS ends
    FROM documents
    """,
)
def fn_string(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").select(
        "doc_id",
        F.lower("source").alias("source"),
        F.length("text").cast("bigint").alias("chars"),
        F.instr("text", "the").alias("first_the"),
        F.replace("lang", F.lit("e"), F.lit("E")).alias("lang"),
        F.md5(F.regexp_replace("text", "[^a-zA-Z ]", "")).alias("letters"),
        F.col("text").rlike("th[ea]n").alias("has_then"),
        F.trim(F.substr("text", F.lit(1), F.lit(12))).alias("head"),
        (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).cast("bigint").alias("blanks"),
        F.split_part("source", F.lit("c"), F.lit(2)).alias("number"),
        F.lpad(F.col("doc_id").cast("string"), 6, "0").alias("padded"),
        F.startswith("text", F.lit("Th")).alias("th"),
        F.concat(F.left("text", F.lit(3)), F.right("lang", F.lit(1))).alias("ends"),
    )


@case(
    "fn_date",
    """
    SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS weekday,
           CAST(date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) AS INTEGER) AS since,
           CAST(o_orderdate + INTERVAL 1 MONTH AS DATE) AS next_month, CAST(last_day(o_orderdate) AS DATE) AS month_end,
           strftime(o_orderdate, '%Y/%m/%d') AS shown, CAST(week(o_orderdate) AS INTEGER) AS week,
           CAST(epoch(o_orderdate) AS BIGINT) AS seconds, make_date(year(o_orderdate), 1, 1) AS year_start
    FROM orders
    """,
)
def fn_date(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate")
    return read(spark, sf, "orders").select(
        "o_orderkey",
        F.date_trunc("month", day).cast("timestamp_ntz").alias("month"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.dayofweek(day).alias("weekday"),
        F.date_diff(day.cast("date"), F.lit("1995-01-01").cast("date")).alias("since"),
        F.add_months(day.cast("date"), 1).alias("next_month"),
        F.last_day(day.cast("date")).alias("month_end"),
        F.date_format(day, "yyyy/MM/dd").alias("shown"),
        F.weekofyear(day).alias("week"),
        F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), day).alias("seconds"),
        F.make_date(F.year(day), F.lit(1), F.lit(1)).alias("year_start"),
    )


@case(
    "fn_math",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice / nullif(l_quantity, 0) AS unit,
           round(sqrt(l_quantity), 6) AS root, round(ln(l_extendedprice), 6) AS ln, round(log10(l_extendedprice), 6) AS log10,
           CASE WHEN l_discount = 0 THEN NULL ELSE round(l_tax / l_discount, 6) END AS ratio,
           coalesce(nullif(l_tax, 0), -1) AS tax, CAST(floor(l_quantity / 7) AS BIGINT) AS sevens,
           CAST(l_orderkey % 13 AS BIGINT) AS bucket, greatest(l_tax, l_discount) AS most, least(l_tax, l_discount) AS less,
           CASE WHEN l_quantity < 10 THEN 'few' WHEN l_quantity < 40 THEN 'some' ELSE 'many' END AS amount,
           TRY_CAST(l_returnflag AS INTEGER) AS flag_number, power(l_linenumber, 2)::DOUBLE AS squared
    FROM lineitem
    """,
)
def fn_math(spark: SparkSession, sf: str) -> DataFrame:
    quantity, tax, discount = F.col("l_quantity"), F.col("l_tax"), F.col("l_discount")
    return read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.try_divide("l_extendedprice", quantity).alias("unit"),
        F.round(F.sqrt(quantity), 6).alias("root"),
        F.round(F.ln("l_extendedprice"), 6).alias("ln"),
        F.round(F.log10("l_extendedprice"), 6).alias("log10"),
        F.round(F.try_divide(tax, discount), 6).alias("ratio"),
        F.coalesce(F.nullif(tax, F.lit(0.0)), F.lit(-1.0)).alias("tax"),
        F.floor(quantity / 7).alias("sevens"),
        (F.col("l_orderkey") % 13).alias("bucket"),
        F.greatest(tax, discount).alias("most"),
        F.least(tax, discount).alias("less"),
        F.when(quantity < 10, "few").when(quantity < 40, "some").otherwise("many").alias("amount"),
        F.col("l_returnflag").try_cast("int").alias("flag_number"),
        F.pow("l_linenumber", F.lit(2)).alias("squared"),
    )


@case(
    "fn_array",
    """
    SELECT vec_id, len(embedding) AS dims, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x)), 4) AS norm2,
           len(list_filter(embedding, lambda x: x > 0)) AS positive, round(CAST(list_max(embedding) AS DOUBLE), 6) AS top,
           round(CAST(embedding[1] AS DOUBLE), 6) AS first, list_contains([0, 1, 2], label) AS small_label
    FROM embeddings
    """,
)
def fn_array(spark: SparkSession, sf: str) -> DataFrame:
    vector = F.col("embedding")
    squares = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
    return read(spark, sf, "embeddings").select(
        "vec_id",
        F.size(vector).cast("bigint").alias("dims"),
        F.round(squares, 4).alias("norm2"),
        F.size(F.filter(vector, lambda x: x > 0)).cast("bigint").alias("positive"),
        F.round(F.array_max(vector).cast("double"), 6).alias("top"),
        F.round(F.element_at(vector, 1).cast("double"), 6).alias("first"),
        F.array_contains(F.array(F.lit(0), F.lit(1), F.lit(2)), F.col("label")).alias("small_label"),
    )


@case(
    "fn_unnest",
    """
    SELECT position, count(*) AS vectors, round(sum(CAST(x AS DOUBLE)), 4) AS total, round(max(CAST(x AS DOUBLE)), 6) AS top
    FROM (SELECT unnest(embedding) AS x, unnest(range(len(embedding))) AS position FROM embeddings) GROUP BY position
    """,
)
def fn_unnest(spark: SparkSession, sf: str) -> DataFrame:
    flat = read(spark, sf, "embeddings").select(F.posexplode("embedding").alias("position", "x"))
    value = F.col("x").cast("double")
    return flat.groupBy(F.col("position").cast("bigint").alias("position")).agg(
        F.count(F.lit(1)).alias("vectors"), F.round(F.sum(value), 4).alias("total"), F.round(F.max(value), 6).alias("top")
    )


@case(
    "fn_map",
    """
    SELECT event_id, value * 2 AS doubled, event_type AS kind, 2 AS entries, 'user,value' AS keys, user_id + 1 AS next_user
    FROM events
    """,
)
def fn_map(spark: SparkSession, sf: str) -> DataFrame:
    pairs = F.map_from_arrays(
        F.array(F.lit("value"), F.lit("user")), F.array(F.col("value"), F.col("user_id").cast("double"))
    )
    doubled = F.transform_values(pairs, lambda k, v: F.when(k == "value", v * 2).otherwise(v + 1))
    record = F.named_struct(F.lit("kind"), F.col("event_type"), F.lit("pairs"), doubled)
    events = read(spark, sf, "events").select("event_id", record.alias("r"))
    return events.select(
        "event_id",
        F.col("r.pairs")["value"].alias("doubled"),
        F.col("r.kind").alias("kind"),
        F.size("r.pairs").alias("entries"),
        F.concat_ws(",", F.array_sort(F.map_keys("r.pairs"))).alias("keys"),
        F.col("r.pairs")["user"].cast("bigint").alias("next_user"),
    )


@case(
    "fn_json",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS text, CAST(json_extract_string(props, '$.k') AS BIGINT) AS number,
           CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS next, json_exists(props, '$.missing') AS has_missing
    FROM events
    """,
)
def fn_json(spark: SparkSession, sf: str) -> DataFrame:
    variant = F.parse_json("props")
    return read(spark, sf, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("text"),
        F.from_json("props", "k bigint")["k"].alias("number"),
        (F.variant_get(variant, "$.k", "int") + 1).alias("next"),
        F.get_json_object("props", "$.missing").isNotNull().alias("has_missing"),
    )


@case("fn_hash", "SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256, md5(source || ':' || lang) AS pair FROM documents")
def fn_hash(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents").select(
        "doc_id",
        F.md5("text").alias("md5"),
        F.sha2("text", 256).alias("sha256"),
        F.md5(F.concat_ws(":", "source", "lang")).alias("pair"),
    )
