"""Quality checks over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.operators import checks, diff, incremental
from tablekit.operators.checks import Check
from tablekit.session import scratch_path
from tablekit.suite.registry import case, read

SHOWN = ("check_name", "check_type", "column_name", "metric", "operator", "threshold", "passed")


def _row(name, kind, column, metric, operator, threshold, passed, source) -> str:
    """One expected check row as SQL."""
    shown = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT '{name}' AS check_name, '{kind}' AS check_type, {shown} AS column_name, m AS metric, "
        f"'{operator}' AS operator, CAST({threshold} AS DOUBLE) AS threshold, m {passed} AS passed "
        f"FROM (SELECT CAST({metric} AS DOUBLE) AS m FROM {source})"
    )


def _shown(results: DataFrame) -> DataFrame:
    return results.select(*SHOWN)


CONTRACT = (
    Check("has rows", "row_count", operator="must_be_greater_than"),
    Check("quantity known", "missing_count", ("l_quantity",)),
    Check("line is unique", "duplicate_count", ("l_orderkey", "l_linenumber")),
    Check("discount in range", "audit", expr="l_discount BETWEEN 0 AND 0.1"),
)
_PAIR_DUPLICATES = (
    "count(*) FILTER (WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL) - "
    "(SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem "
    "WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL))"
)
CONTRACT_SQL = " UNION ALL ".join(
    [
        _row("has rows", "row_count", None, "count(*)", "must_be_greater_than", 0, "> 0", "lineitem"),
        _row("quantity known", "missing_count", "l_quantity", "count(*) - count(l_quantity)", "must_be", 0, "= 0",
             "lineitem"),
        _row("line is unique", "duplicate_count", "l_orderkey, l_linenumber", _PAIR_DUPLICATES, "must_be", 0, "= 0",
             "lineitem"),
        _row("discount in range", "audit", None,
             "count(*) FILTER (WHERE NOT coalesce(l_discount BETWEEN 0 AND 0.1, false))", "must_be", 0, "= 0",
             "lineitem"),
    ]
)


@case("verify_contract", CONTRACT_SQL)
def verify_contract(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(checks.verify(read(spark, sf, "lineitem"), CONTRACT, "lines", "lineitem"))


@case(
    "verify_totals",
    f"""
    SELECT 'lines' AS contract, count(*) AS checks_total, count(*) FILTER (WHERE passed) AS checks_passed,
           count(*) FILTER (WHERE NOT passed) AS checks_failed, bool_and(passed) AS passed FROM ({CONTRACT_SQL})
    """,
)
def verify_totals(spark: SparkSession, sf: str) -> DataFrame:
    results = checks.verify(read(spark, sf, "lineitem"), CONTRACT, "lines", "lineitem")
    return checks.totals(results).drop("run_id", "dataset")


@case(
    "check_row_count",
    _row("orders arrived", "row_count", None, "count(*)", "must_be_greater_than_or_equal", 1000, ">= 1000", "orders"),
)
def check_row_count(spark: SparkSession, sf: str) -> DataFrame:
    check = Check("orders arrived", "row_count", operator="must_be_greater_than_or_equal", threshold=1000)
    return _shown(checks.verify(read(spark, sf, "orders"), [check]))


@case(
    "check_missing",
    " UNION ALL ".join(
        [
            _row("label", "missing_count", "quality", "count(*) - count(quality)", "must_be", 0, "= 0",
                 "documents LEFT JOIN labels USING (doc_id)"),
            _row("language", "missing_count", "lang",
                 "count(*) FILTER (WHERE lang IS NULL OR lang IN ('de', 'es'))", "must_be", 0, "= 0", "documents"),
        ]
    ),
)
def check_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without a label, and two languages treated as missing."""
    labelled = read(spark, sf, "documents").join(read(spark, sf, "labels"), "doc_id", "left")
    wanted = [
        Check("label", "missing_count", ("quality",)),
        Check("language", "missing_count", ("lang",), missing_values=("de", "es")),
    ]
    return _shown(checks.verify(labelled, wanted))


_DUPLICATES = {
    "l_orderkey": "lineitem",
    "l_partkey": "lineitem",
    "l_suppkey": "lineitem",
    "l_shipdate": "lineitem",
}


@case(
    "check_duplicate",
    " UNION ALL ".join(
        [
            _row(c, "duplicate_count", c, f"count({c}) - count(DISTINCT {c})", "must_be", 0, "= 0", t)
            for c, t in _DUPLICATES.items()
        ]
        + [_row("pair", "duplicate_count", "l_orderkey, l_linenumber", _PAIR_DUPLICATES, "must_be", 0, "= 0", "lineitem")]
    ),
)
def check_duplicate(spark: SparkSession, sf: str) -> DataFrame:
    """Five exact duplicate checks: past the fusing limit, so one pruned scan each."""
    wanted = [Check(c, "duplicate_count", (c,)) for c in _DUPLICATES]
    wanted.append(Check("pair", "duplicate_count", ("l_orderkey", "l_linenumber")))
    return _shown(checks.verify(read(spark, sf, "lineitem"), wanted))


_THRESHOLDS = [
    ("must_be", 5000, "= 5000"),
    ("must_not_be", 5000, "<> 5000"),
    ("must_be_greater_than", 5000, "> 5000"),
    ("must_be_greater_than_or_equal", 5000, ">= 5000"),
    ("must_be_less_than", 5000, "< 5000"),
    ("must_be_less_than_or_equal", 5000, "<= 5000"),
    ("must_be_between", 100, "BETWEEN 100 AND 20000"),
]
_NEGATIVE = "count(*) FILTER (WHERE NOT coalesce(o_totalprice <= 300000, false))"


@case(
    "check_threshold",
    " UNION ALL ".join([_row(o, "audit", None, _NEGATIVE, o, t, p, "orders") for o, t, p in _THRESHOLDS]),
)
def check_threshold(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [
        Check(o, "audit", expr="o_totalprice <= 300000", operator=o, threshold=t,
              upper=20000 if o == "must_be_between" else None)
        for o, t, _ in _THRESHOLDS
    ]
    return _shown(checks.verify(read(spark, sf, "orders"), wanted))


@case(
    "verify_variables",
    " UNION ALL ".join(
        [
            _row("volume", "row_count", None, "count(*)", "must_be_greater_than", 1000, "> 1000", "events"),
            _row("bounded", "audit", None, "count(*) FILTER (WHERE NOT coalesce(value < 250.5, false))", "must_be", 0,
                 "= 0", "events"),
            _row("kind", "audit", None, "count(*) FILTER (WHERE NOT coalesce(event_type <> 'error', false))",
                 "must_be_less_than", 3000, "< 3000", "events"),
        ]
    ),
)
def verify_variables(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [
        Check("volume", "row_count", operator="must_be_greater_than", threshold=":min_rows"),
        Check("bounded", "audit", expr="value < :top"),
        Check("kind", "audit", expr="event_type <> :bad", operator="must_be_less_than", threshold=":most"),
    ]
    variables = '{"min_rows": 1000, "top": 250.5, "bad": "error", "most": 3000}'
    return _shown(checks.verify(read(spark, sf, "events"), wanted, variables=variables))


@case(
    "audit_violations",
    """
    SELECT event_id, ts, user_id, event_type, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21'
      AND NOT coalesce(CASE WHEN event_type <> 'view' THEN value < 100 END, false)
    """,
)
def audit_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Views have no outcome here (NULL), so they are violations too."""
    events = read(spark, sf, "events").drop("props")
    expr = "CASE WHEN event_type <> 'view' THEN value < 100 END"
    return checks.violations(events, expr, "ts", "2024-01-05", "2024-01-20")


@case(
    "check_structure",
    """
    SELECT * FROM (
      SELECT c.column_name, 'structure' AS check_type,
             CASE WHEN t IS NULL THEN 'missing column' WHEN e IS NULL THEN 'unexpected column'
                  WHEN t <> e THEN 'wrong type' ELSE 'as expected' END AS check_name,
             CASE WHEN t IS NOT NULL AND e IS NOT NULL AND t = e THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS metric,
             'must_be' AS operator, 0.0::DOUBLE AS threshold, t IS NOT NULL AND e IS NOT NULL AND t = e AS passed
      FROM (SELECT coalesce(a.column_name, x.column_name) AS column_name, a.t, x.e
            FROM (SELECT name AS column_name, lower(type) AS t FROM (
                    SELECT unnest(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) AS name,
                           unnest([any_value(typeof(c_custkey)), any_value(typeof(c_name)),
                                   any_value(typeof(c_nationkey)), any_value(typeof(c_acctbal)),
                                   any_value(typeof(c_mktsegment))]) AS type FROM customer)) AS a
            FULL JOIN (VALUES ('c_custkey', 'bigint'), ('c_name', 'varchar'), ('c_acctbal', 'decimal(12,2)'),
                              ('c_phone', 'varchar'), ('c_mktsegment', 'varchar')) AS x(column_name, e)
            ON a.column_name = x.column_name) AS c)
    """,
)
def check_structure(spark: SparkSession, sf: str) -> DataFrame:
    expected = "c_custkey bigint, c_name string, c_acctbal decimal(12,2), c_phone string, c_mktsegment string"
    return _shown(checks.structure(read(spark, sf, "customer"), expected))


@case(
    "check_structure_contract",
    "SELECT 'shape' AS check_name, 'structure' AS check_type, CAST(NULL AS VARCHAR) AS column_name, "
    "CAST(2 AS DOUBLE) AS metric, 'must_be' AS operator, CAST(0 AS DOUBLE) AS threshold, false AS passed "
    "UNION ALL " + _row("known", "missing_count", "c_name", "count(*) - count(c_name)", "must_be", 0, "= 0", "customer")
    + " UNION ALL SELECT 'no such column', 'audit', NULL, NULL, 'must_be', 0, false",
)
def check_structure_contract(spark: SparkSession, sf: str) -> DataFrame:
    """A structure check and an audit that does not resolve, beside a check of rows."""
    wanted = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal decimal(12,2), c_phone string, c_mktsegment string"
    contract = [
        Check("shape", "structure", expr=wanted),
        Check("known", "missing_count", ("c_name",)),
        Check("no such column", "audit", expr="c_balance > 0"),
    ]
    return _shown(checks.verify(read(spark, sf, "customer"), contract))


@case(
    "contract_stored",
    " UNION ALL ".join(
        [
            _row("volume", "row_count", None, "count(*)", "must_be_between", 100, "BETWEEN 100 AND 1000000", "events"),
            _row("kind", "missing_count", "event_type",
                 "count(*) FILTER (WHERE event_type IS NULL OR event_type IN ('view', 'error'))", "must_be_less_than",
                 900000, "< 900000", "events"),
            _row("user and time", "duplicate_count", "user_id, ts",
                 "count(*) FILTER (WHERE user_id IS NOT NULL AND ts IS NOT NULL) - (SELECT count(*) FROM (SELECT DISTINCT "
                 "user_id, ts FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL))", "must_be", 0, "= 0", "events"),
        ]
    ),
)
def contract_stored(spark: SparkSession, sf: str) -> DataFrame:
    """A contract saved as a table, with a range, values that count as missing and a variable, and read back."""
    contract = [
        Check("volume", "row_count", operator="must_be_between", threshold=100, upper=":most"),
        Check("kind", "missing_count", ("event_type",), missing_values=("view", "error"), operator="must_be_less_than",
              threshold=":limit"),
        Check("user and time", "duplicate_count", ("user_id", "ts")),
    ]
    path = scratch_path(spark, "contract")
    checks.spec_frame(spark, contract).write.parquet(path)
    stored = checks.checks_from(spark.read.schema(checks.CHECK_SPEC).parquet(path).orderBy("check_name"))
    variables = {"most": 1_000_000, "limit": 900_000}
    return _shown(checks.verify(read(spark, sf, "events"), stored, variables=variables))


_AUDITS = {"cheap": "l_extendedprice < 50000", "small": "l_quantity < 40", "early": "l_shipdate < DATE '1998-06-01'"}


@case(
    "audit_many",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, concat_ws(',', CASE WHEN NOT coalesce(l_extendedprice < 50000, false) THEN 'cheap' END,
      CASE WHEN NOT coalesce(l_quantity < 40, false) THEN 'small' END,
      CASE WHEN NOT coalesce(l_shipdate < DATE '1998-06-01', false) THEN 'early' END) AS broken
    FROM lineitem WHERE NOT coalesce(l_extendedprice < 50000 AND l_quantity < 40 AND l_shipdate < DATE '1998-06-01', false)
    """,
)
def audit_many(spark: SparkSession, sf: str) -> DataFrame:
    found = checks.audit(read(spark, sf, "lineitem"), _AUDITS)
    return found.select("l_orderkey", "l_partkey", "l_linenumber", F.concat_ws(",", "broken").alias("broken"))


@case(
    "audit_counts",
    """
    SELECT 'cheap' AS audit, count(*) FILTER (WHERE NOT coalesce(l_extendedprice < 50000, false)) AS violations FROM lineitem
    UNION ALL SELECT 'small', count(*) FILTER (WHERE NOT coalesce(l_quantity < 40, false)) FROM lineitem
    UNION ALL SELECT 'early', count(*) FILTER (WHERE NOT coalesce(l_shipdate < DATE '1998-06-01', false)) FROM lineitem
    """,
)
def audit_counts(spark: SparkSession, sf: str) -> DataFrame:
    return checks.audit_counts(read(spark, sf, "lineitem"), _AUDITS)


_HISTORY_SQL = """
    SELECT user_id || '-' || event_type AS run_id, event_type AS contract, max(ts) AS ts, bool_and(value < 200) AS passed,
           count(*) AS checks_total, count(*) FILTER (WHERE value < 200) AS checks_passed,
           count(*) FILTER (WHERE NOT value < 200) AS checks_failed
    FROM events WHERE starts_with(event_type, {prefix}) GROUP BY user_id, event_type
"""


def _results(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as check results: a run per user and type, a check per event."""
    return read(spark, sf, "events").select(
        F.concat_ws("-", "user_id", "event_type").alias("run_id"),
        F.col("event_type").alias("contract"),
        F.lit("events").alias("dataset"),
        F.concat(F.lit("check "), F.col("event_id")).alias("check_name"),
        F.lit("audit").alias("check_type"),
        F.lit(None).cast("string").alias("column_name"),
        F.col("value").alias("metric"),
        F.lit("must_be_less_than").alias("operator"),
        F.lit(200.0).alias("threshold"),
        (F.col("value") < 200).alias("passed"),
        F.create_map(F.lit("rows"), F.lit(1.0)).alias("metrics"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


@case(
    "check_history",
    "SELECT * FROM (" + _HISTORY_SQL.format(prefix="'p'") + ") ORDER BY ts DESC, contract, run_id LIMIT 10",
)
def check_history(spark: SparkSession, sf: str) -> DataFrame:
    """The ten newest verifications of contracts starting with p, saved and read back."""
    path = scratch_path(spark, "results")
    checks.save_results(_results(spark, sf), path)
    latest = checks.history(checks.read_results(spark, path), "p", 10)
    return latest.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@case(
    "check_history_all",
    _HISTORY_SQL.format(prefix="''"),
)
def check_history_all(spark: SparkSession, sf: str) -> DataFrame:
    return checks.history(_results(spark, sf), limit=None).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@case(
    "check_history_rows",
    """
    SELECT e.user_id || '-' || e.event_type AS run_id, 'check ' || e.event_id AS check_name, e.value AS metric,
           e.value < 200 AS passed
    FROM events e JOIN (SELECT user_id, event_type, max(ts) AS last FROM events WHERE starts_with(event_type, 'p')
                        GROUP BY ALL ORDER BY last DESC LIMIT 10) USING (user_id, event_type)
    """,
)
def check_history_rows(spark: SparkSession, sf: str) -> DataFrame:
    found = checks.history(_results(spark, sf), "p", 10, show_checks=True)
    return found.select("run_id", "check_name", "metric", "passed")


def _suggestions(table: str, columns: list[str]) -> str:
    """Key-like columns of a table as expected ``check_spec`` rows."""
    parts = [
        f"SELECT '{c} ' || kind AS check_name, kind AS check_type, '{c}' AS column_name, CAST(NULL AS VARCHAR) AS expr, "
        f"'must_be' AS operator, 0.0::DOUBLE AS threshold FROM (SELECT count(*) AS n, count({c}) AS k, "
        f"count(DISTINCT {c}) AS d FROM {table}), (VALUES ('duplicate_count'), ('missing_count')) AS v(kind) "
        "WHERE d = n AND k = n"
        for c in columns
    ]
    parts.append("SELECT 'row_count', 'row_count', NULL, NULL, 'must_be_greater_than', 0.0::DOUBLE")
    return " UNION ALL ".join(parts)


@case(
    "suggest_checks",
    _suggestions("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]),
)
def suggest_checks(spark: SparkSession, sf: str) -> DataFrame:
    return checks.suggest_checks(read(spark, sf, "orders"))


@case(
    "table_diff",
    """
    WITH expected AS (SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem),
    actual AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 49 THEN 'X' ELSE l_returnflag END AS l_returnflag
               FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_returnflag, 'missing' AS diff, count(*) AS copies
    FROM (SELECT * FROM expected EXCEPT ALL SELECT * FROM actual) GROUP BY ALL
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_returnflag, 'extra', count(*)
    FROM (SELECT * FROM actual EXCEPT ALL SELECT * FROM expected) GROUP BY ALL
    """,
)
def table_diff(spark: SparkSession, sf: str) -> DataFrame:
    lines = read(spark, sf, "lineitem")
    expected = lines.select("l_orderkey", "l_linenumber", "l_returnflag")
    flag = F.when(F.col("l_quantity") > 49, "X").otherwise(F.col("l_returnflag")).alias("l_returnflag")
    return diff.table_diff(expected, lines.select("l_orderkey", "l_linenumber", flag))


@case(
    "contract_runtime_error",
    """
    SELECT 'rows' AS check_name, CAST(count(*) AS DOUBLE) AS metric, count(*) > 0 AS passed FROM events
    UNION ALL SELECT 'value below 200', count(*) FILTER (WHERE NOT coalesce(value < 200, false)),
      count(*) FILTER (WHERE NOT coalesce(value < 200, false)) = 0 FROM events
    UNION ALL SELECT 'type is a number', CAST(NULL AS DOUBLE), false
    """,
)
def contract_runtime_error(spark: SparkSession, sf: str) -> DataFrame:
    """One audit raises on the first row it sees; it fails, and the others are checked all the same."""
    wanted = [
        Check("rows", "row_count", operator="must_be_greater_than"),
        Check("type is a number", "audit", expr="CAST(event_type AS INT) > 0"),
        Check("value below 200", "audit", expr="value < 200"),
    ]
    return checks.verify(read(spark, sf, "events"), wanted).select("check_name", "metric", "passed")


@case(
    "audit_names",
    """
    SELECT event_id, concat_ws('; ', CASE WHEN NOT coalesce(value < 100, false) THEN 'it''s {cheap}' END,
      CASE WHEN event_type = 'error' THEN 'no \\error\\' END) AS broken
    FROM events WHERE NOT coalesce(value < 100, false) OR event_type = 'error'
    """.replace("\\\\", "\\"),
)
def audit_names(spark: SparkSession, sf: str) -> DataFrame:
    """Audits whose names hold quotes, braces and backslashes."""
    audits = {"it's {cheap}": "value < 100", "no \\error\\": "event_type <> 'error'"}
    found = checks.audit(read(spark, sf, "events"), audits)
    return found.select("event_id", F.concat_ws("; ", "broken").alias("broken"))


@case(
    "table_diff_keys",
    """
    WITH actual AS (
      SELECT o_orderkey, CASE WHEN o_orderkey % 5000 = 17 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
        CASE WHEN o_orderkey BETWEEN 300 AND 320 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderkey BETWEEN 310 AND 330 THEN NULL ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
      FROM orders WHERE o_orderkey NOT BETWEEN 700 AND 703
      UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
      FROM orders WHERE o_orderkey BETWEEN 5 AND 9),
    pairs AS (
      SELECT coalesce(e.o_orderkey, a.o_orderkey) AS o_orderkey, a.o_orderkey IS NULL AS missing, e.o_orderkey IS NULL AS extra,
        concat_ws(',', CASE WHEN e.o_custkey IS DISTINCT FROM a.o_custkey THEN 'o_custkey' END,
          CASE WHEN e.o_orderstatus IS DISTINCT FROM a.o_orderstatus THEN 'o_orderstatus' END,
          CASE WHEN e.o_totalprice IS DISTINCT FROM a.o_totalprice THEN 'o_totalprice' END) AS columns
      FROM orders e FULL JOIN actual a ON e.o_orderkey = a.o_orderkey)
    SELECT o_orderkey, CASE WHEN missing THEN 'missing' WHEN extra THEN 'extra' ELSE 'changed' END AS diff,
      CASE WHEN missing OR extra THEN '' ELSE columns END AS columns
    FROM pairs WHERE missing OR extra OR columns <> ''
    """,
)
def table_diff_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Orders against a copy with changed, lost and added ones: which columns of which keys differ."""
    orders = read(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    key = F.col("o_orderkey")
    actual = orders.where(~key.between(700, 703)).withColumns(
        {
            "o_custkey": F.when(key % 5000 == 17, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")),
            "o_orderstatus": F.when(key.between(300, 320), "X").otherwise(F.col("o_orderstatus")),
            "o_totalprice": F.when(~key.between(310, 330), F.col("o_totalprice")),
        }
    )
    added = orders.where(key.between(5, 9)).withColumn("o_orderkey", key + 10_000_000)
    path = scratch_path(spark, "orders")
    actual.unionByName(added).repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").write.parquet(path)
    found = diff.diff_keys(orders, spark.read.parquet(path), ["o_orderkey"])
    return found.withColumn("columns", F.concat_ws(",", "columns"))


@case(
    "verify_incremental",
    """
    SELECT check_name, CAST(metric AS DOUBLE) AS metric, passed FROM (
      SELECT 'rows' AS check_name, count(*) AS metric, count(*) > 0 AS passed FROM events
      UNION ALL SELECT 'user known', count(*) - count(user_id), count(*) = count(user_id) FROM events
      UNION ALL SELECT 'value below 200', count(*) FILTER (WHERE NOT coalesce(value < 200, false)),
        count(*) FILTER (WHERE NOT coalesce(value < 200, false)) = 0 FROM events
      UNION ALL SELECT 'event is unique', count(event_id) - count(DISTINCT event_id), count(event_id) = count(DISTINCT event_id) FROM events
      UNION ALL SELECT 'user and type once', count(*) - count(DISTINCT (user_id, event_type)), count(*) = count(DISTINCT (user_id, event_type))
        FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL)
    """,
)
def verify_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """A contract on a table that grows by days: each run reads the new days, and one that was loaded again."""
    wanted = [
        Check("rows", "row_count", operator="must_be_greater_than"),
        Check("user known", "missing_count", ("user_id",)),
        Check("value below 200", "audit", expr="value < 200"),
        Check("event is unique", "duplicate_count", ("event_id",)),
        Check("user and type once", "duplicate_count", ("user_id", "event_type")),
    ]
    path = scratch_path(spark, "days")
    states = incremental.States(spark, scratch_path(spark, "states"))
    events = read(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    day = F.dayofmonth("ts")
    # At first the fifth has half of its rows; later days come in, then the fifth as a whole.
    first = events.where((day <= 20) & ((day != 5) | (F.hour("ts") < 12)))
    for batch, again in ((first, ()), (events.where(day > 20), ()), (events.where(day == 5), ("2024-01-05",))):
        write = batch.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        write.partitionBy("day").parquet(path)
        stored = spark.read.schema(events.schema).parquet(path)
        results = incremental.verify(stored, wanted, "day", states, again=again)
    return results.select("check_name", "metric", "passed")

