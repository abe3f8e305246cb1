"""Data-quality checks: specs, one-pass verification, history and suggestions."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablekit.errors import InvalidSpec, InvalidVariables
from tablekit.operators.schema import schema_frame
from tablekit.operators.stats import MAX_FUSED_DISTINCT, exact_distinct
from tablekit.session import materialize

CHECK_RESULT = (
    "run_id string, contract string, dataset string, check_name string, check_type string, "
    "column_name string, metric double, operator string, threshold double, passed boolean, "
    "metrics map<string,double>, ts timestamp"
)

# Threshold operators and the comparison each one stands for.
OPERATORS = {
    "must_be": "=",
    "must_not_be": "<>",
    "must_be_greater_than": ">",
    "must_be_greater_than_or_equal": ">=",
    "must_be_less_than": "<",
    "must_be_less_than_or_equal": "<=",
    "must_be_between": "between",
}
CHECK_TYPES = ("row_count", "missing_count", "duplicate_count", "audit", "structure")


@dataclass(frozen=True)
class Check:
    """One check. Without a threshold the metric must be 0.

    ``columns`` holds one column, or several for a duplicate check over a composite key. ``expr`` is
    the predicate every row must satisfy in an audit; ``:name`` in it, or as threshold, is a variable. In a
    structure check it is the expected schema, and the metric the number of columns that differ.
    """

    name: str
    type: str
    columns: tuple[str, ...] = ()
    expr: str | None = None
    operator: str = "must_be"
    threshold: float | str = 0
    upper: float | str | None = None
    missing_values: tuple[str, ...] = ()
    approx: bool = False
    variables: Mapping[str, Any] = field(default_factory=dict, compare=False)

    def __post_init__(self):
        if self.type not in CHECK_TYPES:
            raise InvalidSpec(f"check type {self.type!r}; expected one of {CHECK_TYPES}")
        if self.operator not in OPERATORS:
            raise InvalidSpec(f"operator {self.operator!r}; expected one of {sorted(OPERATORS)}")
        if (self.operator == "must_be_between") != (self.upper is not None):
            raise InvalidSpec("must_be_between, and only it, needs upper=")
        if self.type in ("missing_count", "duplicate_count") and not self.columns:
            raise InvalidSpec(f"{self.type} needs a column")
        if self.type == "audit" and not self.expr:
            raise InvalidSpec("audit needs expr")
        if self.type == "structure" and not self.expr:
            raise InvalidSpec("structure needs the expected schema as expr")


CHECK_SPEC = (
    "check_name string, check_type string, column_name string, expr string, operator string, threshold string, "
    "upper string, missing_values array<string>, approx boolean, columns array<string>"
)


def checks_from(specs: DataFrame) -> list[Check]:
    """Checks stored as ``check_spec`` rows (a contract's worth: they become plan text).

    The first five columns of ``CHECK_SPEC`` and a threshold must be there; a threshold or upper bound is a number
    or ``:name``. ``columns`` holds the key columns; without it they are the parts of ``column_name`` between commas.
    """

    def bound(value):
        return value if value is None or (isinstance(value, str) and value.startswith(":")) else float(value)

    out = []
    for row in specs.collect():
        r = row.asDict()
        listed = r["column_name"].split(",") if r["column_name"] else ()
        columns = r.get("columns") if r.get("columns") is not None else [c.strip() for c in listed]
        out.append(
            Check(
                r["check_name"],
                r["check_type"],
                tuple(columns),
                r["expr"],
                r["operator"] or "must_be",
                bound(r["threshold"]) or 0,
                bound(r.get("upper")),
                tuple(r.get("missing_values") or ()),
                bool(r.get("approx")),
            )
        )
    return out


def spec_frame(spark: SparkSession, checks: Sequence[Check]) -> DataFrame:
    """Checks as rows that ``checks_from`` reads back; save them like any table."""

    def bound(value):
        return None if value is None else str(value)

    rows = [
        (c.name, c.type, ", ".join(c.columns) or None, c.expr, c.operator, bound(c.threshold), bound(c.upper),
         list(c.missing_values), c.approx, list(c.columns))
        for c in checks
    ]
    return spark.createDataFrame(rows, CHECK_SPEC)


def parse_variables(variables: str | Mapping[str, Any] | None) -> dict[str, Any]:
    """Variables as a dict; text must be a JSON object."""
    if variables is None:
        return {}
    if isinstance(variables, Mapping):
        return dict(variables)
    try:
        parsed = json.loads(variables)
    except json.JSONDecodeError as error:
        raise InvalidVariables(str(error)) from error
    if not isinstance(parsed, dict):
        raise InvalidVariables("variables must be a JSON object")
    return parsed


def _number(value: float | str | None, variables: Mapping[str, Any]) -> float | None:
    if isinstance(value, str):
        name = value.lstrip(":")
        if not value.startswith(":") or name not in variables:
            raise InvalidVariables(f"threshold {value!r} has no variable")
        value = variables[name]
    return None if value is None else float(value)


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _metric(check: Check) -> str:
    if check.type == "row_count":
        return "count(*)"
    quoted = [_quoted(c) for c in check.columns]
    if check.type == "missing_count":
        listed = ", ".join(_literal(v) for v in check.missing_values)
        also = f" OR cast({quoted[0]} AS STRING) IN ({listed})" if listed else ""
        return f"count_if({quoted[0]} IS NULL{also})"
    if check.type == "duplicate_count":
        # count over several columns leaves out rows in which any of them is NULL.
        parts = ", ".join(quoted)
        if not check.approx:
            return f"count({parts}) - count(DISTINCT {parts})"
        known = " AND ".join(f"{q} IS NOT NULL" for q in quoted)
        return f"greatest(count({parts}) - approx_count_distinct(CASE WHEN {known} THEN struct({parts}) END), 0)"
    return f"count_if(NOT coalesce(({check.expr}), false))"


def compare(metric: Column, operator: str, threshold: Column, upper: Column | None = None) -> Column:
    """Whether a metric meets its threshold; a NULL metric does not."""
    symbol = OPERATORS[operator]
    outcome = {
        "=": lambda: metric == threshold,
        "<>": lambda: metric != threshold,
        ">": lambda: metric > threshold,
        ">=": lambda: metric >= threshold,
        "<": lambda: metric < threshold,
        "<=": lambda: metric <= threshold,
        "between": lambda: metric.between(threshold, upper),
    }[symbol]()
    return F.coalesce(outcome, F.lit(False))


def _entry(check: Check, metric: Column, variables: Mapping[str, Any], rows: Column) -> Column:
    metric = metric.cast("double")
    low, high = _number(check.threshold, variables), _number(check.upper, variables)
    details = [F.lit("rows"), rows.cast("double")]
    if high is not None:
        details += [F.lit("upper"), F.lit(high)]
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.type).alias("check_type"),
        F.lit(", ".join(check.columns) or None).cast("string").alias("column_name"),
        metric.alias("metric"),
        F.lit(check.operator).alias("operator"),
        F.lit(low).alias("threshold"),
        compare(metric, check.operator, F.lit(low), F.lit(high)).alias("passed"),
        F.create_map(*details).alias("metrics"),
    )


def _select(df: DataFrame, text: str, variables: Mapping[str, Any]) -> DataFrame:
    used = {k: v for k, v in variables.items() if f":{k}" in text}
    return df.sparkSession.sql(text, args=used, rows=df)


def _escape(text: str) -> str:
    return text.replace("{", "{{").replace("}", "}}")


def verify(
    df: DataFrame,
    checks: Sequence[Check],
    contract: str = "contract",
    dataset: str = "dataset",
    variables: str | Mapping[str, Any] | None = None,
    run_id: str | None = None,
    ts: datetime | None = None,
    expected: StructType | None = None,
) -> DataFrame:
    """Run a contract: one ``check_result`` row per check.

    All metrics come from one aggregate, so one scan of the needed columns. Only when there are more
    exact duplicate checks than ``MAX_FUSED_DISTINCT`` do these move to one pruned scan each, since
    Spark would otherwise repeat every row once per distinct key. Checks on columns the table does
    not have, and audits that do not resolve, fail with a NULL metric. ``expected`` adds a structure check first.

    An audit may also raise on some row when it runs. So a contract with audits is run at once and its rows are
    written to the shared folder; if that fails, each audit runs alone, and those that raise fail with a NULL metric.
    """
    if not checks and expected is None:
        raise InvalidSpec("a contract needs at least one check")
    given = parse_variables(variables)
    stamp = {
        "run_id": F.lit(run_id or uuid.uuid4().hex),
        "contract": F.lit(contract),
        "dataset": F.lit(dataset),
        "ts": F.lit(ts or datetime.now(timezone.utc)).cast("timestamp"),
    }
    names = StructType.fromDDL(CHECK_RESULT).names

    def stamped(results: DataFrame) -> DataFrame:
        return results.withColumns(stamp).select(*names)

    audits = [c for c in checks if c.type == "audit"]
    whole = stamped(_results(df, checks, given, expected))
    if not audits:
        return whole
    try:
        return materialize(whole, "checks")
    except PySparkException:
        pass  # the audit that raised is found below; any other failure is raised again there
    others = [c for c in checks if c.type != "audit"]
    parts = [materialize(stamped(_results(df, others, given, expected)), "checks")] if others or expected else []
    for check in audits:
        try:
            parts.append(materialize(stamped(_results(df, [check], given, None)), "checks"))
        except PySparkException:
            parts.append(materialize(stamped(_results(df, [], given, None, [check])), "checks"))
    return reduce(DataFrame.unionByName, parts)


def _results(
    df: DataFrame, checks: Sequence[Check], given: Mapping[str, Any], expected: StructType | None, failed: Sequence[Check] = ()
) -> DataFrame:
    """One row per check, ``failed`` ones without a metric."""
    known = set(df.columns)
    usable = [c for c in checks if set(c.columns) <= known and _resolves(df, c, given)]
    broken = [*(c for c in checks if c not in usable), *failed]
    shapes = {c.name: _differences(df, c.expr) for c in usable if c.type == "structure"}
    exact = [c for c in usable if c.type == "duplicate_count" and not c.approx]
    alone = exact if len(exact) > MAX_FUSED_DISTINCT else []
    fused = [c for c in usable if c not in alone]

    metrics = ", ".join(
        f"{shapes[c.name] if c.type == 'structure' else _escape(_metric(c))} AS `__m{i}`" for i, c in enumerate(fused)
    )
    base = _select(df, f"SELECT count(*) AS `__rows`{', ' if metrics else ''}{metrics} FROM {{rows}}", given)
    entries = [_entry(c, F.col(f"__m{i}"), given, F.col("__rows")) for i, c in enumerate(fused)]
    entries += [_entry(c, F.lit(None), given, F.col("__rows")) for c in broken]
    parts = [base.select(F.inline(F.array(*entries)))] if entries else []
    for check in alone:
        parts_of_key = [_escape(_quoted(c)) for c in check.columns]
        known = " AND ".join(f"{c} IS NOT NULL" for c in parts_of_key)
        text = (
            "SELECT coalesce(sum(n), 0) AS `__rows`, "
            "coalesce(sum(n) FILTER (WHERE `__known`), 0) - count_if(`__known`) AS `__m` FROM "
            f"(SELECT count(*) AS n, {known} AS `__known` FROM {{rows}} GROUP BY {', '.join(parts_of_key)})"
        )
        one = _select(df, text, given)
        parts.append(one.select(F.inline(F.array(_entry(check, F.col("__m"), given, F.col("__rows"))))))
    if expected is not None:
        parts.insert(0, structure(df, expected))
    return reduce(DataFrame.unionByName, parts)


def _resolves(df: DataFrame, check: Check, variables: Mapping[str, Any]) -> bool:
    """Whether an audit's predicate is one over the table's columns; only the plan is made."""
    if check.type != "audit":
        return True
    try:
        _select(df, f"SELECT {_escape(_metric(check))} FROM {{rows}}", variables).schema
    except (AnalysisException, ParseException):
        return False
    return True


def _differences(df: DataFrame, expected: str) -> int:
    """Columns that are missing, unexpected or of another type."""
    wanted = {f.name: f.dataType for f in StructType.fromDDL(expected)}
    found = {f.name: f.dataType for f in df.schema}
    return sum(wanted.get(name) != found.get(name) for name in {**wanted, **found})


def structure(df: DataFrame, expected: StructType | str) -> DataFrame:
    """Expected against actual columns: one row per column, metric 1 for missing, unexpected or wrong type."""
    wanted = expected if isinstance(expected, StructType) else StructType.fromDDL(expected)
    spark = df.sparkSession
    rows = [(f.name, f.dataType.simpleString()) for f in wanted]
    left = spark.createDataFrame(rows, "column_name string, expected_type string")
    both = left.join(schema_frame(df), "column_name", "full")
    problem = (
        F.when(F.col("data_type").isNull(), "missing column")
        .when(F.col("expected_type").isNull(), "unexpected column")
        .when(F.col("data_type") != F.col("expected_type"), "wrong type")
    )
    metric = problem.isNotNull().cast("double")
    return both.select(
        F.coalesce(problem, F.lit("as expected")).alias("check_name"),
        F.lit("structure").alias("check_type"),
        "column_name",
        metric.alias("metric"),
        F.lit("must_be").alias("operator"),
        F.lit(0.0).alias("threshold"),
        (metric == 0).alias("passed"),
        F.create_map().cast("map<string,double>").alias("metrics"),
    )


def totals(results: DataFrame) -> DataFrame:
    """Checks, passed and failed per verification, and whether it passed as a whole."""
    return results.groupBy("run_id", "contract", "dataset").agg(
        F.count(F.lit(1)).alias("checks_total"),
        F.count_if("passed").alias("checks_passed"),
        F.count_if(~F.col("passed")).alias("checks_failed"),
        F.every("passed").alias("passed"),
    )


def violations(
    df: DataFrame,
    expr: str,
    ts: str | None = None,
    start: str | None = None,
    end: str | None = None,
    variables: str | Mapping[str, Any] | None = None,
) -> DataFrame:
    """Rows of ``[start, end]`` that do not satisfy ``expr``; an unknown outcome is a violation."""
    from tablekit.operators.models import interval

    if ts is not None:
        df = df.where(interval(df, ts, start, end))
    text = f"SELECT * FROM {{rows}} WHERE NOT coalesce(({_escape(expr)}), false)"
    return _select(df, text, parse_variables(variables))


def audit(
    df: DataFrame, audits: Mapping[str, str], variables: str | Mapping[str, Any] | None = None
) -> DataFrame:
    """Rows that break at least one of several predicates, with ``broken``, the names of those; one scan."""
    if not audits:
        raise InvalidSpec("no audits given")
    parts = ", ".join(
        f"CASE WHEN NOT coalesce(({_escape(expr)}), false) THEN {_escape(_literal(name))} END"
        for name, expr in audits.items()
    )
    text = f"SELECT *, array_compact(array({parts})) AS broken FROM {{rows}}"
    return _select(df, text, parse_variables(variables)).where("size(broken) > 0")


def audit_counts(
    df: DataFrame, audits: Mapping[str, str], variables: str | Mapping[str, Any] | None = None
) -> DataFrame:
    """How many rows break each predicate: ``audit`` and ``violations``, zeros included; one scan."""
    checks = [Check(name, "audit", expr=expr) for name, expr in audits.items()]
    found = verify(df, checks, variables=variables)
    return found.select(F.col("check_name").alias("audit"), F.col("metric").cast("bigint").alias("violations"))


def save_results(results: DataFrame, path: str) -> None:
    """Append verification results to the history table."""
    results.write.mode("append").parquet(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHECK_RESULT).parquet(path)


def history(
    results: DataFrame, contract_prefix: str | None = None, limit: int | None = None, show_checks: bool = False
) -> DataFrame:
    """The verifications, newest first (``limit`` of them if asked for): totals, or all their check rows."""
    if contract_prefix:
        results = results.where(F.col("contract").startswith(contract_prefix))
    runs = results.groupBy("run_id", "contract").agg(
        F.max("ts").alias("ts"),
        F.every("passed").alias("passed"),
        F.count(F.lit(1)).alias("checks_total"),
        F.count_if("passed").alias("checks_passed"),
        F.count_if(~F.col("passed")).alias("checks_failed"),
    )
    newest = runs.orderBy(F.col("ts").desc(), "contract", "run_id")
    if limit is not None:
        newest = newest.limit(limit)
    if not show_checks:
        return newest
    return results.join(newest.select("run_id", "contract"), ["run_id", "contract"], "left_semi")


def suggest_checks(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Proposed ``check_spec`` rows: rows exist, given columns are never missing, keys stay unique.

    Without ``columns`` the key-like columns (as many distinct values as rows) are looked for: a
    one-pass sketch rules columns out, only the rest are counted exactly.
    """
    if columns is not None:
        unknown = [c for c in columns if c not in df.columns]
        if unknown:
            raise InvalidSpec(f"no such columns: {unknown}")
        proposed = [("missing_count", c) for c in columns]
    else:
        proposed = [(kind, c) for c in key_columns(df) for kind in ("duplicate_count", "missing_count")]
    rows = [(f"{c} {kind}", kind, c, None, "must_be", 0.0) for kind, c in proposed]
    rows.append(("row_count", "row_count", None, None, "must_be_greater_than", 0.0))
    return df.sparkSession.createDataFrame(
        rows,
        "check_name string, check_type string, column_name string, expr string, operator string, threshold double",
    )


def key_columns(df: DataFrame) -> list[str]:
    """Columns without NULLs or repeats."""
    names = [f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant", "array", "struct")]
    if not names:
        return []
    sketch = [F.count(F.lit(1)).alias("rows")]
    sketch += [F.approx_count_distinct(F.col(_quoted(c)), 0.02).alias(f"d{i}") for i, c in enumerate(names)]
    sketch += [F.count(F.col(_quoted(c))).alias(f"n{i}") for i, c in enumerate(names)]
    seen = df.agg(*sketch).first()
    # Ten standard errors: a true key is never ruled out.
    likely = [
        c for i, c in enumerate(names) if seen.rows and seen[f"n{i}"] == seen.rows and seen[f"d{i}"] >= 0.8 * seen.rows
    ]
    if not likely:
        return []
    counts = {r.column_name: r.distinct_count for r in exact_distinct(df, likely).collect()}
    return [c for c in likely if counts[c] == seen.rows]
