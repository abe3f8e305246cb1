"""Compare registered queries with their SQL on DuckDB.

Run ``python -m tests.oracle [sf] [name ...]`` for a report with timings.
"""

from __future__ import annotations

import math
import sys
import time
import traceback
from collections import Counter

import duckdb
import pandas as pd

from tablekit.session import build_session
from tablekit.suite.registry import CASES, TABLES, table_path


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{table_path(sf, table)}')")
    return con


def _cell(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return repr(round(value, 9) + 0.0)
    if isinstance(value, pd.Timestamp) or hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return str(value)


def _rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


# What a DuckDB type is called in Spark.
_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "FLOAT": "float", "TINYINT": "tinyint", "SMALLINT": "smallint",
}


def compare(spark, con, name: str, sf: str) -> list[str]:
    """Differences between a query and its SQL; empty if they agree."""
    case = CASES[name]
    df = case.build(spark, sf)
    got = df.collect()
    if case.oracle is None:
        return [] if got else ["no rows"]
    relation = con.sql(case.oracle)
    problems = []
    if sorted(df.columns) != sorted(relation.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(relation.columns)}"]
    expected_types = {c: _TYPES.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    for field in df.schema:
        if field.dataType.simpleString() != expected_types[field.name]:
            problems.append(f"type of {field.name}: {field.dataType.simpleString()} vs {expected_types[field.name]}")
    mine, theirs = _rows(df.columns, got), _rows(relation.columns, relation.fetchall())
    if len(mine) != len(theirs):
        problems.append(f"rows {len(mine)} vs {len(theirs)}")
    if mine != theirs:
        left, right = Counter(mine), Counter(theirs)
        extra, missing = sorted(left - right)[:3], sorted(right - left)[:3]
        problems.append(f"{sorted(df.columns)}\n    only spark: {extra}\n    only sql:   {missing}")
    return problems


def main() -> None:
    sf = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    import tablekit.suite  # noqa: F401

    names = sys.argv[2:] or list(CASES)
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problems = compare(spark, con, name, sf)
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
            if len(names) <= 3:
                traceback.print_exc()
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s", *problems, sep="\n  ", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
