"""Time the headline queries on warm Spark and print one JSON line.

BENCH_SF_DIR: folder of parquet tables; BENCH_CPUS: local cores; BENCH_DUCKDB=1 also times the
same SQL on DuckDB (reported under "duckdb").
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tablekit.session import build_session
from tablekit.suite import CASES

HEADLINE = (
    "verify_contract", "check_duplicate", "load_merge", "load_merge_partitioned", "model_run", "tail_per_group",
    "join_inner", "join_asof", "join_range", "agg_group", "agg_cube", "agg_distinct", "agg_quantile", "win_rank",
    "win_analytic", "win_range", "edge_closure", "column_profile", "table_diff", "stream_daily",
)
RUNS = 3


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        build = CASES[name].build

        def run(build=build):
            build(spark, sf).write.format("noop").mode("overwrite").save()

        run()
        seconds[name] = round(statistics.median(timed(run) for _ in range(RUNS)), 3)
    result = {
        "metric": "headline queries, warm median of 3",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    if os.environ.get("BENCH_DUCKDB"):
        from tests.oracle import connect

        con = connect(sf)
        con.execute(f"SET threads = {cpus}")
        peers = {}
        for name in HEADLINE:
            sql = CASES[name].oracle

            def run_sql(sql=sql):
                con.sql(sql).fetchall()

            run_sql()
            peers[name] = round(statistics.median(timed(run_sql) for _ in range(RUNS)), 3)
        result["duckdb"] = peers
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
