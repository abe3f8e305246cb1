from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tablekit.errors import InvalidSpec
from tablekit.operators import edges, models
from tablekit.operators.runs import RunLog
from tests.conftest import rows

D = date


@pytest.fixture
def model(spark, tmp_path):
    """One row per 8 hours of January 2024, kept in a table the test may rewrite."""
    path = str(tmp_path / "source")
    spark.range(93).selectExpr("id", "TIMESTAMP_NTZ '2024-01-01' + make_interval(0, 0, 0, 0, int(id) * 8) AS ts").write.parquet(path)

    def query(session, start, end):
        source = session.read.parquet(path)
        kept = source.where(models.interval(source, "ts", start, end))
        return kept.groupBy(F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))

    return models.Model("m", query)


def test_interval_includes_both_days(spark, model):
    got = rows(models.evaluate(spark, model, "2024-01-02", "2024-01-03"))
    assert got == [(D(2024, 1, 2), 3), (D(2024, 1, 3), 3)]
    assert models.evaluate(spark, model, "2024-01-01", "2024-01-31", limit=4).count() == 4
    with pytest.raises(InvalidSpec):
        models.evaluate(spark, model, "2024-01-03", "2024-01-02")


def test_interval_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01' AS ts").write.parquet(path)
    df = spark.read.parquet(path)
    plan = df.where(models.interval(df, "ts", "2024-01-01", "2024-01-02"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_rerun_drops_days_that_became_empty(spark, model, table, tmp_path):
    path = str(tmp_path / table)
    models.run(spark, model, "2024-01-01", "2024-01-05", table, path)
    thinner = models.Model("m", lambda s, a, b: model.query(s, a, b).where("day <> DATE '2024-01-03'"))
    models.run(spark, thinner, "2024-01-02", "2024-01-04", table, path)
    assert [r[0].day for r in rows(spark.table(table), "day")] == [1, 2, 4, 5]
    log = RunLog(spark, str(tmp_path / "log"))
    models.run(spark, thinner, "2024-01-07", "2024-01-07", table, path, log=log)
    assert [r[0].day for r in rows(spark.table(table), "day")] == [1, 2, 4, 5, 7]
    wild = models.Model("m", lambda s, a, b: model.query(s, None, None))
    written = models.run(spark, wild, "2024-01-08", "2024-01-08", table, path, log=log)
    assert written == 1 and written.outside == 30
    assert models.run(spark, wild, "2024-01-08", "2024-01-08", table, path).outside == 30
    assert any("30 rows outside" in line for r in log.read().collect() for line in r.logs or ())


def log_frame(spark, *intervals):
    data = [(m, D.fromisoformat(a), D.fromisoformat(b), "r", None) for m, a, b in intervals]
    return spark.createDataFrame(data, models.INTERVAL_LOG)


def test_gaps_and_ranges(spark):
    log = log_frame(
        spark,
        ("a", "2024-01-03", "2024-01-04"), ("a", "2024-01-04", "2024-01-05"), ("a", "2024-01-08", "2024-02-09"),
        ("b", "2023-01-01", "2024-12-31"), ("c", "2022-01-01", "2022-01-02"), ("a", "2024-01-07", "2024-01-06"),
    )
    gaps = models.missing_days(log, "2024-01-01", "2024-01-10")
    ranges = models.day_ranges(gaps)
    assert rows(ranges) == [
        ("a", D(2024, 1, 1), D(2024, 1, 2), 2),
        ("a", D(2024, 1, 6), D(2024, 1, 7), 2),
        ("c", D(2024, 1, 1), D(2024, 1, 10), 10),
    ]
    asked = models.missing_days(log, "2024-01-01", "2024-01-10", ["b", "new"])
    assert {r.model for r in asked.collect()} == {"new"} and asked.count() == 10


def test_backfill_fills_exactly_the_gaps(spark, model, table, tmp_path):
    path = str(tmp_path / table)
    log = models.IntervalLog(spark, f"{path}-log")
    assert log.read().isEmpty()
    models.run(spark, model, "2024-01-04", "2024-01-06", table, path, log)
    done = models.backfill(spark, model, "2024-01-02", "2024-01-09", table, log, path)
    assert done == [(D(2024, 1, 2), D(2024, 1, 3)), (D(2024, 1, 7), D(2024, 1, 9))]
    assert [r[0].day for r in rows(spark.table(table), "day")] == list(range(2, 10))
    assert models.backfill(spark, model, "2024-01-02", "2024-01-09", table, log, path) == []
    assert models.missing_days(log.read(), "2024-01-02", "2024-01-09").isEmpty()


def edge_frame(spark, *pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def test_closure_of_a_chain(spark):
    n = 14
    chain = edge_frame(spark, *[(f"n{i:02}", f"n{i + 1:02}") for i in range(n - 1)])
    down = edges.closure(chain, direction="downstream", max_depth=n)
    with pytest.raises(InvalidSpec):
        edges.closure(chain)
    assert down.count() == n * (n - 1) // 2
    assert down.where("node = 'n00' AND related = 'n13'").first().depth == 13
    assert edges.closure(chain, direction="downstream", max_depth=2).agg(F.max("depth")).first()[0] == 2


def test_closure_of_cycles_diamonds_and_loops(spark):
    graph = edge_frame(spark, ("a", "b"), ("b", "c"), ("c", "a"), ("a", "a"), ("c", "d"), ("b", "d"), ("b", "d"), ("x", "y"))
    got = rows(edges.closure(graph, ["a"]), "related", "direction", "depth")
    assert got == [("b", "downstream", 1), ("b", "upstream", 2), ("c", "downstream", 2), ("c", "upstream", 1),
                   ("d", "downstream", 2)]
    both = edges.closure(graph, max_depth=10)
    assert both.where("direction = 'upstream'").count() == both.where("direction = 'downstream'").count()
    assert edges.closure(graph, ["nobody"]).isEmpty()
    with pytest.raises(InvalidSpec):
        edges.closure(graph, direction="sideways")


def test_neighbors(spark):
    graph = edge_frame(spark, ("a", "c"), ("b", "c"), ("b", "c"), ("c", "d"))
    assert rows(edges.neighbors(graph)) == [("c", "a", 2), ("c", "b", 2), ("d", "c", 1)]
    assert rows(edges.neighbors(graph, "d")) == [("d", "c", 1)]
    assert rows(edges.neighbors(graph, "zz")) == []


def _distances(pairs, start):
    found, frontier, depth = {start: 0}, {start}, 0
    while frontier:
        depth += 1
        frontier = {b for a, b in pairs if a in frontier and b not in found}
        found |= {n: depth for n in frontier}
    return {n: d for n, d in found.items() if d}


def test_closure_of_long_paths_and_cycles(spark, monkeypatch):
    rounds = []
    written = edges.materialize
    monkeypatch.setattr(edges, "materialize", lambda df, label: (rounds.append(label), written(df, label))[1])
    chain = spark.range(10_000).selectExpr("string(id) AS src", "string(id + 1) AS dst")
    got = edges.closure(chain, ["0"], "downstream")
    assert got.count() == 10_000 and got.where("depth <> int(related)").isEmpty()
    assert rounds.count("reach") <= 20
    ring = spark.range(300).selectExpr("string(id) AS src", "string((id + 1) % 300) AS dst")
    assert edges.closure(ring, ["7"], "upstream").agg(F.max("depth"), F.count("*")).first()[:] == (299, 299)


def test_closure_distances_in_bushy_graphs(spark):
    import random

    for seed, (n, m) in enumerate([(40, 60), (30, 200), (60, 62)]):
        rnd = random.Random(seed)
        pairs = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)] + [(100 + i, 101 + i) for i in range(30)] + [(0, 100)]
        frame = spark.createDataFrame([(str(a), str(b)) for a, b in pairs], "src string, dst string")
        real = [(a, b) for a, b in pairs if a != b]
        for start in (0, 105)[seed % 2 :][:1]:
            got = {int(r.related): r.depth for r in edges.closure(frame, [str(start)], "downstream").collect()}
            assert got == _distances(real, start)
            near = {int(r.related): r.depth for r in edges.closure(frame, [str(start)], "downstream", 7).collect()}
            assert near == {k: d for k, d in got.items() if d <= 7}
            back = {int(r.related): r.depth for r in edges.closure(frame, [str(start)], "upstream").collect()}
            assert back == _distances([(b, a) for a, b in real], start)

