from __future__ import annotations

import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablekit.errors import InvalidSpec, SchemaConflict
from tablekit.operators import diff, history
from tests.conftest import rows

SCHEMA = "k string, ts timestamp_ntz, v int, gone boolean"


def at(n):
    return datetime(2024, 1, 1) + timedelta(days=n)


def changes(seed, n=60):
    rnd = random.Random(seed)
    keys = ["hot"] * 5 + ["a", "b", None]
    return [(rnd.choice(keys), at(rnd.randrange(90)), rnd.choice([1, 2, None]), rnd.choice([True, False, False, None])) for _ in range(n)]


def linked(given):
    best = {}
    for k, ts, v, gone in given:
        row = (bool(gone), v is not None, v or 0)
        best[k, ts] = max(best.get((k, ts), row), row)
    out = []
    for k in {k for k, _ in best}:
        times = sorted(ts for key, ts in best if key == k)
        for ts, until in zip(times, [*times[1:], None]):
            gone, known, v = best[k, ts]
            out.append((k, ts, until, gone, v if known else None))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or "", r[1]))


def got(df):
    picked = df.select("k", "valid_from", "valid_to", "is_deleted", "v").collect()
    return sorted(map(tuple, picked), key=lambda r: (r[0] is not None, r[0] or "", r[1]))


@pytest.mark.parametrize("buckets", [0, 4])
def test_any_order_of_batches_gives_one_history(spark, tmp_path, buckets):
    batches = [changes(s) for s in range(3)]
    want = linked(itertools.chain(*batches))
    for n, order in enumerate([(0, 1, 2), (2, 0, 1, 2)]):
        table = f"t_history_{buckets}_{n}"
        for b in order:
            history.merge(spark, spark.createDataFrame(batches[b], SCHEMA), table, ["k"], "ts", "gone", str(tmp_path / table), buckets)
        assert got(spark.table(table)) == want
        past = history.as_of(spark.table(table), at(40)).select("k", "v")
        alive = sorted((str(k), str(v)) for k, a, b, gone, v in want if a <= at(40) and (b is None or b > at(40)) and not gone)
        assert sorted((str(r.k), str(r.v)) for r in past.collect()) == alive
        assert history.as_of(spark.table(table)).count() == sum(b is None and not gone for _, _, b, gone, _ in want)


def test_history_touches_its_buckets_only_and_takes_new_columns(spark, table, tmp_path):
    make = lambda data, schema=SCHEMA: spark.createDataFrame(data, schema)
    path = str(tmp_path / table)
    first = make([(f"k{i}", at(1), i, False) for i in range(40)])
    assert history.merge(spark, first, table, ["k"], "ts", "gone", path, 8) == 40
    before = set(spark.table(table).inputFiles())
    history.merge(spark, make([("k1", at(0), 7, False)]), table, ["k"], "ts", "gone", path, 8)
    after = set(spark.table(table).inputFiles())
    assert len(before & after) == len(before) - 1 and spark.table(table).count() == 41
    assert history.merge(spark, make([]), table, ["k"], "ts", "gone", path, 8) == 0
    history.merge(spark, make([("k2", at(5), 1, False, "x")], SCHEMA + ", more string"), table, ["k"], "ts", "gone", path, 8)
    assert rows(spark.table(table).where("k = 'k2'"), "v", "more") == [(1, "x"), (2, None)]
    for bad in (first.withColumn("ts", F.lit(None).cast("timestamp_ntz")), first.withColumn("valid_to", F.lit(1))):
        with pytest.raises(InvalidSpec):
            history.merge(spark, bad, table, ["k"], "ts", "gone", path, 8)
    with pytest.raises(InvalidSpec):
        history.merge(spark, first, table, ["k"], "ts", "gone", path)


def test_diff_by_segments(spark, tmp_path):
    base = spark.range(0, 200_000, 1, 8).selectExpr("id AS k", "id % 7 AS a", "IF(id % 11 = 0, NULL, id % 5) AS b")
    changed = base.where("k <> 150000").withColumn("a", F.when(F.col("k") == 70_001, -1).otherwise(F.col("a")))
    changed = changed.withColumn("b", F.when(F.col("k").isin(70_001, 70_002), 9).otherwise(F.col("b")))
    changed = changed.unionByName(spark.range(1).selectExpr("999999 AS k", "1L AS a", "1L AS b"))
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    base.write.parquet(one)
    changed.repartitionByRange(8, "k").sortWithinPartitions("k").write.parquet(two)
    left, right = spark.read.parquet(one), spark.read.parquet(two)
    assert diff.differing(left, left, ["k"]) == [] and diff.diff_keys(left, left, ["k"]).isEmpty()
    segments = diff.differing(left, right, ["k"], 100)
    assert sum(s.rows for s in segments) < 1000
    inside = lambda k: any(s.low <= k <= s.high for s in segments)
    assert all(inside(k) for k in (70_001, 70_002, 150_000, 999_999))
    found = diff.diff_keys(left, right, ["k"], 100)
    assert [(r.k, r["diff"], r.columns) for r in found.orderBy("k").collect()] == [
        (70_001, "changed", ["a", "b"]), (70_002, "changed", ["b"]), (150_000, "missing", []), (999_999, "extra", []),
    ]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [Or(") == 2 and "GreaterThanOrEqual(k," in plan
    # Rows of equal segments never reach a shuffle: what is joined is what the ranges hold.
    assert sum(diff._within(df, F.col("k"), segments).count() for df in (left, right)) == sum(s.rows for s in segments)


def test_diff_with_null_and_repeated_keys(spark):
    schema = "k int, j string, v double"
    left = [(1, "a", 1.0), (None, "a", 1.0), (2, "x", 1.0), (2, "x", 2.0), (3, None, None), (4, "z", 1.0), (4, "z", 1.0)]
    right = [(1, "a", 1.0), (None, "a", 2.0), (2, "x", 1.0), (2, "x", 1.0), (3, None, 0.0), (4, "z", 1.0), (4, "z", 1.0), (None, None, 1.0)]
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    want = [(None, None, "extra", ""), (None, "a", "changed", "v"), (2, "x", "ambiguous", ""), (3, None, "changed", "v")]
    for keys in (["k", "j"], ["j", "k"]):
        found = diff.diff_keys(a, b, keys).withColumn("columns", F.concat_ws(",", "columns"))
        assert rows(found, "k", "j", "diff", "columns") == want
    assert diff.diff_keys(a.limit(0), a.limit(0), ["k", "j"]).isEmpty()
    assert {r["diff"] for r in diff.diff_keys(a.limit(0), a.where("k = 1"), ["k"]).collect()} == {"extra"}
    with pytest.raises(SchemaConflict):
        diff.diff_keys(a, b.drop("v"), ["k"])
    with pytest.raises(InvalidSpec):
        diff.differing(a, b, ["j"])
