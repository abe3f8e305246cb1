"""Split windows and joins against Spark's plain ones, on skewed keys, ties and NULLs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablekit.plans import joins, order, windows
from tests.conftest import rows

SCHEMA = "id int, k string, ts int, v double"


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has one key; NULL keys, NULL values and many equal values occur."""
    rng = random.Random(5)
    data = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        value = None if rng.random() < 0.05 else float(rng.choice([1, 2, 3, rng.randint(0, 400)]))
        data.append((i, key, rng.randint(0, 300), value))
    return spark.createDataFrame(data, SCHEMA).cache()


def by_ts():
    return [F.floor(F.col("ts") / 20)]


def test_row_numbers(skewed):
    order = [F.col("ts"), F.col("id")]
    got = windows.row_numbers(skewed, ["k"], order, by_ts(), size="n")
    plain = Window.partitionBy("k").orderBy(*order)
    want = skewed.withColumn("row_number", F.row_number().over(plain)).withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy("k"))
    )
    assert rows(got, "id", "row_number", "n") == rows(want, "id", "row_number", "n")


def test_position_in_whole_table(skewed):
    order = [F.col("ts"), F.col("id")]
    got = windows.row_numbers(skewed, [], order, by_ts(), name="p")
    want = skewed.withColumn("p", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)))
    assert rows(got, "id", "p") == rows(want, "id", "p")


@pytest.mark.parametrize("n", [1, 3, 4, 7, 500])
def test_tiles(skewed, n):
    order = [F.col("ts"), F.col("id")]
    numbered = windows.row_numbers(skewed, ["k"], order, by_ts(), size="n")
    got = numbered.select("id", windows.tiles(F.col("row_number"), F.col("n"), n).alias("t"))
    want = skewed.select("id", F.ntile(n).over(Window.partitionBy("k").orderBy(*order)).alias("t"))
    assert rows(got) == rows(want)


def test_value_ranks(skewed):
    got = windows.value_ranks(skewed, ["k"], "v", [F.floor(F.col("v") / 10)])
    w = Window.partitionBy("k").orderBy("v")
    want = skewed.select(
        "id", F.rank().over(w).alias("rank"), F.dense_rank().over(w).alias("dense_rank"),
        F.percent_rank().over(w).alias("percent_rank"), F.cume_dist().over(w).alias("cume_dist"),
    )
    assert rows(got, "id", "rank", "dense_rank", "percent_rank", "cume_dist") == rows(want)


def test_positions_and_rankings(skewed):
    along = [F.col("ts"), F.col("id")]
    got = order.positions(skewed, ["k"], along, size="n")
    w = Window.partitionBy("k")
    want = skewed.select("id", F.row_number().over(w.orderBy(*along)).alias("row_number"), F.count(F.lit(1)).over(w).alias("n"))
    assert rows(got, "id", "row_number", "n") == rows(want)
    whole = order.positions(skewed, [], [F.col("v").desc_nulls_last(), F.col("id")], "p")
    by_value = Window.partitionBy(F.lit(1)).orderBy(F.col("v").desc_nulls_last(), "id")
    assert rows(whole, "id", "p") == rows(skewed.select("id", F.row_number().over(by_value).alias("p")))
    ranked = order.rankings(skewed, ["k"], "v", ["id"])
    v = w.orderBy("v")
    want = skewed.select(
        "id", F.row_number().over(w.orderBy("v", "id")).alias("row_number"), F.rank().over(v).alias("rank"),
        F.dense_rank().over(v).alias("dense_rank"), F.percent_rank().over(v).alias("percent_rank"),
        F.cume_dist().over(v).alias("cume_dist"),
    )
    assert rows(ranked, *want.columns) == rows(want)
    assert order.rankings(skewed.limit(0), ["k"], "v").count() == 0


def test_rankings_read_twice_and_shuffle_little(skewed):
    """What is left to do once positions are written: two scans, and no task that gathers all rows."""
    plan = _plan(order.rankings(skewed, ["k"], "v", ["id"]))
    plan = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert plan.count("FileScan parquet") == 2 and plan.count("Exchange") <= 4 and "SinglePartition" not in plan


def test_quantiles(skewed):
    asked = {"a": 0.0, "b": 0.31, "c": 0.5, "d": 1.0}
    digits = [F.round(c, 9).alias(c) for c in asked]
    exact = [F.expr(f"percentile_cont({p}) WITHIN GROUP (ORDER BY v)").alias(n) for n, p in asked.items()]
    known = skewed.where("v IS NOT NULL")
    got = order.quantiles(skewed, ["k"], "v", asked).select("k", *digits)
    assert rows(got) == rows(known.groupBy("k").agg(*exact).select("k", *digits))
    assert rows(order.quantiles(skewed, [], "v", asked).select(*digits)) == rows(known.agg(*exact).select(*digits))


def test_running_sum(skewed):
    order = [F.col("ts"), F.col("id")]
    got = windows.running_sum(skewed, ["k"], order, by_ts(), F.col("v"), "s")
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    assert rows(got, "id", "s") == rows(skewed.withColumn("s", F.sum("v").over(w)), "id", "s")


def test_neighbours(skewed):
    got = windows.neighbours(skewed, ["k"], ["ts", "id"], by_ts(), "v")
    w = Window.partitionBy("k").orderBy("ts", "id")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    want = skewed.select(
        "id", F.lag("v").over(w).alias("lag"), F.lead("v").over(w).alias("lead"),
        F.first("v").over(whole).alias("first_value"), F.last("v").over(whole).alias("last_value"),
    )
    assert rows(got, "id", "lag", "lead", "first_value", "last_value") == rows(want)


def test_exact_quantiles(skewed):
    got = windows.exact_quantiles(skewed, ["k"], "v", {"a": 0.0, "b": 0.31, "c": 0.5, "d": 1.0}, [F.floor("v")])
    want = skewed.groupBy("k").agg(
        *[F.expr(f"percentile_cont({p}) WITHIN GROUP (ORDER BY v)").alias(n)
          for n, p in {"a": 0.0, "b": 0.31, "c": 0.5, "d": 1.0}.items()]
    )
    digits = [F.round(c, 9).alias(c) for c in "abcd"]
    assert rows(got.select("k", *digits)) == rows(want.select("k", *digits))


def test_exact_mode_takes_smallest_on_ties(spark):
    df = spark.createDataFrame([("x", 2), ("x", 2), ("x", 1), ("x", 1), ("y", 5), ("y", None)], "k string, v int")
    assert rows(windows.exact_mode(df, ["k"], "v")) == [("x", 1), ("y", 5)]


def test_asof_against_brute_force(spark, skewed):
    left = skewed.where("id % 2 = 0").select("k", "ts", "id")
    right = skewed.where("id % 2 = 1").select("k", "ts", F.col("id").alias("rid"), "v")
    got = joins.asof_join(left, right, ["k"], "ts", ["rid", "v"], F.floor(F.col("ts") / 20), tie="rid")
    rights = right.collect()
    want = []
    for r in left.collect():
        before = [q for q in rights if r.k is not None and q.k == r.k and q.ts <= r.ts]
        best = max(before, key=lambda q: (q.ts, q.rid)) if before else None
        want.append((r.id, best.rid if best else None, best.v if best else None))
    assert rows(got, "id", "rid", "v") == rows(spark.createDataFrame(want, "id int, rid int, v double"))


@pytest.mark.parametrize("split", [10, 1_000_000])
def test_range_join_against_brute_force(spark, skewed, split):
    """Intervals from one value to everything; a hot value's cell is split."""
    nan, inf = float("nan"), float("inf")
    bands = [("p", 0.0, 3.0), ("q", 2.5, 120.0), ("r", 120.0, 120.0), ("s", 50.0, 40.0), ("t", -5.0, 900.0), ("u", -inf, inf)]
    bands += [("v", 3.0, 3.01), ("w", 500.0, 600.0), ("x", -9.0, -1.0), ("y", None, 5.0), ("z", 1.0, None)]
    bands += [(f"b{i}", float(i * 7), float(i * 7 + i)) for i in range(40)]
    intervals = spark.createDataFrame(bands, "name string, lo double, hi double")
    points = skewed.unionByName(spark.createDataFrame([(-1, "a", 0, nan), (-2, "a", 0, inf), (-3, "a", 0, -inf)], SCHEMA))
    got = joins.range_join(points, intervals, "v", "lo", "hi", split_rows=split)
    known = lambda v: v is not None and v == v
    want = [(r.id, n) for r in points.collect() for n, lo, hi in bands if known(r.v) and known(lo) and known(hi) and lo <= r.v <= hi]
    assert rows(got, "id", "name") == sorted(want, key=lambda p: (str(p[0]), p[1]))
    keyed = intervals.withColumn("k", F.lit("hot"))
    by_key = joins.range_join(points, keyed, "v", "lo", "hi", ["k"], split)
    hot = {r.id for r in points.where("k = 'hot'").collect()}
    assert rows(by_key, "id", "name") == [p for p in sorted(want, key=lambda p: (str(p[0]), p[1])) if p[0] in hot]
    assert joins.range_join(points.limit(0), intervals, "v", "lo", "hi").count() == 0
    assert joins.range_join(points, intervals.limit(0), "v", "lo", "hi").count() == 0


def test_range_join_over_times(spark):
    days = spark.sql("SELECT id, DATE '2024-01-01' + int(id) AS d FROM range(40)")
    spans = spark.sql("SELECT 'a' AS n, DATE '2024-01-03' AS lo, DATE '2024-01-05' AS hi UNION ALL SELECT 'b', DATE '2023-01-01', DATE '2024-01-02'")
    want = [(0, "b"), (1, "b"), (2, "a"), (3, "a"), (4, "a")]
    assert rows(joins.range_join(days, spans, "d", "lo", "hi"), "id", "n") == want
    stamped = days.withColumn("d", F.col("d").cast("timestamp_ntz"))
    ntz = spans.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("lo", "hi")})
    assert rows(joins.range_join(stamped, ntz, "d", "lo", "hi"), "id", "n") == want


def test_cover_is_exact_and_small(spark):
    cells = spark.range(64).withColumnRenamed("id", "a").crossJoin(spark.range(64).withColumnRenamed("id", "b")).where("a <= b")
    covered = cells.withColumn("c", joins.cover(F.col("a"), F.col("b"), 3))
    assert covered.agg(F.max(F.size("c"))).first()[0] <= 6 * 3
    for r in covered.collect():
        sizes = [(n.node, joins.FAN**n.level) for n in r.c]
        leaves = [leaf for node, size in sizes for leaf in range(node * size, (node + 1) * size)]
        assert sorted(leaves) == list(range(r.a, r.b + 1))


def test_not_in_null_rules(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    full, holed = [(1,), (3,)], [(1,), (None,)]
    assert rows(joins.not_in(left, spark.createDataFrame(full, "b int"), "a", "b")) == [(2,)]
    assert rows(joins.not_in(left, spark.createDataFrame(holed, "b int"), "a", "b")) == []
    assert rows(joins.not_in(left, spark.createDataFrame([], "b int"), "a", "b")) == [(None,), (1,), (2,)]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_shuffled_once(spark, skewed):
    """The join with the summary reuses the window's partitioning."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = windows.row_numbers(skewed, ["k"], [F.col("ts"), F.col("id")], by_ts())
        plan = _plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rows_side = plan[plan.index("SortMergeJoin") : plan.rindex("SortMergeJoin") + len(plan)]
    # Rows: one exchange. Summary: grouped, windowed by key, sent to the join.
    assert rows_side.count("Exchange hashpartitioning") == 4
