from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablekit.errors import InvalidSpec
from tablekit.operators import intervals, models, plan, slots
from tests.conftest import rows

ZERO = datetime(2024, 1, 30)
SCHEMA = "k string, start timestamp_ntz, end timestamp_ntz"


def hours(n):
    return ZERO + timedelta(hours=n)


def some(seed, n=150, span=1200):
    """Intervals of whole hours over two months: a hot key, a NULL key, empty and backward ones."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        at = rnd.randrange(span)
        out.append((rnd.choice(["hot"] * 6 + ["a", "b", None]), hours(at), hours(at + rnd.choice([-2, 0, 1, 1, 2, 5, 30]))))
    return out + [("hot", hours(10), None), ("long", hours(0), hours(span + 900)), ("long", hours(700), hours(701))]


def covered(given):
    """Hours covered per key."""
    out = {}
    for k, start, end in given:
        if end is not None:
            first, last = (int((t - ZERO).total_seconds() // 3600) for t in (start, end))
            out.setdefault(k, set()).update(range(first, last))
    return out


def spans(cover):
    found = []
    for k, own in cover.items():
        for h in sorted(own):
            if h - 1 not in own:
                found.append([k, hours(h), hours(h + 1)])
            else:
                found[-1][2] = hours(h + 1)
    return sorted(map(tuple, found), key=lambda r: (r[0] is not None, r[0] or "", r[1]))


def got(df):
    return sorted((tuple(r) for r in df.select("k", "start", "end").collect()), key=lambda r: (r[0] is not None, r[0] or "", r[1]))


@pytest.mark.parametrize("seed", [1, 2])
def test_sets_of_intervals(spark, seed):
    left, right = some(seed), some(seed + 10, 60)
    a, b = (spark.createDataFrame(x, SCHEMA) for x in (left, right))
    one, two = covered(left), covered(right)
    assert got(intervals.merge(a, ["k"])) == spans(one)
    assert got(intervals.subtract(a, b, ["k"])) == spans({k: own - two.get(k, set()) for k, own in one.items()})
    assert got(intervals.intersect(a, b, ["k"])) == spans({k: own & two.get(k, set()) for k, own in one.items()})
    none = a.limit(0)
    assert got(intervals.merge(none, ["k"])) == [] == got(intervals.subtract(none, b, ["k"]))
    assert got(intervals.subtract(a, none, ["k"])) == spans(one)
    whole = intervals.merge(a.drop("k"), [])
    assert whole.count() == len(spans({None: set().union(*one.values())}))


def test_alignment_and_slots(spark):
    at = datetime.fromisoformat
    df = spark.createDataFrame(
        [("x", at("2024-01-15 10:30:00"), at("2024-03-01 00:00:00")), ("y", at("2024-02-01 00:00:00"), at("2024-02-01 00:00:00"))], SCHEMA
    )
    assert got(intervals.align(df, "month")) == [("x", at("2024-01-01"), at("2024-03-01"))]
    assert got(intervals.align(df, "month", inward=True)) == [("x", at("2024-02-01"), at("2024-03-01"))]
    assert got(intervals.align(df, "hour")) == [("x", at("2024-01-15 10:00:00"), at("2024-03-01"))]
    assert [r.slot for r in intervals.slots(df, "month").orderBy("slot").collect()] == [at("2024-01-01"), at("2024-02-01")]
    with pytest.raises(InvalidSpec):
        intervals.align(df, "week")


def test_slots_are_replaced_and_dropped(spark, table, tmp_path):
    kept = {h: 1 for h in range(0, 60)}

    def query(session, start, end):
        data = [(hours(h), h) for h in kept if start <= hours(h) < end] + [(hours(500), 0)]
        return session.createDataFrame(data, "ts timestamp_ntz, n int")

    model, path = slots.SlotModel("m", query), str(tmp_path / table)
    log = slots.LoadLog(spark, str(tmp_path / "log"))
    done = slots.run_slots(spark, model, hours(0), hours(10) + timedelta(minutes=5), table, path, log)
    assert done == 11 and done.outside == 1
    del kept[4]
    slots.run_slots(spark, model, hours(3), hours(6), table, path, log)
    assert sorted(r.n for r in spark.table(table).collect()) == [0, 1, 2, 3, 5, 6, 7, 8, 9, 10]
    assert rows(spark.table(table).where("n = 5"), "slot") == [("2024-01-30T05",)]
    assert slots.backfill_slots(spark, model, hours(8), hours(13), table, log, path) == [(hours(11), hours(13))]
    assert slots.backfill_slots(spark, model, hours(0), hours(13), table, log, path) == []
    with pytest.raises(InvalidSpec):
        slots.run_slots(spark, model, hours(3), hours(3), table, path)


def test_keys_are_replaced_and_dropped(spark, table, tmp_path):
    held = {"a": 1, "b/c d+e=f": 2, "z": 3}
    model = slots.KeyedModel("m", lambda s, keys: s.createDataFrame([(v, k) for k, v in held.items()], "v int, key string"))
    path, log = str(tmp_path / table), slots.LoadLog(spark, str(tmp_path / "log"), slots.KEY_LOG)
    assert slots.run_keys(spark, model, ["a", "b/c d+e=f"], table, path, log).outside == 1
    del held["b/c d+e=f"]
    slots.run_keys(spark, model, ["b/c d+e=f"], table, path, log)
    assert rows(spark.table(table), "key", "v") == [("a", 1)]
    assert slots.backfill_keys(spark, model, ["z", "a", "none"], table, log, path) == ["z", "none"]
    assert slots.backfill_keys(spark, model, ["z", "a", "none"], table, log, path) == []
    assert rows(spark.table(table), "key", "v") == [("a", 1), ("z", 3)]


EDGES = [("a", "b"), ("b", "c"), ("a", "c"), ("x", "c"), ("c", "d"), ("a", "b")]


def test_levels(spark):
    edges = spark.createDataFrame(EDGES, "src string, dst string")
    extra = spark.createDataFrame([("alone",), ("a",)], "node string")
    assert rows(plan.levels(edges, extra)) == [("a", 0), ("alone", 0), ("b", 1), ("c", 2), ("d", 3), ("x", 0)]
    assert plan.levels(edges.limit(0)).count() == 0
    with pytest.raises(plan.CycleFound, match="'b', 'c', 'd'"):
        plan.levels(edges.unionByName(spark.createDataFrame([("d", "b")], "src string, dst string")))
    with pytest.raises(plan.CycleFound):
        plan.levels(spark.createDataFrame([("s", "s")], "src string, dst string"))


def test_selections(spark):
    edges = spark.createDataFrame(EDGES, "src string, dst string")
    chosen = lambda text: "".join(sorted(plan.select(edges, list("abcdx"), text)))
    assert (chosen("*"), chosen("b"), chosen("+b"), chosen("b+"), chosen("+b+, x")) == ("abcdx", "b", "ab", "bcd", "abcdx")
    with pytest.raises(InvalidSpec):
        chosen("q+")


class Failing(Exception):
    pass


def test_plans_pass_days_down_and_survive_a_failure(spark, tmp_path):
    fail, source = {"on": False}, {"offset": 0}

    def top(session, start, end):
        offset = source["offset"]
        return session.range((end - start).days + 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"), (F.col("id") * 0 + offset).alias("v")).select("v", "day")

    def below(session, start, end):
        if fail["on"]:
            raise Failing
        own = session.table("t_plan_top")
        return own.where(models.interval(own, "day", start, end)).select((F.col("v") + 1).alias("v"), "day")

    nodes = [
        plan.Node(models.Model("below", below), "t_plan_below", ("top", "a table from elsewhere"), 1, str(tmp_path / "below")),
        plan.Node(models.Model("top", top), "t_plan_top", (), 0, str(tmp_path / "top")),
    ]
    log = models.IntervalLog(spark, str(tmp_path / "log"))
    steps = plan.apply(spark, nodes, "2024-01-01", "2024-01-10", log)
    assert [(s.level, s.model, s.start.day, s.end.day) for s in steps] == [(0, "top", 1, 10), (1, "below", 1, 10)]
    assert plan.apply(spark, nodes, "2024-01-01", "2024-01-10", log) == []
    source["offset"], fail["on"] = 5, True
    log.forget("top", [(date(2024, 1, 3), date(2024, 1, 4)), (date(2024, 1, 10), date(2024, 1, 10))])
    with pytest.raises(Failing):
        plan.apply(spark, nodes, "2024-01-01", "2024-01-10", log, "top+")
    fail["on"] = False
    # What the finished jobs made stale is still known: those days and the ones after them.
    steps = plan.apply(spark, nodes, "2024-01-01", "2024-01-10", log)
    assert [(s.model, s.start.day, s.end.day) for s in steps] == [("below", 3, 5), ("below", 10, 10)]
    stale = {r.day.day for r in spark.table("t_plan_below").where("v = 6").collect()}
    assert stale == {3, 4, 10} and spark.table("t_plan_below").count() == 10
    with pytest.raises(plan.CycleFound):
        plan.apply(spark, [plan.Node(models.Model(n, top), n, (m,)) for n, m in (("p", "q"), ("q", "p"))], "2024-01-01", "2024-01-02", log)
