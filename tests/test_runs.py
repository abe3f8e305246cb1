from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablekit.errors import InvalidSpec
from tablekit.functions import redact
from tablekit.operators import runs
from tests.conftest import rows


@pytest.fixture(scope="module")
def log(spark):
    t = [datetime(2024, 1, 1, h) for h in range(6)]
    data = [
        ("r1", "load", "a", "SUCCESS", t[0], t[1], 5, "append", {}, ["one", "two"]),
        ("r2", "load", "a", "FAILURE", t[2], t[2], None, "append", {}, ["broke"]),
        ("r3", "load", "b", "RUNNING", t[3], None, None, "append", {}, []),
        ("r4", "load", "a", "SUCCESS", t[3], t[5], 1, "merge", {}, None),
    ]
    return spark.createDataFrame(data, runs.RUN_LOG)


def test_filter_before_limit(log):
    assert [r.run_id for r in runs.recent_runs(log, limit=2).collect()] == ["r3", "r4"]
    assert [r.run_id for r in runs.recent_runs(log, target="a", status="FAILURE", limit=1).collect()] == ["r2"]


def test_metrics(log):
    a = runs.run_metrics(log).where("target = 'a'").first()
    assert (a.total_runs, a.successful_runs, a.failed_runs, a.avg_seconds) == (3, 2, 1, 3600.0)
    b = runs.run_metrics(log).where("target = 'b'").first()
    assert (b.success_rate, b.avg_seconds) == (0.0, None)


def test_logs_of_unknown_run_are_empty(log):
    assert rows(runs.run_logs(log, "r1"), "line_no", "line") == [(0, "one"), (1, "two")]
    assert runs.run_logs(log, "zzz").isEmpty() and runs.run_logs(log, "r4").isEmpty()


def test_latest_state(spark, tmp_path):
    written = runs.RunLog(spark, str(tmp_path / "log"))
    first, second = written.start("load", "t"), written.start("load", "t")
    written.finish(first, 3)
    assert {(r.run_id, r.status) for r in written.read().collect()} == {
        (first["run_id"], "SUCCESS"), (second["run_id"], "RUNNING")
    }


def test_tail(spark, log):
    now = datetime(2024, 1, 1, 4)
    assert rows(runs.tail_since(log, "started_at", 10, "2h", now=now), "run_id") == [("r2",), ("r3",), ("r4",)]
    assert rows(runs.tail_since(log, "started_at", 1, datetime(2024, 1, 1, 1), ties=["run_id"]), "run_id") == [("r3",)]
    assert rows(runs.tail_since(log, "started_at", 10, "2024-01-01 03:00:00"), "run_id") == [("r3",), ("r4",)]
    per = runs.tail_per_group(log, ["target"], "started_at", 2)
    assert rows(per, "run_id") == [("r2",), ("r3",), ("r4",)]
    plan = per._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    with pytest.raises(InvalidSpec):
        runs.tail_per_group(log, ["target"], "started_at", 0)


def test_size_rollup(spark):
    df = spark.createDataFrame([("i", 3 * 1024**3), ("i", None), ("v", None)], "kind string, size bigint")
    assert rows(runs.size_rollup(df, "kind", F.col("size"))) == [
        ("i", 2, 3 * 1024**3, 3072.0, 3.0), ("v", 1, 0, 0.0, 0.0)
    ]


def test_labels(spark):
    df = spark.createDataFrame([("web-1", {"p": "x"}), ("web-2", {"p": "y"}), ("db", {}), ("n", None)], "name string, m map<string,string>")
    assert rows(runs.label_filter(df, "m", "p"), "name") == [("web-1",), ("web-2",)]
    assert rows(runs.label_filter(df, "m", "p", "y"), "name") == [("web-2",)]
    assert rows(runs.label_filter(df, "m", name="name", contains="b"), "name") == [("db",), ("web-1",), ("web-2",)]


def test_redaction_leaves_no_sensitive_value(spark):
    schema = (
        "m map<string,string>, s struct<password:string, n:struct<Api_Key:string, keep:string>, pin_token:int>, "
        "a array<struct<secret:string, ok:int>>, mm map<string,struct<credentials:string, z:int>>, plain string"
    )
    data = [
        ({"DB_PASSWORD": "x1", "host": "h", "apikey2": "x2", "nothing": None}, ("x3", ("x4", "k"), 7),
         [("x5", 1), None], {"outer": ("x6", 2)}, "keep me"),
        (None, None, None, None, None),
    ]
    df = spark.createDataFrame(data, schema)
    out = redact.redact(df)
    assert out.schema.simpleString() == df.schema.simpleString()
    first, second = out.orderBy(F.col("plain").desc_nulls_last()).collect()
    assert not any(f"x{i}" in str(first) for i in range(1, 7)) and "7" not in str(first.s)
    assert first.m["host"] == "h" and first.s.n.keep == "k" and first.a[0].ok == 1 and first.a[1] is None
    assert first.mm["outer"].z == 2 and first.plain == "keep me"
    assert tuple(second) == (None,) * 5


def test_redaction_of_columns_and_odd_words(spark):
    df = spark.createDataFrame([("p", ["s"], "x", {"a.b": "1", "axb": "2"})], "password string, secrets array<string>, v string, m map<string,string>")
    out = redact.redact(df).first()
    assert (out.password, out.secrets, out.v) == (redact.MASK, None, "x")
    assert redact.redact(df, ["m"], ["a.b"]).first().m == {"a.b": redact.MASK, "axb": "2"}


def test_redact_pairs(spark):
    df = spark.createDataFrame([(["A=1", "MY_TOKEN=t", "Q=a=b", "BARE", "A=2", "E="],), ([],), (None,)], "e array<string>")
    got = [r[0] for r in df.select(redact.redact_pairs(F.col("e"))).collect()]
    assert got == [{"MY_TOKEN": redact.MASK, "Q": "a=b", "BARE": "", "A": "2", "E": ""}, {}, None]
