from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tablekit.errors import InvalidSpec, InvalidVariables, SchemaConflict
from tablekit.operators import checks, diff, incremental
from tablekit.operators.checks import Check
from tests.conftest import rows


@pytest.fixture(scope="module")
def nulls(spark):
    return spark.createDataFrame([(None, None)] * 3, "k int, v string")


def outcome(results):
    return {r.check_name: (r.metric, r.passed) for r in results.collect()}


def test_all_null_table(nulls):
    got = outcome(
        checks.verify(
            nulls,
            [
                Check("rows", "row_count", operator="must_be_greater_than"),
                Check("missing", "missing_count", ("k",)),
                Check("dup", "duplicate_count", ("k",)),
                Check("dup2", "duplicate_count", ("k", "v")),
                Check("pred", "audit", expr="k > 0"),
            ],
        )
    )
    assert got == {"rows": (3, True), "missing": (3, False), "dup": (0, True), "dup2": (0, True), "pred": (3, False)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "a int, b int, c int, d int")
    wanted = [Check(c, "duplicate_count", (c,)) for c in "abcd"]
    wanted.append(Check("rows", "row_count", operator="must_be_greater_than"))
    got = outcome(checks.verify(empty, wanted))
    assert got == {**{c: (0, True) for c in "abcd"}, "rows": (0, False)}


def test_fused_and_separate_duplicates_agree(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (None, 2), (2, None)], "a int, b int")
    keys = [("a",), ("b",), ("a", "b"), ("b", "a")]
    wanted = [Check(",".join(k), "duplicate_count", k) for k in keys]
    apart = outcome(checks.verify(df, wanted))
    together = {}
    for w in wanted:
        together |= outcome(checks.verify(df, [w]))
    assert apart == together == {"a": (2, False), "b": (2, False), "a,b": (1, False), "b,a": (1, False)}


def test_one_scan_for_a_contract(spark, tmp_path):
    spark.range(10).selectExpr("id", "id % 3 AS b").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    wanted = [Check("rows", "row_count"), Check("m", "missing_count", ("id",)), Check("d", "duplicate_count", ("b",)),
              Check("p", "audit", expr="id >= 0")]
    plan = checks.verify(df, wanted)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_unknown_column_fails_without_crashing(nulls):
    got = outcome(checks.verify(nulls, [Check("x", "missing_count", ("nope",)), Check("k", "missing_count", ("k",))]))
    assert got == {"x": (None, False), "k": (3, False)}


def test_variables(nulls):
    check = Check("n", "row_count", operator="must_be_between", threshold=":low", upper=":high")
    assert outcome(checks.verify(nulls, [check], variables='{"low": 1, "high": 3}')) == {"n": (3, True)}
    for bad in ("{", "[1]", '{"low": 1}'):
        with pytest.raises(InvalidVariables):
            checks.verify(nulls, [check], variables=bad)


def test_missing_values_are_quoted(spark):
    df = spark.createDataFrame([("n/a",), ("it's",), ("a\\b",), (None,), ("x{y}",)], "v string")
    check = Check("m", "missing_count", ("v",), missing_values=("it's", "a\\b", "x{y}"))
    assert outcome(checks.verify(df, [check])) == {"m": (4, False)}


def test_specs_are_validated():
    for bad in (
        dict(name="a", type="other"),
        dict(name="a", type="audit"),
        dict(name="a", type="missing_count"),
        dict(name="a", type="row_count", operator="is"),
        dict(name="a", type="row_count", operator="must_be_between"),
    ):
        with pytest.raises(InvalidSpec):
            Check(**bad)


def test_structure_rows_come_with_a_contract(spark):
    from pyspark.sql.types import StructType

    df = spark.createDataFrame([(1, "x")], "a int, b string")
    results = checks.verify(df, [Check("rows", "row_count", threshold=1)], expected=StructType.fromDDL("a bigint, c int"))
    assert {(r.check_name, r.column_name, r.passed) for r in results.collect()} == {
        ("wrong type", "a", False),
        ("missing column", "c", False),
        ("unexpected column", "b", False),
        ("rows", None, True),
    }


def test_history_is_newest_first_whatever_the_contract(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "results")
    for hour, contract in enumerate(["sales", "sales_eu", "sales", "stock"]):
        ts = datetime(2024, 1, 1, hour, tzinfo=timezone.utc)
        wanted = [Check("rows", "row_count", threshold=3 if hour else 4), Check("m", "missing_count", ("id",))]
        checks.save_results(checks.verify(df, wanted, contract, run_id=f"r{hour}", ts=ts), path)
    results = checks.read_results(spark, path)
    assert [r.run_id for r in checks.history(results).collect()] == ["r3", "r2", "r1", "r0"]
    newest = checks.history(results, "sales", 2)
    assert [(r.run_id, r.passed, r.checks_failed) for r in newest.collect()] == [("r2", True, 0), ("r1", True, 0)]
    assert checks.history(results, "sales", 2, show_checks=True).count() == 4
    assert checks.totals(results).where("NOT passed").select("run_id").first()[0] == "r0"


def test_suggestions_round_trip(spark):
    df = spark.createDataFrame([(i, i % 2, None if i else "x") for i in range(50)], "id int, b int, c string")
    specs = checks.suggest_checks(df)
    assert rows(specs, "check_type", "column_name") == [
        ("duplicate_count", "id"), ("missing_count", "id"), ("row_count", None)
    ]
    assert checks.verify(df, checks.checks_from(specs)).where("NOT passed").isEmpty()
    assert rows(checks.suggest_checks(df, ["c"]), "check_type", "column_name") == [
        ("missing_count", "c"), ("row_count", None)
    ]
    with pytest.raises(InvalidSpec):
        checks.suggest_checks(df, ["zz"])


def test_table_diff(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "w"), (4, "w")], "k int, v string")
    assert diff.table_diff(a, a).isEmpty()
    assert rows(diff.table_diff(a, b)) == [(1, "x", "missing", 1), (3, "z", "missing", 1), (4, "w", "extra", 2)]
    with pytest.raises(SchemaConflict):
        diff.table_diff(a, b.withColumn("k", F.col("k").cast("string")))


def test_violations_inside_an_interval(spark):
    df = spark.sql(
        "SELECT id, TIMESTAMP_NTZ '2024-01-01 12:00:00' + make_interval(0, 0, 0, int(id)) AS ts, "
        "CASE WHEN id <> 2 THEN id END AS v FROM range(5)"
    )
    got = checks.violations(df, "v < :top", "ts", "2024-01-02", "2024-01-04", {"top": 3})
    assert rows(got, "id") == [(2,), (3,)]


def test_fused_and_separate_duplicates_agree_in_every_column(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, None)], "a int, b int")
    wanted = [Check(f"{c}{i}", "duplicate_count", (c,)) for i, c in enumerate("abab")]
    when = datetime(2024, 1, 1, tzinfo=timezone.utc)
    apart = checks.verify(df, wanted, run_id="r", ts=when)
    together = [r for w in wanted for r in checks.verify(df, [w], run_id="r", ts=when).collect()]
    assert sorted(map(str, apart.collect())) == sorted(map(str, together))
    assert {r.metrics["rows"] for r in together} == {3.0}


def test_structure_and_bad_audits_are_rows_of_their_contract(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    got = outcome(
        checks.verify(
            df,
            [
                Check("same", "structure", expr="a int, b string"),
                Check("other", "structure", expr="a bigint, c string"),
                Check("bad", "audit", expr="nothing > 1"),
                Check("worse", "audit", expr="a >"),
                Check("good", "audit", expr="a > 0"),
            ],
        )
    )
    assert got == {"same": (0, True), "other": (3, False), "bad": (None, False), "worse": (None, False), "good": (0, True)}
    assert outcome(checks.verify(df, [Check("same", "structure", expr="a int, b string")])) == {"same": (0, True)}


def test_contract_round_trip(spark):
    wanted = [
        Check("a", "row_count", operator="must_be_between", threshold=1, upper=":n"),
        Check("b", "missing_count", ("v",), missing_values=("", "n/a")),
        Check("c", "duplicate_count", ("k", "v"), approx=True),
    ]
    assert checks.checks_from(checks.spec_frame(spark, wanted).orderBy("check_name")) == wanted


def test_an_audit_that_raises_fails_alone(spark):
    df = spark.createDataFrame([("1", 1), ("a", 2)], "v string, n int")
    wanted = [
        Check("number", "audit", expr="CAST(v AS INT) > 0"), Check("n", "audit", expr="n < 2"),
        Check("rows", "row_count", threshold=2), Check("over", "audit", expr="1 / (n - n) > 0"),
    ]
    got = outcome(checks.verify(df, wanted, run_id="r"))
    assert got == {"number": (None, False), "n": (1, False), "rows": (2, True), "over": (None, False)}
    alone = outcome(checks.verify(df, wanted[:1]))
    assert alone == {"number": (None, False)}


def test_names_with_quotes_and_commas(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "`a,b` int, c int")
    names = ["it's", "{x}", "back\\slash", "`q`"]
    found = checks.audit(df, {n: "c > 1" for n in names}).collect()
    assert [r.broken for r in found] == [names]
    wanted = [Check("it's", "duplicate_count", ("a,b",)), Check("pair", "duplicate_count", ("a,b", "c"))]
    stored = checks.checks_from(checks.spec_frame(spark, wanted))
    assert stored == wanted
    assert outcome(checks.verify(df, stored)) == {"it's": (1, False), "pair": (0, True)}
    plain = checks.spec_frame(spark, [Check("k", "duplicate_count", ("c",))]).drop("columns")
    assert checks.checks_from(plain)[0].columns == ("c",)


def test_incremental_equals_the_whole_and_reads_new_partitions_only(spark, tmp_path, monkeypatch):
    schema = "k int, v string, day string"
    wanted = [
        Check("rows", "row_count", operator="must_be_greater_than"), Check("v", "missing_count", ("v",), missing_values=("none",)),
        Check("k", "duplicate_count", ("k",)), Check("kv", "duplicate_count", ("k", "v")),
        Check("about", "duplicate_count", ("k",), approx=True), Check("low", "audit", expr="k < :top"),
    ]
    path, states = str(tmp_path / "t"), incremental.States(spark, str(tmp_path / "states"))
    asked = []
    select = incremental._select
    monkeypatch.setattr(incremental, "_select", lambda df, *a: (asked.append(df._jdf.queryExecution().executedPlan().toString()), select(df, *a))[1])

    def store(rows_, *days):
        df = spark.createDataFrame(rows_, schema)
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
        stored = spark.read.schema(schema).parquet(path)
        one = outcome(incremental.verify(stored, wanted, "day", states, variables={"top": 5}, again=days))
        assert one == outcome(checks.verify(stored, wanted, variables={"top": 5}))
        return one

    store([(1, "a", "d1"), (1, "b", "d1"), (None, None, "d1")])
    store([(1, "a", "d2"), (9, "none", "d2"), (2, None, None)])
    assert "PartitionFilters: [((day#" in asked[-1] and " = d2)" in asked[-1] and "d1" not in asked[-1]
    before = len(asked)
    store([(1, "a", "d2"), (9, "none", "d2")])
    assert len(asked) == before
    final = store([(7, "z", "d1"), (7, "z", "d1")], "d1")
    assert final["k"] == (1, False) and final["rows"][0] == 5 and final["kv"] == (1, False)
    with pytest.raises(InvalidSpec):
        incremental.verify(spark.range(1), [wanted[0], wanted[0]], "id", states)


def test_incremental_forgets_a_dropped_partition(spark, tmp_path):
    wanted = [Check("rows", "row_count"), Check("k", "duplicate_count", ("k",))]
    states = incremental.States(spark, str(tmp_path / "states"))
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b")], "k int, part string")
    assert outcome(incremental.verify(df, wanted, "part", states)) == {"rows": (3, False), "k": (1, False)}
    left = df.where("part = 'a'")
    assert outcome(incremental.verify(left, wanted, "part", states, again=["b"])) == {"rows": (1, False), "k": (0, True)}

