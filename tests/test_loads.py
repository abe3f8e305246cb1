from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablekit.errors import InvalidSpec, NoData, SchemaConflict, TableNotFound
from tablekit.operators import loads
from tablekit.operators.runs import RunLog
from tests.conftest import rows

SCHEMA = "id bigint, v string, seq bigint"


@pytest.fixture
def target(spark, table, tmp_path):
    start = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "n", 1)], SCHEMA)
    loads.create_table(start, table, str(tmp_path / table))
    return table


@pytest.fixture
def batch(spark):
    """A changed row, a new row twice, an unchanged row and a NULL key."""
    data = [(1, "A", 2), (3, "c1", 1), (3, "c2", 2), (2, "b", 1), (None, "N", 2)]
    return spark.createDataFrame(data, SCHEMA)


MERGED = [(None, "N", 2), (1, "A", 2), (2, "b", 1), (3, "c2", 2)]


def test_merge_twice_is_merge_once(spark, target, batch):
    for _ in range(2):
        assert loads.merge(spark, batch, target, ["id"], ["seq"]) == 4
        assert rows(spark.table(target)) == MERGED


def test_merged_frame_equals_merged_table(spark, target, batch):
    assert rows(loads.merged(spark.table(target), batch, ["id"], ["seq"])) == MERGED


def test_merge_creates_and_needs_keys(spark, table, batch, tmp_path):
    loads.merge(spark, batch, table, ["id"], ["seq"], str(tmp_path / table))
    assert spark.table(table).count() == 4
    with pytest.raises(InvalidSpec):
        loads.merge(spark, batch, table, [])


def test_merge_into_a_hot_batch_key(spark, target):
    """Most of the batch is one key; its copies are cut before the shuffle."""
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("id"), F.lit("h").alias("v"), F.col("id").alias("seq")
    )
    latest = loads.latest_per_key(hot, ["id"], ["seq"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    loads.merge(spark, hot, target, ["id"], ["seq"])
    assert rows(spark.table(target).where("id = 1")) == [(1, "h", 2999)]


def test_merge_rewrites_only_touched_partitions(spark, table, tmp_path):
    def frame(data):
        return spark.createDataFrame(data, "id int, v string, p int")

    loads.overwrite_partitions(spark, frame([(1, "a", 1), (2, "b", 2), (3, "c", 3)]), table, ["p"], str(tmp_path / table))
    stamps = {r.p: r.m for r in spark.table(table).select("p", F.col("_metadata.file_path").alias("m")).collect()}
    loads.merge(spark, frame([(2, "B", 2), (4, "d", 2), (5, "e", 4)]), table, ["id", "p"])
    assert rows(spark.table(table)) == [(1, "a", 1), (2, "B", 2), (3, "c", 3), (4, "d", 2), (5, "e", 4)]
    after = {r.p: r.m for r in spark.table(table).select("p", F.col("_metadata.file_path").alias("m")).collect()}
    assert after[1] == stamps[1] and after[3] == stamps[3] and after[2] != stamps[2]


def test_append_counts_add_up_and_match_by_name(spark, target):
    more = spark.createDataFrame([("x", 9)], "v string, id bigint")
    assert loads.append(spark, more, target) == 1
    assert spark.table(target).count() == 4
    assert rows(spark.table(target).where("id = 9")) == [(9, "x", None)]
    with pytest.raises(InvalidSpec):
        loads.append(spark, more.withColumn("extra", F.lit(1)), target)
    with pytest.raises(SchemaConflict):
        loads.append(spark, more.withColumn("id", F.lit("t")), target)


def test_positional_append(spark, target):
    odd = spark.createDataFrame([(7, "seven", 1)], "a bigint, b string, c bigint")
    loads.append(spark, odd, target, positional=True)
    assert rows(spark.table(target).where("id = 7")) == [(7, "seven", 1)]


def test_replace_forgets_and_may_read_itself(spark, target):
    loads.replace(spark, spark.table(target).where("id = 2"), target)
    assert rows(spark.table(target)) == [(2, "b", 1)]
    loads.replace(spark, spark.createDataFrame([(1.5,)], "other double"), target)
    assert spark.table(target).schema.simpleString() == "struct<other:double>" and spark.table(target).count() == 1


def test_failed_load_changes_nothing_and_is_logged(spark, target, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    before = rows(spark.table(target))
    broken = spark.table(target).withColumn("id", F.raise_error(F.lit("bad input")).cast("bigint"))
    with pytest.raises(Exception, match="bad input"):
        loads.load(spark, broken, target, "replace", log=log)
    loads.load(spark, spark.table(target), target, "append", log=log)
    assert rows(spark.table(target).distinct()) == before
    states = {(r.disposition, r.status, r.rows_written) for r in log.read().collect()}
    assert states == {("replace", "FAILURE", None), ("append", "SUCCESS", 3)}


def test_load_evolves_on_request(spark, target):
    wider = spark.createDataFrame([(4, "d", 1.5, True)], "id bigint, v string, seq double, flag boolean")
    with pytest.raises(SchemaConflict):
        loads.load(spark, wider, target, evolve_schema=True)
    loads.load(spark, wider, target, evolve_schema=True, widen=True)
    assert spark.table(target).schema.simpleString() == "struct<id:bigint,v:string,seq:double,flag:boolean>"
    assert rows(spark.table(target).where("id = 4")) == [(4, "d", 1.5, True)]


def test_insert_nothing(spark, target):
    with pytest.raises(NoData):
        loads.insert_records(spark, spark.createDataFrame([], SCHEMA), target)


def test_unknown_table_and_disposition(spark, table):
    with pytest.raises(TableNotFound):
        loads.describe(spark, table)
    with pytest.raises(InvalidSpec):
        loads.load(spark, spark.range(1), table, "upsert")


def test_partition_overwrite_needs_partitions(spark, target):
    with pytest.raises(InvalidSpec):
        loads.overwrite_partitions(spark, spark.table(target), target)


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_export_counts_and_round_trips(spark, tmp_path, fmt):
    from tablekit.sources.files import scan

    df = spark.createDataFrame([(1, "a,b"), (2, None), (3, 'q"uote')], "id int, v string")
    path = str(tmp_path / f"out.{fmt}")
    assert loads.export(df, path) == 3
    assert rows(scan(spark, path, schema=df.schema)) == rows(df)


def test_source_errors_are_logged(spark, table, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    with pytest.raises(ZeroDivisionError):
        loads.load_source(spark, lambda s: 1 / 0, table, log=log)
    assert [r.status for r in log.read().collect()] == ["FAILURE"]


@pytest.mark.parametrize("layout", ["partition", "bucket"])
def test_hot_folder_or_bucket_is_written_by_many_tasks(spark, table, tmp_path, layout):
    from tablekit.operators.schema import write_layout

    df = spark.range(120_000).select(F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 7).alias("k"), F.uuid().alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200000")
    try:
        if layout == "partition":
            loads.create_table(df.repartition(16), table, str(tmp_path / table), ["k"])
        else:
            write_layout(df.repartition(16), table, str(tmp_path / table), bucket_by=(4, ["k"]), sort_by=["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = spark.table(table).groupBy("k").agg(F.count_distinct(F.col("_metadata.file_path")).alias("files"))
    files = {r.k: r.files for r in written.collect()}
    assert files[0] >= 4 and spark.table(table).count() == 120_000


@pytest.mark.parametrize("kind", ["filtered", "literal"])
def test_loads_of_nothing(spark, table, tmp_path, kind):
    base = spark.range(3).withColumn("p", F.lit(1))
    none = base.where("false") if kind == "filtered" else spark.createDataFrame([], "id bigint, p int")
    assert loads.create_table(none, table, str(tmp_path / table)) == 0
    assert loads.replace(spark, none, table) == 0 and loads.append(spark, base, table) == 3
    assert loads.merge(spark, none, table, ["id"]) == 0 and spark.table(table).count() == 3
    parts = f"{table}_p"
    loads.overwrite_partitions(spark, base, parts, ["p"], str(tmp_path / parts))
    assert loads.overwrite_partitions(spark, none, parts) == 0
    assert loads.merge(spark, none, parts, ["id", "p"]) == 0 and spark.table(parts).count() == 3


def test_merge_creates_a_partitioned_table(spark, table, tmp_path):
    for shift in (0, 1):
        batch = spark.range(4).select("id", (F.col("id") % 2).alias("p"), F.lit(shift).alias("v"))
        loads.load(spark, batch, table, "merge", keys=["id", "p"], partition_by=["p"], path=str(tmp_path / table))
    assert loads.partition_columns(spark, table) == ["p"]
    assert rows(spark.table(table), "id", "v") == [(i, 1) for i in range(4)]


def test_late_batches_do_not_win(spark, target):
    late = spark.createDataFrame([(1, "old", 0), (2, "tie", 1), (5, "new", 0)], SCHEMA)
    loads.merge(spark, late, target, ["id"], ["seq"])
    assert rows(spark.table(target)) == [(None, "n", 1), (1, "a", 1), (2, "tie", 1), (5, "new", 0)]


def test_a_bucketed_table_stays_bucketed(spark, table, tmp_path):
    from tablekit.operators.schema import write_layout

    write_layout(spark.range(50), table, str(tmp_path / table / "version-0"), bucket_by=(4, ["id"]), sort_by=["id"])
    loads.replace(spark, spark.range(30), table)
    loads.merge(spark, spark.range(20, 40), table, ["id"])
    info = loads.describe(spark, table)
    assert (info["bucket_columns"], int(info["num_buckets"]), info["sort_columns"]) == (["id"], 4, ["id"])
    assert rows(spark.table(table)) == sorted(((i,) for i in range(40)), key=lambda r: str(r[0]))


def test_merge_scans_touched_partitions_only(spark, table, tmp_path):
    loads.overwrite_partitions(spark, spark.range(40).selectExpr("id", "id % 10 AS p"), table, ["p"], str(tmp_path / table))
    kept = spark.table(table).where(loads._listed(["p"], spark.range(3).selectExpr("id AS p").collect()))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [p#" in plan and kept.count() == 12
    assert loads._listed(["p"], []) is not None
    loads.merge(spark, spark.createDataFrame([(7, None), (8, None)], "id bigint, p bigint"), table, ["id", "p"])
    loads.merge(spark, spark.createDataFrame([(7, None), (9, None)], "id bigint, p bigint"), table, ["id", "p"])
    assert spark.table(table).where("p IS NULL").count() == 3 and spark.table(table).count() == 43


def test_old_versions_are_removed(spark, target, tmp_path):
    from datetime import timedelta

    for n in range(3):
        loads.replace(spark, spark.createDataFrame([(n, "x", n)], SCHEMA), target)
    assert loads.remove_versions(spark, target) == 0
    assert loads.remove_versions(spark, target, keep=5, older_than=timedelta(0)) == 0
    assert loads.remove_versions(spark, target, keep=1, older_than=timedelta(0)) == 2
    assert rows(spark.table(target)) == [(2, "x", 2)]


def test_new_columns_do_not_rewrite_the_table(spark, target):
    before = spark.table(target).inputFiles()
    loads.load(spark, spark.createDataFrame([(9, "i", 1, True)], SCHEMA + ", flag boolean"), target, evolve_schema=True)
    assert set(before) <= set(spark.table(target).inputFiles())
    assert rows(spark.table(target).where("flag")) == [(9, "i", 1, True)]


def test_wide_types(spark):
    from tablekit.operators.schema import evolve_union

    whole = spark.createDataFrame([(123456789,)], "v bigint")
    part = spark.createDataFrame([(0.5,)], "v float")
    assert rows(evolve_union(whole, part, widen=True)) == [(0.5,), (123456789.0,)]
    with pytest.raises(Exception, match="not exact"):
        evolve_union(spark.createDataFrame([((1 << 53) + 1,)], "v bigint"), part, widen=True).collect()
    money = spark.sql("SELECT CAST(1.25 AS DECIMAL(5,2)) AS v")
    assert evolve_union(money, whole, widen=True).schema["v"].dataType.simpleString() == "decimal(21,2)"
    days = spark.sql("SELECT DATE '2024-01-01' AS v")
    assert evolve_union(days, spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 10:00:00' AS v"), widen=True).count() == 2
