from __future__ import annotations

import json

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablekit.errors import InvalidSpec, NoData, SchemaConflict, UnsupportedFormat
from tablekit.functions import udf
from tablekit.operators import query, schema, stats
from tablekit.session import materialize, scratch_path, scratch_root
from tablekit.sources import files, jdbc, records, rest
from tablekit.streaming import ingest
from tablekit.suite import scans
from tests.conftest import rows


def test_scratch_folder_is_the_one_the_session_names(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root and scratch_path(spark, "x").startswith(root)
    df = materialize(spark.range(5).withColumn("n", F.lit(None).cast("string")))
    assert df.count() == 5 and df.inputFiles()[0].removeprefix("file://").startswith(root)


def test_formats():
    assert files.format_of("a/B.CSV") == "csv" and files.format_of("x", "json") == "json"
    assert files.format_of("dir.parquet/") == "parquet"
    for path, fmt in (("a.txt", "auto"), ("a.csv", "orc"), ("a", "auto")):
        with pytest.raises(UnsupportedFormat):
            files.format_of(path, fmt)


def test_remote_paths():
    assert files.remote_path("s3://b/k.csv") == "s3a://b/k.csv" and files.remote_path("/x/y") == "/x/y"
    with pytest.raises(UnsupportedFormat):
        files.remote_path("gopher://b/k")


def test_bad_csv_rows_are_kept(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\noops,y\n")
    df = files.scan(spark, str(tmp_path / "t.csv"), schema="a int, b string, _corrupt_record string").cache()
    assert rows(df) == [(None, "y", "oops,y"), (1, "x", None)]


def test_json_array_needs_multiline(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps([{"a": 1, "b": {"c": [1, 2]}}, {"a": 2}], indent=1))
    df = files.scan(spark, str(tmp_path / "t.json"), schema="a bigint, b struct<c:array<bigint>>", multiline=True)
    assert rows(df.select("a", F.size("b.c"))) == [(1, 2), (2, None)]


def test_glob_and_listing(spark, tmp_path):
    for name in ("p1/a.csv", "p2/b.csv", "p2/c.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("v\n1\n")
    df = files.scan_glob(spark, str(tmp_path), "*.csv", schema="v int", recursive=True, source_column="f")
    assert rows(df.select("v", F.regexp_extract("f", "[^/]+$", 0))) == [(1, "a.csv"), (1, "b.csv")]
    listed = files.list_files(spark, str(tmp_path), "*.csv", recursive=True)
    assert [r.size for r in listed.collect()] == [4, 4] and "content" not in listed.columns


def test_a_glob_reads_tables_that_are_folders(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.range(10, 15).coalesce(1).write.parquet(str(tmp_path / "other.parquet"))
    spark.range(20, 22).coalesce(1).write.parquet(str(tmp_path / "_left.parquet"))
    one = files.scan_glob(spark, str(tmp_path), "documents.parquet", source_column="f")
    assert rows(one, "id") == [(i,) for i in range(10)]
    assert one.where(F.col("f").contains("/documents.parquet/part-")).count() == 10
    (tmp_path / "one").mkdir()
    next((tmp_path / "other.parquet").glob("part-*.parquet")).rename(tmp_path / "one" / "t.parquet")
    spark.range(30, 32).write.parquet(str(tmp_path / "one" / "u[1].parquet"))
    both = files.scan_glob(spark, str(tmp_path / "one"), "*.parquet")
    assert sorted(r.id for r in both.collect()) == [10, 11, 12, 13, 14, 30, 31]



def test_ragged_and_broken_records(spark):
    text = spark.createDataFrame([('{"a": 1}',), ('{"b": "x", "c": 9}',), ("{oops",), (None,)], "r string")
    df = records.parse_records(text, "r", "a int, b string", bad_column="bad")
    assert rows(df) == [(None, None, None), (None, None, "{oops"), (None, "x", None), (1, None, None)]
    assert rows(records.literal_records(spark, {"b": 2}, "a int, b int")) == [(None, 2)]
    with pytest.raises(NoData):
        records.literal_records(spark, [], "a int")


def test_rest_pages(spark, tmp_path):
    (tmp_path / "users-0.json").write_text(json.dumps([{"id": 1}, {"id": 2}]))
    (tmp_path / "users-1.json").write_text(json.dumps([{"id": 3}]))
    (tmp_path / "one.json").write_text(json.dumps({"id": 9, "tags": ["a"]}))
    (tmp_path / "deep.json").write_text(json.dumps({"data": {"items": [{"id": 4}], "other": []}, "next": None}))
    endpoints = [
        {"name": "users", "path": "users-{page}.json", "pages": 2}, {"name": "one", "path": "/one.json"},
        {"name": "deep", "path": "deep.json", "records": "data.items"},
    ]
    df = rest.scan_rest(spark, f"file://{tmp_path}", endpoints, schema="id int")
    assert rows(df) == [("deep", 0, 4), ("one", 0, 9), ("users", 0, 1), ("users", 0, 2), ("users", 1, 3)]
    assert df.rdd.getNumPartitions() == 4
    endpoints[0]["pages_per_task"] = 2
    assert rest.scan_rest(spark, f"file://{tmp_path}", endpoints).rdd.getNumPartitions() == 3


def serve(folder, items, size=3):
    """Pages of ``size`` items, numbered and linked; the last one may be short."""
    pages = [items[i : i + size] for i in range(0, len(items), size)]
    for n, page in enumerate(pages):
        following = f"c{n + 1}" if n + 1 < len(pages) else None
        body = json.dumps({"data": {"items": [{"id": i} for i in page]}, "meta": {"next": following}})
        (folder / f"{n}.json").write_text(body)
        (folder / f"c{n}.json").write_text(body)


def test_rest_stream_goes_on_where_it_stopped(spark, tmp_path):
    api, out, check = tmp_path / "api", str(tmp_path / "out"), str(tmp_path / "check")
    api.mkdir()
    endpoints = [
        {"name": "n", "path": "{page}.json", "records": "data.items", "pages_per_task": 2},
        {"name": "c", "path": "{cursor}.json", "records": "data.items", "next": "meta.next", "cursor": "c0"},
    ]
    for total in (0, 1, 1, 4, 5, 6, 6, 23, 40):
        serve(api, list(range(total)))
        # Every other run looks for the last page from the first one again.
        given = check if total % 2 else None
        ingest.ingest(rest.stream_rest(spark, f"file://{api}", endpoints, checkpoint=given), out, check)
        try:
            got = rows(spark.read.parquet(out).selectExpr("endpoint", "get_json_object(record, '$.id') AS id"))
        except AnalysisException:
            got = []
        assert got == sorted(((e, str(i)) for e in "nc" for i in range(total)), key=lambda r: (r[0], r[1])), total
    assert json.loads(rest._committed(spark, check)) == {"n": {"at": 13, "records": 1}, "c": {"at": "c13", "records": 1}}
    with pytest.raises(InvalidSpec):
        rest.stream_rest(spark, "file:///", [{"name": "x", "path": "one.json"}])


def test_pages_behind_cursors_are_read_by_many_tasks(tmp_path, monkeypatch):
    endpoint = {"name": "c", "path": "{cursor}.json", "records": "data.items", "next": "meta.next", "cursor": "c0"}
    options = {"base_url": f"file://{tmp_path}", "endpoints": json.dumps([endpoint])}

    def read(stream, tasks):
        return [(number, json.loads(record)["id"]) for task in tasks for _, number, record in stream.read(task)]

    for most, expected in ((1000, 5), (3, 3)):
        monkeypatch.setattr(rest, "STRETCHES", most)
        serve(tmp_path, list(range(31)))
        stream = rest.PagedStream(options)
        start, middle = stream.initialOffset(), stream.latestOffset()
        assert middle == {"c": {"at": "c10", "records": 1}}
        assert read(stream, stream.partitions(start, middle)) == [(i // 3, i) for i in range(31)]
        serve(tmp_path, list(range(145)))
        end = stream.latestOffset()
        tasks = stream.partitions(middle, end)
        assert end == {"c": {"at": "c48", "records": 1}} and len(tasks) == (4 if most > 3 else 2)
        assert read(stream, tasks) == [(i // 3 - 10, i) for i in range(31, 145)]
        # A run that repeats the batch of another one has not walked the way.
        fresh = rest.PagedStream(options)
        tasks = fresh.partitions(start, end)
        assert len(tasks) == expected and read(fresh, tasks) == [(i // 3, i) for i in range(145)]
        assert read(fresh, fresh.partitions(start, middle)) == [(i // 3, i) for i in range(31)]
        assert fresh.partitions(end, end) == []


def test_only_pages_that_changed_are_served_again(spark, tmp_path):
    orders = spark.range(5200).select(F.col("id").alias("o_orderkey"), F.lit("x").alias("o_comment"))
    bodies = []
    for folder, first in (("all", 0), ("some", 2)):
        path = str(tmp_path / folder)
        assert scans._serve(orders.where("o_orderkey <= 2500"), path) == 3
        assert scans._serve(orders, path, first) == 6
        bodies.append([json.loads((tmp_path / folder / f"{n}.json").read_text()) for n in range(6)])
    for page in bodies[0] + bodies[1]:
        page["items"].sort(key=lambda order: order["o_orderkey"])
    assert bodies[0] == bodies[1] and [len(page["items"]) for page in bodies[0]] == [1000] * 5 + [200]
    assert [page.get("next") for page in bodies[0]] == ["1", "2", "3", "4", "5", None]


def test_rest_stream_asks_for_few_pages(monkeypatch):
    stream = rest.PagedStream({"base_url": "x", "endpoints": json.dumps([{"name": "n", "path": "{page}", "pages_per_task": 100}])})
    asked = []

    def page(endpoint, at):
        asked.append(at)
        return list(range(10 if at < 99_999 else 4)) if at < 100_000 else None

    monkeypatch.setattr(stream, "_page", page)
    end = stream.latestOffset()
    assert end == {"n": {"at": 99_999, "records": 4}} and len(asked) < 50
    tasks = stream.partitions({"n": {"at": 10, "records": 3}}, end)
    assert len(tasks) == 1000 and tasks[0].start == {"at": 10, "records": 3} and tasks[-1].end == end["n"]
    assert all(a.end == {**b.start, "records": 0} for a, b in zip(tasks, tasks[1:]))
    assert stream.partitions(end, end) == []


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("b,a,extra\n2,x,9\n")
    assert rows(files.scan(spark, str(tmp_path / "t.csv"), schema="a string, b int")) == [("x", 2)]
    with pytest.raises(SchemaConflict):
        files.scan(spark, str(tmp_path / "t.csv"), schema="a string, c int")
    with pytest.raises(InvalidSpec):
        rest.scan_rest(spark, "file:///", [])


@pytest.mark.parametrize("chunk", [1, 7, 64, 10_000])
def test_url_lines_in_any_byte_ranges(spark, tmp_path, chunk):
    lines = ["id,name"] + [f"{i},n{'é' * (i % 5)}" for i in range(40)]
    (tmp_path / "t.csv").write_text("\n".join(lines))
    df = rest.scan_url(spark, f"file://{tmp_path}/t.csv", "csv", "id int, name string", chunk_bytes=chunk)
    assert rows(df) == sorted(((i, f"n{'é' * (i % 5)}") for i in range(40)), key=lambda r: str(r[0]))
    with pytest.raises(UnsupportedFormat):
        rest.scan_url(spark, "http://x/y.parquet", "parquet", "a int")


def test_jdbc_options():
    plain = jdbc.read_options("jdbc:x", "t", user="u")
    assert "partitionColumn" not in plain and plain["user"] == "u"
    split = jdbc.read_options("jdbc:x", "t", "id", (1, 900), 8)
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("1", "900", "8")
    with pytest.raises(InvalidSpec):
        jdbc.read_options("jdbc:x", "t", "id")


def test_relational(spark):
    df = spark.createDataFrame([(30, 1.0, "a"), (20, 2.0, "a"), (40, 4.0, "b")], "age int, amount double, k string")
    assert rows(query.relational(df, "age > 25", aggregate="sum(amount) AS s")) == [(5.0,)]
    assert rows(query.relational(df, "age > 25", aggregate="k, sum(amount) AS s")) == [("a", 1.0), ("b", 4.0)]
    assert query.relational(df, columns=["age", "k"]).columns == ["age", "k"]
    assert rows(query.relational(df, aggregate="concat(k, '{x}') AS t, count(*) AS n")) == [("a{x}", 2), ("b{x}", 1)]
    assert query.sql_text(spark, "SELECT id FROM range(10) WHERE id > :m", {"m": 2}, limit=3).count() == 3
    assert query.sql_text(spark, "SELECT id FROM range(10)", limit=-1).count() == 10


def test_profiles_of_odd_columns(spark):
    df = spark.sql("SELECT 1 AS i, map('a', 1) AS m, array(1, 2) AS a, named_struct('x', 1) AS s, CAST(NULL AS STRING) AS n")
    got = {r.column_name: r for r in stats.table_stats(df, exact=True).collect()}
    assert {c: r.distinct_count for c, r in got.items()} == {"i": 1, "m": 1, "a": 1, "s": 1, "n": 0}
    assert got["n"].null_count == 1 and got["m"].min_value is None
    empty = stats.column_profile(df.limit(0)).collect()
    assert {r.row_count for r in empty} == {0} and empty[0].null_fraction is None
    assert {r.column_name: r.text_bytes for r in query.result_profile(df.select("i", "n"), True).collect()} == {"i": 1, "n": 0}


def test_suggested_schema(spark):
    text = [
        ('{"a": 1, "b": "x", "c": {"d": [1]}}',),
        ('{"a": 2.5, "b": null}',),
        ('{"a": 3, "weird key": true}',),
        ("not json",),
        ("[1]",),
        (None,),
    ]
    df = spark.createDataFrame(text, "r string")
    got = {r.column_name: (r.data_type, r.sample_count) for r in schema.suggest_schema(df, "r").collect()}
    assert got["a"] == ("DECIMAL(20,1)", 3) or got["a"][1] == 3
    assert got["b"] == ("STRING", 2) and got["weird key"] == ("BOOLEAN", 1)
    struct = schema.suggested_struct(df, "r")
    assert set(struct.names) == {"a", "b", "c", "weird key"}
    assert records.parse_records(df, "r", struct).where("c.d[0] = 1").count() == 1


def test_schema_compare_and_override(spark):
    v1 = spark.createDataFrame([(1, "5")], "a int, b string")
    v2 = spark.createDataFrame([(1, 2.0)], "a bigint, c double")
    assert rows(schema.compare_schemas(v1, v2), "column_name", "status") == [
        ("a", "type_changed"), ("b", "removed"), ("c", "added")
    ]
    cast = schema.override_schema(v1.union(v1.selectExpr("a", "'x'")), {"b": "int", "a": None, "n": "date"})
    assert rows(cast) == [(None, None), (5, None)]
    lost = schema.lossy_casts(v1.union(v1.selectExpr("a", "'x'")), {"b": "int"})
    assert rows(lost) == [("b", "int", 1)]


def test_evolution(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2, 1.5)], "k bigint, w double")
    with pytest.raises(SchemaConflict):
        schema.evolve_union(a, b)
    assert rows(schema.evolve_union(a, b, widen=True)) == [(1, "x", None), (2, None, 1.5)]


def test_bucketed_tables_join_without_shuffle(spark, table, tmp_path):
    names = [f"{table}_{i}" for i in range(2)]
    for name in names:
        df = spark.range(200).withColumn("v", F.lit(name))
        schema.write_layout(df, name, str(tmp_path / name), bucket_by=(4, ["id"]), sort_by=["id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(names[0]).join(spark.table(names[1]), "id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and joined.count() == 200


def test_buckets_are_counted_by_rows_in_memory(spark, tmp_path):
    spark.range(20_000).select("id", F.lit("x" * 200).alias("s")).coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))  # alike rows are small in files
    assert schema.bucket_count(df, df.limit(5), target=1 << 20) == 5
    assert schema.bucket_count(df.select("id"), target=1 << 20) == 1
    assert schema.bucket_count(df.limit(0)) == 1
    odd = spark.sql("SELECT map('a', 1) AS m, CAST(NULL AS STRING) AS s, X'0102' AS b, array(1, NULL) AS a, true AS t, INTERVAL 1 DAY AS i")
    assert schema.bucket_count(odd, target=80) == 2


def test_range_layout_keeps_rows(spark, table, tmp_path):
    df = spark.range(1000).select(F.shuffle(F.array(F.col("id")))[0].alias("id"))
    schema.write_layout(df, table, str(tmp_path / table), range_by=["id"], sort_by=["id"])
    assert spark.table(table).agg(F.sum("id")).first()[0] == 499500


def test_functions(spark):
    def shout(s: pd.Series) -> pd.Series:
        return s.str.upper() + "!"

    udf.register_scalar(spark, "shout", shout, "string")
    udf.register_sql(spark, "twice", "x INT", "INT", "x * 2")
    assert spark.sql("SELECT shout('a') AS s, twice(4) AS t").first() == ("A!", 8)


def test_curve_layout_keeps_rows_and_narrows_files(spark, table, tmp_path):
    df = spark.range(4000).selectExpr(
        "IF(id % 50 = 0, NULL, pmod(hash(id), 1000)) AS a", "IF(id % 3 = 0, 7.0D, rand(3) * 100) AS b",
        "IF(id % 40 = 0, double('NaN'), double(id)) AS c", "date_add(DATE '2024-01-01', CAST(id % 90 AS INT)) AS d", "'x' AS s",
    ).cache()
    schema.write_curve(df, table, ["a", "b"], str(tmp_path / table), schema.size_of(df) // 32)
    written = spark.table(table)
    assert written.exceptAll(df).count() == 0 and df.exceptAll(written).count() == 0
    spans = written.groupBy(F.input_file_name()).agg(F.min("a").alias("lo"), F.max("a").alias("hi"), F.count("*").alias("n"))
    spans = spans.collect()
    assert len(spans) > 16 and max(r.n for r in spans) < 4 * 4000 / len(spans)
    assert sum(r.lo is not None and r.lo <= 510 and r.hi >= 490 for r in spans) < len(spans) / 2
    place = schema.curve_place(df, ["c", "d"])
    assert df.select(place.alias("p")).where("p IS NULL OR p < 0 OR p >= 4096").count() == 0
    assert df.limit(0).select(schema.curve_place(df.limit(0), ["a"])).count() == 0
    for wrong in ([], ["s"], ["a"] * 11):
        with pytest.raises(InvalidSpec):
            schema.curve_place(df, wrong)
