from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablekit.operators.checks import CHECK_RESULT, Check
from tablekit.streaming import ingest
from tests.conftest import rows

SCHEMA = "id int, ts timestamp_ntz, v int"


def drop_file(spark, folder, *data):
    """One more file in the folder."""
    df = spark.createDataFrame(data, "id int, ts string, v int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.coalesce(1).write.mode("append").parquet(folder)


def test_each_file_is_loaded_once(spark, tmp_path):
    inbox, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    drop_file(spark, inbox, (1, "2024-01-01", 1))
    for expected, more in ((1, None), (1, (2, "2024-01-02", 2)), (2, None)):
        ingest.ingest(ingest.file_stream(spark, inbox, SCHEMA), out, check)
        assert spark.read.parquet(out).count() == expected
        if more:
            drop_file(spark, inbox, more)


def test_upsert_keeps_the_latest_and_survives_replay(spark, table, tmp_path):
    inbox = str(tmp_path / "in")
    drop_file(spark, inbox, (1, "2024-01-01", 1), (2, "2024-01-01", 1))
    drop_file(spark, inbox, (1, "2024-01-02", 5))
    want = None
    for n in range(2):
        # A new checkpoint replays everything onto the same table.
        stream = ingest.file_stream(spark, inbox, SCHEMA)
        ingest.upsert(stream, table, ["id"], str(tmp_path / f"check{n}"), ["ts"], str(tmp_path / table))
        got = rows(spark.table(table), "id", "v")
        assert want in (None, got)
        want = got
    assert want == [(1, 5), (2, 1)]


def test_append_emits_closed_days_only(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, day in enumerate(["2024-01-01", "2024-01-02", "2024-01-05"]):
        drop_file(spark, inbox, (i, day, 1))
    daily = ingest.daily(ingest.file_stream(spark, inbox, SCHEMA, max_bytes=1), "ts", [], {"n": F.count(F.lit(1))}, "1 day")
    ingest.ingest(daily, out, str(tmp_path / "check"))
    assert [r[0].day for r in rows(spark.read.parquet(out), "day")] == [1, 2]


def test_checks_record_and_fail_fast(spark, tmp_path):
    inbox = str(tmp_path / "in")
    drop_file(spark, inbox, (1, "2024-01-01", 1))
    drop_file(spark, inbox, (2, "2024-01-01", -1))
    wanted = [Check("positive", "audit", expr="v > 0")]
    stream = ingest.file_stream(spark, inbox, SCHEMA, max_bytes=1)
    seen = []
    ingest.check_stream(stream, wanted, str(tmp_path / "res"), str(tmp_path / "c1"), then=lambda b, i: seen.append(i))
    saved = spark.read.schema(CHECK_RESULT + ", batch int").parquet(str(tmp_path / "res"))
    assert sorted(r.passed for r in saved.collect()) == [False, True] and seen == [0, 1]
    with pytest.raises(Exception, match="positive"):
        ingest.check_stream(stream, wanted, str(tmp_path / "res2"), str(tmp_path / "c2"), fail_fast=True)


def test_closed_days_reach_the_table_once_and_late_rows_never(spark, table, tmp_path):
    inbox, check = str(tmp_path / "in"), str(tmp_path / "check")
    states, batches = [], 0
    for n in range(1, 13):
        drop_file(spark, inbox, (n, f"2024-01-{n:02}", 1), *([(n, f"2024-01-{n - 4:02}", 100)] if n > 4 else []))
        daily = ingest.daily(ingest.file_stream(spark, inbox, SCHEMA), "ts", [], {"v": F.sum("v")}, "1 day")
        query = ingest.closed(daily, table, [], check, str(tmp_path / table))
        batches += len(query.recentProgress)
        states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert [(r[0].day, r[1]) for r in rows(spark.table(table), "day", "v")] == [(d, 1) for d in range(1, 11)]
    assert max(states) <= 4 and len(set(states[3:])) == 1 and batches >= 12
    # The whole stream again from a new checkpoint closes nothing earlier and leaves the same table.
    daily = ingest.daily(ingest.file_stream(spark, inbox, SCHEMA, max_bytes=1), "ts", [], {"v": F.sum("v")}, "1 day")
    ingest.closed(daily, table, [], str(tmp_path / "again"), str(tmp_path / table))
    assert [(r[0].day, r[1]) for r in rows(spark.table(table), "day", "v")] == [(d, 1) for d in range(1, 11)]

