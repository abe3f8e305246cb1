"""Checks on tables that grow by partitions: what was counted once is kept and added up, only new partitions are read."""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablekit.errors import InvalidSpec
from tablekit.operators.checks import CHECK_RESULT, Check, _entry, _escape, _metric, _quoted, _select, parse_variables
from tablekit.session import materialize

STATE = (
    "part string, version string, loaded_at timestamp, rows bigint, counts map<string,bigint>, sketches map<string,binary>"
)
KEYS = "part string, version string, check_name string, key string, n bigint"


class States:
    """Folder of what each partition of a table contributes to a contract.

    ``parts`` has a row for each partition counted: its rows, a count for each check, sketches for approximate
    duplicate checks. ``keys`` has, for exact duplicate checks, each partition's distinct keys as digests. A partition
    counted again has a new version, and the newest one holds. A version counts from its row in ``parts`` on, which
    is written last: a run that dies leaves keys that nothing reads.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(os.path.join(self.path, name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def parts(self) -> DataFrame:
        """The newest version of each partition."""
        rows = self._read("parts", STATE)
        last = rows.groupBy("part").agg(F.max_by("version", F.struct("loaded_at", "version")).alias("version"))
        return rows.join(last, ["part", "version"], "left_semi")

    def keys(self) -> DataFrame:
        return self._read("keys", KEYS).join(self.parts().select("part", "version"), ["part", "version"], "left_semi")

    def add(self, parts: DataFrame, keys: DataFrame | None) -> None:
        if keys is not None:
            keys.write.mode("append").parquet(os.path.join(self.path, "keys"))
        parts.write.mode("append").parquet(os.path.join(self.path, "parts"))


def _known(check: Check) -> str:
    return " AND ".join(f"{_quoted(c)} IS NOT NULL" for c in check.columns)


def _digest(check: Check) -> Column:
    """A digest of a key: lengths and texts of its columns."""
    texts = [F.col(_quoted(c)).cast("string") for c in check.columns]
    return F.sha2(F.concat(*[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts]), 256)


def update(df: DataFrame, checks: Sequence[Check], partition: str, states: States, given: Mapping[str, Any], again: Sequence[str] = ()) -> list[str]:
    """Count partitions that have no state yet, and those named in ``again``; returns the partitions counted.

    One scan of these partitions for all counts, one of the key columns for each exact duplicate check.
    """
    part = F.coalesce(F.col(_quoted(partition)).cast("string"), F.lit(""))
    # One value for each partition: of a partitioned table Spark knows them without reading rows.
    present = df.select(part.alias("part")).distinct()
    new = present.join(states.parts().where(~F.col("part").isin(list(again))), "part", "left_anti")
    todo = sorted(r.part for r in new.collect())
    gone = sorted(set(again) - set(todo))
    if not todo and not gone:
        return []
    kind = df.schema[partition].dataType
    values = [F.lit(v).cast(kind) for v in todo if v != ""]
    chosen = F.col(_quoted(partition)).isin(values) if values else F.lit(False)
    chosen = chosen | F.col(_quoted(partition)).isNull() if "" in todo else chosen
    rows = df.where(chosen).withColumn("__part", part)
    version, now = uuid.uuid4().hex, datetime.now(timezone.utc)

    plain = [c for c in checks if not (c.type == "duplicate_count")]
    sketched = [c for c in checks if c.type == "duplicate_count" and c.approx]
    named = [(c, _metric(c)) for c in plain]
    named += [(c, f"count_if({_known(c)})") for c in checks if c.type == "duplicate_count"]
    columns = [f"{_escape(text)} AS `__m{i}`" for i, (_, text) in enumerate(named)]
    for i, c in enumerate(sketched):
        key = f"CASE WHEN {_known(c)} THEN to_json(struct({', '.join(map(_quoted, c.columns))})) END"
        columns.append(f"hll_sketch_agg({_escape(key)}) AS `__s{i}`")
    grouped = _select(rows, f"SELECT `__part`, count(*) AS `__rows`, {', '.join(columns)} FROM {{rows}} GROUP BY `__part`", given)
    empty = F.create_map().cast("map<string,bigint>"), F.create_map().cast("map<string,binary>")
    counts = [x for i, (c, _) in enumerate(named) for x in (F.lit(c.name), F.col(f"__m{i}").cast("bigint"))]
    sketches = [x for i, c in enumerate(sketched) for x in (F.lit(c.name), F.col(f"__s{i}"))]
    shared = [F.lit(version).alias("version"), F.lit(now).cast("timestamp").alias("loaded_at")]
    found = grouped.select(
        F.col("__part").alias("part"), *shared, F.col("__rows").alias("rows"), F.create_map(*counts).alias("counts"),
        (F.create_map(*sketches) if sketches else empty[1]).alias("sketches"),
    )
    if gone:  # a partition that is counted again and has no rows now
        lost = df.sparkSession.createDataFrame([(g,) for g in gone], "part string")
        found = found.unionByName(lost.select("part", *shared, F.lit(0).cast("bigint").alias("rows"), empty[0].alias("counts"), empty[1].alias("sketches")))
    keys = None
    for c in checks:
        if c.type == "duplicate_count" and not c.approx:
            own = rows.where(_known(c)).groupBy(F.col("__part").alias("part"), _digest(c).alias("key"))
            own = own.agg(F.count(F.lit(1)).alias("n")).select("part", F.lit(version).alias("version"), F.lit(c.name).alias("check_name"), "key", "n")
            keys = own if keys is None else keys.unionByName(own)
    states.add(found, keys)
    return todo + gone


def verify(
    df: DataFrame,
    checks: Sequence[Check],
    partition: str,
    states: States,
    contract: str = "contract",
    dataset: str = "dataset",
    variables: str | Mapping[str, Any] | None = None,
    run_id: str | None = None,
    again: Sequence[str] = (),
) -> DataFrame:
    """The results of :func:`tablekit.operators.checks.verify` over the whole table, from states of its partitions.

    Only partitions without a state are read, and those in ``again`` (values of ``partition`` as text, the empty text
    for NULL), which changed since. A check new to the contract needs states of its own: name another folder. Exact
    duplicates read the stored digests of keys, approximate ones the stored sketches; other checks add up counts.
    A partition that is dropped must be named in ``again``.
    """
    given = parse_variables(variables)
    names = [c.name for c in checks]
    if not checks or len(set(names)) < len(names):
        raise InvalidSpec("checks need names of their own")
    if any(c.type == "structure" for c in checks):
        raise InvalidSpec("a structure check has no state")
    update(df, checks, partition, states, given, again)
    parts = states.parts()
    sums = [F.coalesce(F.sum(F.coalesce(F.col("counts")[c.name], F.lit(0))), F.lit(0)).alias(f"__m{i}") for i, c in enumerate(checks)]
    sketches = [
        F.hll_sketch_estimate(F.hll_union_agg(F.col("sketches")[c.name])).alias(f"__s{i}")
        for i, c in enumerate(checks)
        if c.type == "duplicate_count" and c.approx
    ]
    base = materialize(parts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("__rows"), *sums, *sketches), "sums")
    keys = states.keys()
    results = []
    for i, c in enumerate(checks):
        metric = F.col(f"__m{i}")
        if c.type == "duplicate_count" and c.approx:
            metric = F.greatest(metric - F.coalesce(F.col(f"__s{i}"), F.lit(0)), F.lit(0))
        elif c.type == "duplicate_count":
            distinct = keys.where(F.col("check_name") == c.name).select("key").distinct()
            metric = metric - distinct.agg(F.count(F.lit(1))).scalar()
        results.append(base.select(F.inline(F.array(_entry(c, metric, given, F.col("__rows"))))))
    stamp = {
        "run_id": F.lit(run_id or uuid.uuid4().hex), "contract": F.lit(contract), "dataset": F.lit(dataset),
        "ts": F.lit(datetime.now(timezone.utc)).cast("timestamp"),
    }
    return reduce(DataFrame.unionByName, results).withColumns(stamp).select(*StructType.fromDDL(CHECK_RESULT).names)
