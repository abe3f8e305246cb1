"""Loads into catalog tables: append, replace, merge, partition overwrite, and their run log.

Tables are parquet. A load that rewrites a table writes a complete new version next to the old one
and then points the table at it with one catalog change: a job that dies half-way leaves the table
as it was, readers in flight keep their files, and a load may read the table it rewrites.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablekit.errors import InvalidSpec, NoData, TableNotFound
from tablekit.operators.runs import RunLog
from tablekit.operators.schema import evolve
from tablekit.plans.windows import null_safe_join
from tablekit.session import materialize
from tablekit.sources.files import FORMATS, format_of, scan

DISPOSITIONS = ("append", "replace", "merge", "partitions")


def describe(spark: SparkSession, table: str) -> dict:
    """Catalog description of a table (location, partition columns, ...)."""
    if not spark.catalog.tableExists(table):
        raise TableNotFound(table)
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return list(describe(spark, table).get("partition_columns") or [])


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that fills while the rows are written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def create_table(
    df: DataFrame, table: str, path: str | None = None, partition_by: Sequence[str] = ()
) -> int:
    """Create a table from a query or file scan; returns the rows written."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df, seen = counted(df)
    writer = df.write.format("parquet").mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", os.path.join(path, _version()))
    writer.saveAsTable(table)
    return seen.get["rows"]


def _version() -> str:
    return f"version-{uuid.uuid4().hex[:12]}"


def _next_location(spark: SparkSession, table: str) -> str:
    location = describe(spark, table)["location"].rstrip("/")
    parent, leaf = os.path.split(location)
    root = parent if leaf.startswith("version-") else f"{location}_versions"
    return os.path.join(root, _version())


def append(
    spark: SparkSession, df: DataFrame, table: str, positional: bool = False, path: str | None = None
) -> int:
    """Add rows, matching columns by name (by position on request); creates the table if needed."""
    if not spark.catalog.tableExists(table):
        return create_table(df, table, path)
    if not positional:
        target = spark.table(table)
        df = evolve(target, df)[1]
        if df.columns != target.columns:
            raise InvalidSpec(f"new columns {[c for c in df.columns if c not in target.columns]}; load with evolve=True")
    partitions = partition_columns(spark, table)
    if partitions:
        df = df.hint("rebalance", *partitions)
    df, seen = counted(df)
    df.write.insertInto(table)
    return seen.get["rows"]


def insert_records(spark: SparkSession, df: DataFrame, table: str, path: str | None = None) -> int:
    """Append parsed records in one job; no records is ``NoData``, a ragged record is NULL-filled."""
    if df.isEmpty():
        raise NoData(f"no records for {table}")
    if spark.catalog.tableExists(table):
        df = evolve(spark.table(table), df)[1]
    return append(spark, df, table, path=path)


def swap(spark: SparkSession, df: DataFrame, table: str) -> int:
    """Write ``df`` as the table's next version and switch to it; ``df`` may read the table.

    Partition, bucket and sort columns stay as they are, as far as ``df`` has them.
    """
    info = describe(spark, table)
    location = _next_location(spark, table)
    partitions = list(info.get("partition_columns") or [])
    buckets = [c for c in info.get("bucket_columns") or [] if c in df.columns]
    sorting = [c for c in info.get("sort_columns") or [] if c in df.columns]
    number = int(info.get("num_buckets") or 0)
    if buckets:
        df = df.hint("rebalance", number, *buckets)
    elif partitions:
        df = df.hint("rebalance", *partitions)
    df, seen = counted(df)
    same = spark.table(table).schema.simpleString() == df.schema.simpleString()
    if same and not partitions and not buckets:
        df.write.parquet(location)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    else:
        # A new column set or a partitioned table needs a new catalog entry.
        staged = f"{table}__{_version().replace('-', '_')}"
        writer = df.write.format("parquet").option("path", location)
        if partitions:
            writer = writer.partitionBy(*partitions)
        if buckets:
            writer = writer.bucketBy(number, *buckets)
            if sorting:
                writer = writer.sortBy(*sorting)
        writer.saveAsTable(staged)
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    spark.catalog.refreshTable(table)
    return seen.get["rows"]


def replace(spark: SparkSession, df: DataFrame, table: str, path: str | None = None) -> int:
    """Whatever the table held, it now holds ``df``."""
    if not spark.catalog.tableExists(table):
        return create_table(df, table, path)
    return swap(spark, df, table)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the last by ``order_by``, any one if that is empty.

    The row limit runs before the shuffle too, so many copies of one key do not travel.
    """
    order = [F.col(c).desc_nulls_last() for c in order_by] or [F.lit(1)]
    ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("__rn = 1").drop("__rn")


def merged(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """``target`` with the batch's latest row per key put in place of rows with the same key.

    Keys compare NULL-safe, so merging a batch twice equals merging it once. With ``order_by`` a row of the
    target that is later than the batch's stays; on ties the batch wins.
    """
    return _upserted(target, latest_per_key(batch, keys, order_by), keys, order_by)


def _upserted(target: DataFrame, latest: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """``target`` and a batch with one row per key."""
    latest = latest.select(*target.columns)
    kept = null_safe_join(target, latest.select(*keys), keys, "left_anti")
    if not order_by:
        return kept.unionByName(latest)
    held = null_safe_join(target, latest.select(*keys), keys, "left_semi").withColumn("__new", F.lit(0))
    both = held.unionByName(latest.withColumn("__new", F.lit(1)))
    return kept.unionByName(latest_per_key(both, keys, [*order_by, "__new"]).drop("__new"))


def merge(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    path: str | None = None,
    partition_by: Sequence[str] = (),
) -> int:
    """Upsert by key; returns the batch's keys.

    The batch is computed once. With ``order_by`` a stored row that is later than the batch's stays, so batches
    may arrive in any order. On a table partitioned by key columns only the partitions the batch touches are rewritten.
    Otherwise Spark has no in-place update for parquet and the table gets a new version.
    ``partition_by`` is for a table that does not exist yet.
    """
    if not keys:
        raise InvalidSpec("merge needs keys")
    if not spark.catalog.tableExists(table):
        return create_table(latest_per_key(df, keys, order_by), table, path, partition_by)
    target = spark.table(table)
    target, batch = evolve(target, df)
    latest = materialize(latest_per_key(batch, keys, order_by), "batch")
    partitions = partition_columns(spark, table)
    if partitions and set(partitions) <= set(keys) and target.columns == spark.table(table).columns:
        touched = materialize(latest.select(*partitions).distinct(), "touched")
        # One value for each partition that is rewritten, as literals, so that the scan leaves out all others.
        values = touched.collect()
        within = null_safe_join(target.where(_listed(partitions, values)), touched, partitions, "left_semi")
        if values:
            overwrite_partitions(spark, _upserted(within, latest, keys, order_by), table)
    else:
        swap(spark, _upserted(target, latest, keys, order_by), table)
    return latest.count()


def _listed(columns: Sequence[str], values: list):
    """Each column holds one of its values, NULL included."""
    tests = [F.lit(True)]
    for column in columns:
        own = {row[column] for row in values}
        test = F.col(column).isin([v for v in own if v is not None]) if own - {None} else F.lit(False)
        tests.append(test | F.col(column).isNull() if None in own else test)
    return reduce(lambda a, b: a & b, tests)


def overwrite_partitions(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> int:
    """Replace exactly the partitions that occur in ``df``; all others stay untouched."""
    if not spark.catalog.tableExists(table):
        if not partition_by:
            raise InvalidSpec("a new table needs partition_by")
        return create_table(df, table, path, partition_by)
    info = describe(spark, table)
    partitions = list(info.get("partition_columns") or [])
    if not partitions:
        raise InvalidSpec(f"{table} is not partitioned")
    df = evolve(spark.table(table).limit(0), df)[1].select(*spark.table(table).columns)
    named = F.struct(*[F.col(c).cast("string").alias(c) for c in partitions])
    written = Observation()
    df = df.hint("rebalance", *partitions)
    df = df.observe(written, F.count(F.lit(1)).alias("rows"), F.to_json(F.collect_set(named)).alias("parts"))
    # Dynamic mode stages the new folders and moves them in when all tasks are done. It is asked
    # for per write, not per session, so the write goes to the table's folder.
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(info["location"])
    # Only what was written is registered: folders of dropped partitions must not come back.
    specs = json.loads(written.get["parts"] or "[]")
    for at in range(0, len(specs), 200):
        added = " ".join(_partition_spec(partitions, spec) for spec in specs[at : at + 200])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    spark.catalog.refreshTable(table)
    return written.get["rows"]


def _partition_spec(columns: Sequence[str], spec: dict[str, str | None]) -> str:
    def literal(value: str | None) -> str:
        return "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    return "PARTITION (" + ", ".join(f"`{c}` = {literal(spec.get(c))}" for c in columns) + ")"


def drop_partition(spark: SparkSession, table: str, spec: dict[str, str | None]) -> None:
    """Drop one partition and delete its folder, also where the table's files are external."""
    info = describe(spark, table)
    columns = list(info.get("partition_columns") or [])
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    folder = "/".join(names.getPartitionPathString(c, spec.get(c)) for c in columns)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_partition_spec(columns, spec)}")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{info['location'].rstrip('/')}/{folder}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark.catalog.refreshTable(table)


def remove_versions(spark: SparkSession, table: str, keep: int = 1, older_than: timedelta = timedelta(days=1)) -> int:
    """Delete old versions of a table that loads left behind; returns how many.

    The current version stays, and so do the newest ``keep`` others and any that a reader may still use, that is
    younger than ``older_than``.
    """
    parent, current = os.path.split(describe(spark, table)["location"].rstrip("/"))
    if not current.startswith("version-"):
        return 0
    path = spark._jvm.org.apache.hadoop.fs.Path(parent)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [(s.getModificationTime(), s.getPath()) for s in system.listStatus(path)]
    old = sorted((t, p.getName(), p) for t, p in found if p.getName().startswith("version-") and p.getName() != current)
    limit = (datetime.now(timezone.utc) - older_than).timestamp() * 1000
    gone = [p for t, _, p in old[: max(0, len(old) - keep)] if t <= limit]
    for one in gone:
        system.delete(one, True)
    return len(gone)


@contextmanager
def logged(log: RunLog | None, kind: str, target: str, disposition: str | None = None):
    """Record RUNNING, then SUCCESS with the row count or FAILURE with the error."""
    result = {"rows": None, "logs": []}
    run = log.start(kind, target, disposition) if log else None
    try:
        yield result
    except BaseException as error:
        if log:
            log.fail(run, error)
        raise
    if log:
        log.finish(run, result["rows"], logs=result["logs"])


def load(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    disposition: str = "append",
    keys: Sequence[str] = (),
    order_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    evolve_schema: bool = False,
    widen: bool = False,
    path: str | None = None,
    log: RunLog | None = None,
) -> int:
    """Load rows with a disposition and keep a run-log entry; returns rows written."""
    if disposition not in DISPOSITIONS:
        raise InvalidSpec(f"disposition {disposition!r}; expected one of {DISPOSITIONS}")
    with logged(log, "load", table, disposition) as result:
        if evolve_schema and disposition != "replace" and spark.catalog.tableExists(table):
            target, batch = evolve(spark.table(table), df, widen)
            before = spark.table(table).schema
            if target.schema.simpleString() != before.simpleString():
                if all(target.schema[f.name].dataType == f.dataType for f in before):
                    new = [f for f in target.schema if f.name not in before.names]
                    added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
                    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
                else:
                    swap(spark, target, table)
                result["logs"].append("schema evolved to " + target.schema.simpleString())
            df = batch
        if disposition == "append":
            result["rows"] = append(spark, df, table, path=path)
        elif disposition == "replace":
            result["rows"] = replace(spark, df, table, path)
        elif disposition == "merge":
            result["rows"] = merge(spark, df, table, keys, order_by, path, partition_by)
        else:
            result["rows"] = overwrite_partitions(spark, df, table, partition_by, path)
    return result["rows"]


def load_file(
    spark: SparkSession, file_path: str, table: str, fmt: str = "auto", schema=None, **options
) -> int:
    """``load`` from a file, folder or glob, without passing rows through the driver."""
    return load(spark, scan(spark, file_path, fmt, schema), table, **options)


def load_source(
    spark: SparkSession, source: Callable[[SparkSession], DataFrame], table: str, **options
) -> int:
    """``load`` from a source function; errors while planning the source are logged as well."""
    log = options.pop("log", None)
    with logged(log, "source", table, options.get("disposition", "append")) as result:
        result["rows"] = load(spark, source(spark), table, **options)
    return result["rows"]


def export(df: DataFrame, path: str, fmt: str = "auto", mode: str = "errorifexists") -> int:
    """Write a query result as parquet, csv (with header) or JSON lines; returns rows written.

    The format is that of the suffix, parquet if there is none. JSON keeps NULL fields, so every
    line has all columns.
    """
    suffixed = any(path.lower().endswith(suffix) for suffix in FORMATS)
    name = format_of(path, fmt if fmt != "auto" or suffixed else "parquet")
    df, seen = counted(df)
    writer = df.write.format(name).mode(mode)
    if name == "csv":
        writer = writer.option("header", True)
    if name == "json":
        writer = writer.option("ignoreNullFields", False)
    writer.save(path)
    return seen.get["rows"]
