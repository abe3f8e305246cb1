"""Tables that keep every version of a key's row: when it held, and when the key was deleted."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.errors import InvalidSpec
from tablekit.operators import loads
from tablekit.operators.schema import evolve
from tablekit.plans.windows import neighbours, null_safe_join
from tablekit.session import materialize

FROM, TO, DELETED, BUCKET = "valid_from", "valid_to", "is_deleted", "key_bucket"
#: Versions of a key are linked inside cells of this grain, so a key may have any number of them.
CELL = "month"


def _versions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One version per key and time: of several the greatest by its columns, so that no order of arrival matters."""
    others = [c for c in df.columns if c not in (*keys, FROM)]
    greatest = F.max(F.struct(*[F.col(f"`{c}`") for c in others])).alias("__row")
    return df.groupBy(*keys, FROM).agg(greatest).select(*keys, FROM, "__row.*")


def _linked(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions with the time at which the next one of the key takes over."""
    written = materialize(versions, "versions")  # read twice: by the cells and by their summary
    following = neighbours(written, keys, [FROM], [F.date_trunc(CELL, FROM)], FROM)
    return following.select(*written.columns, F.col("lead").alias(TO))


def merge(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    valid_from: str,
    deleted: str | None = None,
    path: str | None = None,
    buckets: int = 0,
) -> int:
    """Add versions of rows to a table that keeps them all; returns how many the batch has.

    A row of ``df`` says how its key looks from ``valid_from`` on; where ``deleted`` is true the key ends then. The table
    holds keys and columns with ``valid_from``, ``valid_to`` (NULL: until now) and ``is_deleted``. Deletions stay as
    versions of their own, so batches may arrive in any order, overlap or be loaded twice: the table is the same. Keys
    compare NULL-safe; a row without ``valid_from`` is an error. New columns are NULL in older versions.

    With ``buckets`` a new table is partitioned by a hash of the keys, and a batch rewrites only the buckets its keys
    fall into; otherwise the table gets a new version. Only versions of the batch's keys are linked again.
    """
    if not keys:
        raise InvalidSpec("history needs keys")
    clash = {FROM, TO, DELETED, BUCKET} & {c for c in df.columns if c not in (valid_from, deleted)}
    if clash:
        raise InvalidSpec(f"columns {sorted(clash)} are the table's own")
    others = [F.col(f"`{c}`") for c in df.columns if c not in (*keys, valid_from, deleted)]
    flag = F.coalesce(F.col(f"`{deleted}`"), F.lit(False)) if deleted else F.lit(False)
    batch = df.select(*keys, F.col(f"`{valid_from}`").alias(FROM), flag.alias(DELETED), *others)
    batch = materialize(_versions(batch, keys), "history")
    facts = batch.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(FROM).isNull()).alias("timeless")).first()
    if facts.timeless:
        raise InvalidSpec(f"{facts.timeless} rows without {valid_from}")
    exists = spark.catalog.tableExists(table)
    bucketed = BUCKET in loads.partition_columns(spark, table) if exists else buckets > 0
    if bucketed:
        if exists and not buckets:
            raise InvalidSpec(f"{table} is partitioned by {BUCKET}: name its number of buckets")
        batch = batch.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    if not exists:
        loads.create_table(_ordered(_linked(batch, keys), bucketed), table, path, [BUCKET] if bucketed else [])
        return facts.n
    target = spark.table(table)
    held, new = evolve(target.drop(TO), batch)
    same = held.columns == target.drop(TO).columns
    touched = materialize(batch.select(*keys, *([BUCKET] if bucketed else [])).distinct(), "touched")
    within = target
    if bucketed and same:
        # At most ``buckets`` numbers, as literals, so that the scan leaves out all other partitions.
        numbers = [r[0] for r in touched.select(BUCKET).distinct().collect()]
        if not numbers:
            return 0
        within = target.where(F.col(BUCKET).isin(numbers))
        held = within.drop(TO)
    own = null_safe_join(held, touched.select(*keys), keys, "left_semi").select(*new.columns)
    kept = null_safe_join(within if same else target, touched.select(*keys), keys, "left_anti")
    linked = _ordered(_linked(_versions(own.unionByName(new), keys), keys), bucketed)
    result = _ordered(kept, bucketed).unionByName(linked, allowMissingColumns=True)
    if bucketed and same:
        loads.overwrite_partitions(spark, result.select(*target.columns), table)
    else:
        loads.swap(spark, result, table)
    return facts.n


def _ordered(df: DataFrame, bucketed: bool) -> DataFrame:
    """The partition column last."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != BUCKET], *([BUCKET] if bucketed else []))


def as_of(df: DataFrame, at: str | datetime | None = None) -> DataFrame:
    """The rows that held at a time (now without one), deleted keys left out."""
    if at is None:
        return df.where(F.col(TO).isNull() & ~F.col(DELETED))
    when = F.lit(at).cast(df.schema[FROM].dataType)
    return df.where((F.col(FROM) <= when) & (F.col(TO).isNull() | (F.col(TO) > when)) & ~F.col(DELETED))
