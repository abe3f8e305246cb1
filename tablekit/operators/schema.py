"""Schema inference from records, drift, overrides, evolution and table layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NumericType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tablekit.errors import InvalidSpec, SchemaConflict

# Integer types from narrow to wide with their digits, used when a load may widen.
_INTEGERS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}
_FLOATS = (FloatType(), DoubleType())
# Fixed value: whole numbers up to this are exact as doubles.
_EXACT = 1 << 53
# Fixed value: Spark writes no table with more buckets, unless it is configured to.
_MOST_BUCKETS = 100_000


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def suggest_schema(df: DataFrame, column: str) -> DataFrame:
    """Top-level fields of JSON record text: name, merged type and the number of records having it.

    Text that is not JSON counts as a record without fields. Types merge on the executors, so any
    number of records can be read.
    """
    parsed = df.select(F.try_parse_json(F.col(column)).alias("__v"))
    # Objects explode into keyed entries; an array's entries have no key and are not fields.
    fields = parsed.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("__v").outer())).where("key IS NOT NULL")
    return fields.groupBy(F.col("key").alias("column_name")).agg(
        F.schema_of_variant_agg("value").alias("data_type"), F.count(F.lit(1)).alias("sample_count")
    )


def suggested_struct(df: DataFrame, column: str) -> StructType:
    """``suggest_schema`` as a ``StructType`` (one small row per field reaches the driver)."""
    rows = suggest_schema(df, column).orderBy("column_name").collect()
    return StructType.fromDDL(", ".join(f"`{r.column_name}` {_ddl(r.data_type)}" for r in rows))


def _ddl(variant_type: str) -> str:
    text = variant_type.replace("OBJECT<", "STRUCT<")
    return "STRING" if text == "VOID" else text


def schema_frame(df: DataFrame) -> DataFrame:
    """The schema of ``df`` as rows: position, column_name, data_type."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def _compare(left: DataFrame, right: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    a = left.select("column_name", F.col("data_type").alias("left_type"), *[F.col(c).alias(f"left_{c}") for c in extra])
    b = right.select(
        "column_name", F.col("data_type").alias("right_type"), *[F.col(c).alias(f"right_{c}") for c in extra]
    )
    status = (
        F.when(F.col("left_type").isNull(), "added")
        .when(F.col("right_type").isNull(), "removed")
        .when(F.col("left_type") != F.col("right_type"), "type_changed")
        .otherwise("same")
    )
    return a.join(b, "column_name", "full").withColumn("status", status)


def compare_schemas(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of two tables side by side: added, removed, type_changed or same."""
    return _compare(schema_frame(left), schema_frame(right))


def schema_drift(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Field drift between two sets of JSON records, with presence counts and their difference."""
    both = _compare(suggest_schema(left, column), suggest_schema(right, column), ["sample_count"])
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("left_sample_count", "right_sample_count")}
    return both.withColumns(counts).withColumn(
        "presence_delta", F.col("right_sample_count") - F.col("left_sample_count")
    )


def override_schema(df: DataFrame, overrides: dict[str, str | None]) -> DataFrame:
    """Cast columns to other types, add missing ones as NULL, drop those mapped to ``None``.

    Values that do not fit become NULL; ``lossy_casts`` counts them.
    """
    dropped = [c for c, t in overrides.items() if t is None]
    cast = {
        c: (F.col(_quoted(c)).try_cast(t) if c in df.columns else F.lit(None).cast(t))
        for c, t in overrides.items()
        if t is not None
    }
    return df.withColumns(cast).drop(*dropped) if cast else df.drop(*dropped)


def lossy_casts(df: DataFrame, overrides: dict[str, str | None]) -> DataFrame:
    """Per overridden column, how many non-NULL values the cast turns into NULL; one pass."""
    names = [c for c, t in overrides.items() if t is not None and c in df.columns]
    if not names:
        raise InvalidSpec("no existing column is cast")
    lost = [
        F.count_if(F.col(_quoted(c)).isNotNull() & F.col(_quoted(c)).try_cast(overrides[c]).isNull()).alias(f"__{i}")
        for i, c in enumerate(names)
    ]
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit(overrides[c]).alias("data_type"), F.col(f"__{i}").alias("lost"))
        for i, c in enumerate(names)
    ]
    return df.agg(*lost).select(F.inline(F.array(*entries)))


def wider_type(a: DataType, b: DataType) -> DataType:
    """The type both fit in: numbers stay numbers, dates widen to timestamps, all else widens to string.

    An int with a float is a double; so is a bigint, and ``evolve`` raises for values that are not exact there.
    """
    if a == b:
        return a
    for x, y in ((a, b), (b, a)):
        if x in _INTEGERS and y in _INTEGERS and _INTEGERS[x] < _INTEGERS[y]:
            return y
        if x in _FLOATS and y in _FLOATS:
            return DoubleType()
        if x in _INTEGERS and y in _FLOATS:
            return y if _INTEGERS[x] <= 5 else DoubleType()
        if isinstance(x, DecimalType):
            if y in _FLOATS:
                return DoubleType()
            digits = _INTEGERS.get(y, y.precision - y.scale if isinstance(y, DecimalType) else None)
            if digits is not None:
                scale = max(x.scale, y.scale if isinstance(y, DecimalType) else 0)
                whole = max(x.precision - x.scale, digits)
                return DecimalType(whole + scale, scale) if whole + scale <= 38 else StringType()
        if isinstance(x, DateType) and isinstance(y, (TimestampType, TimestampNTZType)):
            return y
    return StringType()


def evolve(target: DataFrame, batch: DataFrame, widen: bool = False) -> tuple[DataFrame, DataFrame]:
    """Both frames with the union of their columns; new and missing columns are NULL-filled.

    A column whose type differs is a ``SchemaConflict`` unless ``widen`` allows the wider type.
    """
    types = {f.name: f.dataType for f in target.schema}
    for f in batch.schema:
        if f.name in types and types[f.name] != f.dataType:
            if not widen:
                raise SchemaConflict(
                    f"{f.name}: target {types[f.name].simpleString()}, batch {f.dataType.simpleString()}"
                )
            types[f.name] = wider_type(types[f.name], f.dataType)
        types.setdefault(f.name, f.dataType)

    def column(df: DataFrame, name: str, kind: DataType):
        if name not in df.columns:
            return F.lit(None).cast(kind)
        value = F.col(_quoted(name))
        if isinstance(df.schema[name].dataType, LongType) and isinstance(kind, DoubleType):
            wide = F.raise_error(F.concat(F.lit(f"{name}: not exact as double: "), value.cast("string")))
            return F.when(F.abs(value) > _EXACT, wide.cast("double")).otherwise(value.cast("double"))
        return value.cast(kind)

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(*[column(df, n, t).alias(n) for n, t in types.items()])

    return shaped(target), shaped(batch)


def evolve_union(target: DataFrame, batch: DataFrame, widen: bool = False) -> DataFrame:
    """Rows of both frames under the evolved schema."""
    a, b = evolve(target, batch, widen)
    return a.unionByName(b)


def bucket_count(*frames: DataFrame, target: int = 64 << 20) -> int:
    """Buckets of about ``target`` bytes for the largest of some tables, by what their rows take in a task that sorts them.

    The planner's sizes are those of compressed files, of which a bucket may hold many times as much. So rows are
    counted, and the lengths of what has no fixed width are added up, in one aggregate over each frame.
    """
    return min(max(1, -(-max(_sorted_size(f) for f in frames) // max(target, 1))), _MOST_BUCKETS)


def _sorted_size(df: DataFrame) -> int:
    """Bytes of all rows as Spark sorts them: a pointer and prefix, 8 bytes for each field, and text and nested values."""
    fixed = (NumericType, DateType, TimestampType, TimestampNTZType, BooleanType)
    loose = [f for f in df.schema if not isinstance(f.dataType, fixed)]
    length = F.lit(0).cast("long")
    for field in loose:
        value = F.col(_quoted(field.name))
        if not isinstance(field.dataType, (StringType, BinaryType)):
            value = value.cast("string")
        length = length + F.coalesce(F.octet_length(value), F.lit(0))
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(length), F.lit(0)).alias("loose")).first()
    return found["rows"] * (24 + 8 * len(df.columns)) + found["loose"]


def size_of(df: DataFrame) -> int:
    """Bytes of a frame as the planner estimates them."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def write_layout(
    df: DataFrame,
    table: str,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
    sort_by: Sequence[str] = (),
    range_by: Sequence[str] = (),
) -> None:
    """Write the same rows as a table with another physical layout.

    ``range_by`` clusters files by value ranges (tight min/max statistics; a frequent value is spread over several
    by a hash of the row), ``bucket_by`` lets later
    joins on the bucket columns skip their shuffle, ``partition_by`` makes one folder per value. Rows
    are rebalanced, not hash-partitioned, towards partition folders: a folder with a third of all
    rows is written by many tasks.
    """
    if range_by:
        plain = [_quoted(f.name) for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
        df = df.repartitionByRange(*range_by, F.xxhash64(*plain))
    elif bucket_by:
        # As many shuffle partitions as buckets: each holds one bucket, and only an oversized one
        # is split into several files.
        df = df.hint("rebalance", bucket_by[0], *bucket_by[1])
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by and not bucket_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer: DataFrameWriter = df.write.format("parquet").mode("overwrite")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(bucket_by[0], *bucket_by[1])
        if sort_by:
            writer = writer.sortBy(*sort_by)
    writer.saveAsTable(table)


def curve_place(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """Where a row lies on a Z-order curve over the quantile ranks of some columns.

    Each column is cut at 2**``bits`` - 1 quantiles, found in one aggregate over the frame, so skewed values fill the
    curve evenly; bits of the ranks take turns. Numbers, dates and timestamps only. NULL ranks lowest, NaN highest.
    """
    if not columns or not 1 <= bits * len(columns) <= 62:
        raise InvalidSpec(f"a curve needs columns, and at most 62 bits for all of them: {list(columns)}")
    numbers = [_number(df.schema[c]) for c in columns]
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = df.agg(*(F.percentile_approx(n, shares, 10_000).alias(f"q{k}") for k, n in enumerate(numbers))).first()
    place = F.lit(0).cast("long")
    for k, number in enumerate(numbers):
        rank = F.lit(0)
        for cut in cuts[k] or []:
            rank = rank + F.coalesce((number >= F.lit(cut)).cast("int"), F.lit(0))
        rank = rank.cast("long")
        for bit in range(bits):
            shifted = F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), bit * len(columns) + len(columns) - 1 - k)
            place = place + shifted
    return place


def _number(field: StructField) -> Column:
    """The column as a double in the same order."""
    column, kind = F.col(_quoted(field.name)), field.dataType
    if isinstance(kind, DateType):
        column = F.unix_date(column)
    elif isinstance(kind, (TimestampType, TimestampNTZType)):
        column = F.unix_micros(column.cast("timestamp"))
    elif not isinstance(kind, NumericType):
        raise InvalidSpec(f"a curve cannot order {field.name} of type {kind.simpleString()}")
    return column.cast("double")


def write_curve(
    df: DataFrame, table: str, columns: Sequence[str], path: str | None = None, target: int = 128 << 20
) -> None:
    """Write the rows as files of about ``target`` bytes that follow a curve over several columns.

    Every file then has narrow ranges of all of these columns in its statistics, and a filter on any of them skips
    files. The number of files comes from the planner's size of the frame, so small files are packed and large ones
    divided; rows at one place of the curve are spread over several files by a hash of the row if they are many.
    """
    plain = [_quoted(f.name) for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
    files = max(1, -(-size_of(df) // max(target, 1)))
    place = curve_place(df, columns)
    placed = df.repartitionByRange(files, place, F.xxhash64(*plain))
    writer = placed.write.format("parquet").mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
