"""Records (JSON text or Python dicts) as typed rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablekit.errors import NoData

_BAD = "_corrupt_record"


def _schema(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def parse_records(
    df: DataFrame, column: str, schema: StructType | str, keep: Iterable[str] = (), bad_column: str | None = None
) -> DataFrame:
    """Parse a JSON text column on the executors. Absent keys become NULL.

    ``keep`` carries columns of ``df`` along. With ``bad_column`` the text of unparsable records is
    kept there (all other fields NULL), so they can be counted instead of vanishing.
    """
    wanted = _schema(schema)
    full = StructType([*wanted.fields, StructField(_BAD, StringType())])
    parsed = F.from_json(F.col(column), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    rows = df.select(*keep, parsed.alias("__r"))
    out = [F.col(f"__r.`{f.name}`").alias(f.name) for f in wanted.fields]
    if bad_column:
        out.append(F.col(f"__r.{_BAD}").alias(bad_column))
    return rows.select(*keep, *out)


def register_records(
    spark: SparkSession, name: str, df: DataFrame, column: str, schema: StructType | str
) -> DataFrame:
    """``parse_records`` published as a temporary view."""
    parsed = parse_records(df, column, schema)
    parsed.createOrReplaceTempView(name)
    return parsed


def literal_records(
    spark: SparkSession, rows: Mapping | Iterable[Mapping], schema: StructType | str
) -> DataFrame:
    """A handful of Python dicts (or one dict) as rows: ragged keys become NULL, nothing is ``NoData``."""
    rows = [rows] if isinstance(rows, Mapping) else list(rows)
    if not rows:
        raise NoData("no records given")
    wanted = _schema(schema)
    return spark.createDataFrame([tuple(r.get(n) for n in wanted.names) for r in rows], wanted)
