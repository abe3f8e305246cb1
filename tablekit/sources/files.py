"""File sources: one reader per format, globs, listings and remote paths."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablekit.errors import SchemaConflict, UnsupportedFormat

# File suffix -> Spark reader name.
FORMATS = {".csv": "csv", ".json": "json", ".parquet": "parquet"}

# URL scheme -> scheme the Hadoop connectors answer to.
SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3a", "s3a": "s3a"}


def format_of(path: str, fmt: str = "auto") -> str:
    """The reader for ``path``: the explicit ``fmt``, else the suffix, else ``UnsupportedFormat``."""
    if fmt != "auto":
        if fmt not in FORMATS.values():
            raise UnsupportedFormat(f"format {fmt!r}; expected one of {sorted(FORMATS.values())}")
        return fmt
    for suffix, name in FORMATS.items():
        if path.lower().rstrip("/").endswith(suffix):
            return name
    raise UnsupportedFormat(f"cannot tell the format of {path!r}; pass fmt=")


def scan(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "auto",
    schema: StructType | str | None = None,
    multiline: bool = False,
    **options: str,
) -> DataFrame:
    """A file, folder or glob as a table. Give ``schema`` for csv/json: inference reads the data twice.

    A CSV file's columns are matched to the schema by the names in its header; all files of a folder must have the
    same header. Columns that the schema lacks are left out, ones that the file lacks are an error.

    ``multiline`` reads JSON files that hold one array (or CSV fields with line breaks); such a file
    cannot be split, so keep those files small.
    """
    first = path if isinstance(path, str) else path[0]
    name = format_of(first, fmt)
    reader = spark.read.format(name).options(**options)
    wanted = None
    if schema is not None:
        if name == "csv" and str(options.get("header", True)).lower() == "true":
            wanted, schema = _by_header(spark, path, schema, multiline, options)
            reader = reader.option("enforceSchema", False)
        reader = reader.schema(schema)
    if name == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
    if name in ("csv", "json") and multiline:
        reader = reader.option("multiLine", True)
    loaded = reader.load(path)
    return loaded if wanted is None else loaded.select(*[f"`{c}`" for c in wanted])


def _by_header(
    spark: SparkSession, path: str | list[str], schema: StructType | str, multiline: bool, options: dict
) -> tuple[list[str], StructType]:
    """The schema's column names, and its fields in the order of the files' header (of which one line is read)."""
    expected = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    header = spark.read.options(**options).option("header", True).option("multiLine", multiline).csv(path).columns
    if not header:  # no file has any line
        return expected.names, expected
    corrupt = options.get("columnNameOfCorruptRecord", "_corrupt_record")  # filled by the reader, in no file
    missing = [f.name for f in expected if f.name not in header and f.name != corrupt]
    if missing:
        raise SchemaConflict(f"no such columns in the csv header: {missing}")
    types = {f.name: f for f in expected}
    fields = [types.get(c) or StructField(c, StringType()) for c in header]
    if corrupt in types:
        fields.append(types[corrupt])
    return expected.names, StructType(fields)


def scan_glob(
    spark: SparkSession,
    directory: str,
    pattern: str,
    fmt: str = "auto",
    schema: StructType | str | None = None,
    recursive: bool = False,
    source_column: str | None = None,
    **options: str,
) -> DataFrame:
    """All files in ``directory`` (``recursive``: below it) whose name matches ``pattern``, optionally with their path.

    A folder in ``directory`` whose name matches is a table of many files, as Spark writes it: all of them are read.
    ``recursive`` goes by the names of files only.
    """
    name = format_of(pattern, fmt)
    tables = [] if recursive else _matching(spark, directory, pattern)
    if tables:
        df = scan(spark, tables, name, schema, **options)
    else:
        lookup = str(recursive).lower()
        df = scan(spark, directory, name, schema, pathGlobFilter=pattern, recursiveFileLookup=lookup, **options)
    return df.withColumn(source_column, F.col("_metadata.file_path")) if source_column else df


def _matching(spark: SparkSession, directory: str, pattern: str) -> list[str]:
    """Files and folders in a directory whose name matches; none if no folder does."""
    path = spark._jvm.org.apache.hadoop.fs.Path(directory, pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    shown = [status for status in found if not status.getPath().getName().startswith(("_", "."))]
    if not any(status.isDirectory() for status in shown):
        return []
    return [re.sub(r"([\\{}\[\]*?])", r"\\\1", status.getPath().toString()) for status in shown]


def remote_path(url: str) -> str:
    """Map an object-store URL to the scheme Spark's connectors use; other schemes are an error."""
    scheme, sep, rest = url.partition("://")
    if not sep:
        return url
    if scheme.lower() not in SCHEMES:
        raise UnsupportedFormat(f"scheme {scheme!r}; expected one of {sorted(SCHEMES)} (http: see scan_url)")
    return f"{SCHEMES[scheme.lower()]}://{rest}"


def scan_remote(spark: SparkSession, url: str, fmt: str = "auto", schema=None, **options: str) -> DataFrame:
    """A csv or parquet file in an object store or behind http(s)."""
    if url.lower().startswith(("http://", "https://")):
        from tablekit.sources.rest import scan_url

        return scan_url(spark, url, format_of(url, fmt), schema)
    return scan(spark, remote_path(url), fmt, schema, **options)


def list_files(spark: SparkSession, directory: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """File path, size and modification time as rows; file contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return reader.option("recursiveFileLookup", recursive).load(directory).select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified_at")
    )
