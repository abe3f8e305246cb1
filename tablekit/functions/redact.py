"""Redaction of values under sensitive keys, in maps and nested structs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

# Words that make a key sensitive when it contains one of them in any case.
ENVIRONMENT_WORDS = ("PASSWORD", "SECRET", "TOKEN", "KEY", "CREDENTIAL", "API")
CONFIG_WORDS = ("password", "secret", "token", "key", "credential", "api_key", "apikey")
# Fixed value: what replaces a sensitive value.
MASK = "***REDACTED***"


def _sensitive_name(name: str, words: Sequence[str]) -> bool:
    return any(w.lower() in name.lower() for w in words)


def _sensitive(name: Column, words: Sequence[str]) -> Column:
    """The same for names that are data; words are plain text."""
    tests = [F.contains(F.lower(name), F.lit(w.lower())) for w in words]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _redacted(column: Column, dtype: DataType, words: Sequence[str]) -> Column:
    if isinstance(dtype, StructType):
        fields = [
            (
                _masked(column[f.name], f.dataType)
                if _sensitive_name(f.name, words)
                else _redacted(column[f.name], f.dataType, words)
            ).alias(f.name)
            for f in dtype
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(dtype, ArrayType) and isinstance(dtype.elementType, (StructType, MapType, ArrayType)):
        return F.transform(column, lambda x: _redacted(x, dtype.elementType, words))
    if isinstance(dtype, MapType):
        return F.transform_values(
            column,
            lambda k, v: F.when(
                _sensitive(k.cast("string"), words), _masked(v, dtype.valueType)
            ).otherwise(_redacted(v, dtype.valueType, words)),
        )
    return column


def _masked(column: Column, dtype: DataType) -> Column:
    # Only text can hold the mask; a sensitive value of another type is removed.
    return F.lit(MASK) if isinstance(dtype, StringType) else F.lit(None).cast(dtype)


def redact(df: DataFrame, columns: Sequence[str] | None = None, words: Sequence[str] = CONFIG_WORDS) -> DataFrame:
    """Mask values under sensitive keys: columns of such a name, and what map, struct and array columns hold.

    Column types do not change: strings become the mask, other types NULL. ``columns`` limits what is looked at.
    """
    chosen = [f for f in df.schema if columns is None or f.name in columns]
    changed = {}
    for f in chosen:
        column = F.col(f"`{f.name}`")
        if _sensitive_name(f.name, words):
            changed[f.name] = _masked(column, f.dataType)
        elif isinstance(f.dataType, (StructType, MapType, ArrayType)):
            changed[f.name] = _redacted(column, f.dataType, words)
    return df.withColumns(changed) if changed else df


def redact_pairs(pairs: Column, words: Sequence[str] = ENVIRONMENT_WORDS) -> Column:
    """An array of ``KEY=value`` texts as a map with sensitive values masked; the last duplicate wins."""
    def key(pair: Column) -> Column:
        return F.substring_index(pair, "=", 1)

    def entry(pair: Column) -> Column:
        value = F.when(_sensitive(key(pair), words), F.lit(MASK)).otherwise(
            F.when(F.instr(pair, "=") > 0, F.substr(pair, F.instr(pair, "=") + 1)).otherwise(F.lit(""))
        )
        return F.struct(key(pair).alias("key"), value.alias("value"))

    entries = F.transform(pairs, entry)
    # Keep an entry only if no later one has its key: map construction rejects duplicates.
    last = F.filter(
        entries,
        lambda e, i: ~F.exists(
            F.slice(entries, i + 2, F.array_size(entries)), lambda later: later["key"] == e["key"]
        ),
    )
    return F.map_from_entries(last)
