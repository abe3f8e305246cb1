"""Bounded training samples: the rows with the smallest hashes of their ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as the text ''."""
    return (F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 5).cast("int")


def smallest(df: DataFrame, id_col: str, most: int, salt: int = 0) -> DataFrame:
    """At most ``most`` distinct ids, those whose hash is smallest: the same at every partitioning."""
    hashed = df.select(F.col(f"`{id_col}`").alias("sample_id"), F.xxhash64(F.col(f"`{id_col}`"), F.lit(salt)).alias("h"))
    return hashed.distinct().orderBy("h", "sample_id").limit(most).select("sample_id")
