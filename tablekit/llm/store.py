"""Intermediate tables in the shared folder, and their removal."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

from tablekit.session import scratch_path


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tablekit-"), "tablekit.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


class Shelf:
    """Tables written by one run of an operator.

    ``put`` writes a table and reads it back, which cuts its lineage durably: a lost executor re-reads files.
    ``drop`` deletes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        ship(spark)
        self.spark, self.root = spark, scratch_path(spark, label)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def text_bytes(docs: DataFrame, column: str) -> int:
    """Total bytes of a text column; one aggregate over lengths."""
    from pyspark.sql import functions as F

    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
