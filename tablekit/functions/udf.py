"""User functions: Arrow-batched Python scalars and SQL expressions."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def register_scalar(spark: SparkSession, name: str, function: Callable[..., pd.Series], return_type: str):
    """Register a callable over pandas Series as SQL function ``name``; returns it for DataFrame use."""
    return spark.udf.register(name, F.pandas_udf(function, returnType=return_type))


def register_sql(spark: SparkSession, name: str, arguments: str, return_type: str, body: str) -> None:
    """Register a SQL expression as a function. Catalyst inlines it: no Python, pushdown still works."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {return_type} RETURN {body}")
