"""Staging-table scan: a table with upper-cased column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators.relational import rename_upper


def staging_scan(src: DataFrame | str, spark: SparkSession | None = None,
                 order_by: str | None = None) -> DataFrame:
    """Read a table (name or DataFrame), upper-case its column names and,
    only when the caller needs ordered output, sort by ``order_by``."""
    df = spark.read.table(src) if isinstance(src, str) else src
    df = rename_upper(df)
    return df.orderBy(F.col(order_by)) if order_by else df
