"""Parquet table access for the driver-generated test tables and any
table folder laid out as ``<dir>/<name>.parquet``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; Catalyst pushes filters and prunes columns."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Register every table as a temp view (for ``spark.sql`` users)."""
    for n in TABLES:
        table(spark, sf_dir, n).createOrReplaceTempView(n)
