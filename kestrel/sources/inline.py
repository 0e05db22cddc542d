"""Literal tables and generated sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def inline_table(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A small literal table (lookup lists, samples)."""
    return spark.createDataFrame(rows, schema)


def sequence_source(spark: SparkSession, n: int, mean: float = 10.0, sd: float = 1.0,
                    seed: int = 0, partitions: int | None = None) -> DataFrame:
    """x = 0..n-1 with y ~ normal(mean, sd), generated in parallel
    (repeatable for a fixed partition count and seed)."""
    r = spark.range(0, n, numPartitions=partitions) if partitions else spark.range(n)
    return r.select(F.col("id").alias("x"), (F.randn(seed) * sd + mean).alias("y"))
