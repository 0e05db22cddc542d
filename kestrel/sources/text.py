"""Whole-file text documents and page folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def text_document_scan(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``page_content`` (whole file) and ``metadata``
    {'source': file path}."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.col("value").alias("page_content"),
                     F.create_map(F.lit("source"), F.input_file_name()).alias("metadata"))


def page_scan(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Pages as (url, html): a Parquet table, or a folder of html files
    (``fmt='files'``, one row per file, url = file path)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    b = spark.read.format("binaryFile").option("pathGlobFilter", "*.htm*").load(path)
    return b.select(F.col("path").alias("url"), F.decode("content", "utf-8").alias("html"))
