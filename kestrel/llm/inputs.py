"""Inputs that queries and the pipeline share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.sources.tables import table


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the documents labelled as good."""
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
