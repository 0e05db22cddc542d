"""Connected components of an edge table.

Each round every node hooks onto its smallest neighbour if that is smaller
than itself, and the edges move to the parents; equal edges collapse.  Node
keys are hashes, so a round removes a constant share of the nodes of every
component.  Rounds are written to the shared folder; the labels are then
composed from the last round back to the first.  A hub is one row per task
in the aggregations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, path: str) -> DataFrame:
    """Columns key and label (the smallest key of its component) for every
    key of ``edges`` (a, b); null keys are left out."""
    spark = edges.sparkSession
    kind = edges.schema["a"].dataType.simpleString()
    edges.where("a < b").select("a", "b").union(edges.where("b < a").select("b", "a")).distinct().write.parquet(f"{path}/e0")
    rounds = 0
    while True:
        e = spark.read.schema(f"a {kind}, b {kind}").parquet(f"{path}/e{rounds}")
        if e.isEmpty():
            break
        both = e.select(F.col("b").alias("key"), F.col("a").alias("to")).union(e.select(F.col("a").alias("key"), F.col("a").alias("to")))
        both.groupBy("key").agg(F.min("to").alias("to")).write.parquet(f"{path}/p{rounds}")
        p = spark.read.schema(f"key {kind}, to {kind}").parquet(f"{path}/p{rounds}")
        moved = (e.join(p.select(F.col("key").alias("a"), F.col("to").alias("x")), "a")
                 .join(p.select(F.col("key").alias("b"), F.col("to").alias("y")), "b")
                 .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a < b").distinct())
        rounds += 1
        moved.write.parquet(f"{path}/e{rounds}")
    if not rounds:
        return spark.createDataFrame([], f"key {kind}, label {kind}")
    labels = spark.read.schema(f"key {kind}, to {kind}").parquet(f"{path}/p{rounds - 1}").withColumnRenamed("to", "label")
    for k in range(rounds - 2, -1, -1):
        p = spark.read.schema(f"key {kind}, to {kind}").parquet(f"{path}/p{k}")
        labels = (p.join(labels.select(F.col("key").alias("to"), "label"), "to", "left")
                  .select("key", F.coalesce("label", "to").alias("label")))
    labels.write.parquet(f"{path}/labels")  # read more than once, and a long chain of joins
    return spark.read.schema(f"key {kind}, label {kind}").parquet(f"{path}/labels")
