"""Database scans over JDBC (the SELECT runs in the database)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_query_scan(spark: SparkSession, url: str, sql: str | None = None, table: str | None = None,
                    user: str | None = None, password: str | None = None, driver: str | None = None,
                    partition_column: str | None = None, lower: int | None = None,
                    upper: int | None = None, num_partitions: int | None = None,
                    fetchsize: int = 10_000, single_task: bool = False) -> DataFrame:
    """Rows of a SELECT (``sql``) or a table, upper-cased names.  With
    ``partition_column`` and bounds the read is split into
    ``num_partitions`` range queries; the SELECT is then wrapped as a
    derived table (the ``query`` option and partitioning exclude each
    other).  A read through one task must be asked for (``single_task``)."""
    if (sql is None) == (table is None):
        raise ValueError("give exactly one of sql / table")
    if partition_column is None and not single_task:
        raise ValueError("give partition_column with lower and upper, or single_task=True for a small result")
    if partition_column is not None and (lower is None or upper is None):
        raise ValueError("partition_column needs lower and upper")
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", fetchsize)
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            r = r.option(k, v)
    if partition_column:
        src = table if table else f"({sql}) q"
        r = (r.option("dbtable", src).option("partitionColumn", partition_column)
             .option("lowerBound", lower).option("upperBound", upper)
             .option("numPartitions", num_partitions or 8))
    elif table:
        r = r.option("dbtable", table)
    else:
        r = r.option("query", sql)
    df = r.load()
    return df.toDF(*[c.upper() for c in df.columns])
