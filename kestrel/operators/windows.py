"""Ranking and running-total windows that stay distributed.

Global orderings use ``prefix.running_sums`` over one row per distinct key
(ties collapse first), so no step plans a single-partition exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators import prefix
from kestrel.operators.skew import hot_key_join
from kestrel.session import keep


def rank_average_desc(df: DataFrame, col: str, out: str = "rank",
                      keys_per_bucket: int = prefix.DEFAULT_KEYS_PER_BUCKET) -> DataFrame:
    """Descending rank with ties given the mean of their ranks
    (N_greater + (n_equal+1)/2).  Rows with NULL or NaN ``col`` are dropped
    first."""
    base = df.where(prefix.known(df, col))
    g = keep(base.groupBy(col).agg(F.count(F.lit(1)).alias("_n")))
    s = prefix.running_sums(g, col, {"_cum": "_n"}, keys_per_bucket=keys_per_bucket, with_totals=True)
    r = s.select(col, "_n", ((F.col("_cum_total") - F.col("_cum")).cast("double")
                             + (F.col("_n").cast("double") + 1.0) / 2.0).alias(out))
    return hot_key_join(base, r, [col], "_n")


def cumulative_sum_ties(df: DataFrame, key: str, value: str | Column, out: str = "cum_sum",
                        per_row: bool = False,
                        keys_per_bucket: int = prefix.DEFAULT_KEYS_PER_BUCKET) -> DataFrame:
    """Running sum of ``value`` ordered by ``key`` where equal keys share
    one total (RANGE frame semantics, unlike a row-wise cumsum).  One row
    per distinct key, or every input row when ``per_row``."""
    v = F.col(value) if isinstance(value, str) else value
    base = df.where(prefix.known(df, key))
    g = keep(base.groupBy(key).agg(F.sum(v).alias("_s"), F.count(F.lit(1)).alias("_n")))
    s = prefix.running_sums(g, key, {out: "_s"}, keys_per_bucket=keys_per_bucket).drop("_s")
    return hot_key_join(base, s, [key], "_n") if per_row else s.drop("_n")


def dense_row_index(df: DataFrame, order: list[str | Column], out: str = "index") -> DataFrame:
    """0..n-1 row index in ``order`` (add a unique tie-break column for a
    repeatable result).  The range-partitioned sort is checkpointed to the
    shared folder so partition ids are stable; per-partition counts (one
    row per partition) give the offsets, broadcast back."""
    from kestrel.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    sorted_ = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()) \
        .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    counts = sorted_.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    offs = counts.select("_pid", F.coalesce(F.sum("_c").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (sorted_.join(F.broadcast(offs), "_pid")  # one row per partition
            .withColumn(out, (F.col("_off") + pos).cast("bigint"))
            .drop("_mid", "_pid", "_off"))


def bin_width(edges: DataFrame, edge: str = "edge", out: str = "width") -> DataFrame:
    """Width of each bin = next edge − edge (last edge has none).  Edge
    tables are small and bounded by the bin count, so one window is fine."""
    w = Window.orderBy(edge)
    return edges.withColumn(out, F.lead(edge).over(w) - F.col(edge))
