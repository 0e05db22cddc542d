"""Global running sums without a single-partition window.

``Window.orderBy(k)`` with no ``partitionBy`` plans an
``Exchange SinglePartition``: every row goes through one task.  Here the
key range is cut into buckets at approximate quantiles (one small
aggregate job), each bucket is summed on its own (a row per bucket, joined
back: Spark broadcasts it while it is small), and the running sum inside a bucket
is a window partitioned by the bucket.  Buckets hold about the same number
of distinct keys, so the work spreads over ``n_keys / keys_per_bucket``
tasks.

The input must have one row per key (group first): a hot key is then a
single row and cannot skew a bucket.
"""

from __future__ import annotations

import math
import sys

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_kestrel_bucket"
DEFAULT_KEYS_PER_BUCKET = 2_000_000
MIN_KEYS_PER_BUCKET = 50_000
FINE = 256


def known(df: DataFrame, col: str) -> Column:
    """Neither NULL nor NaN."""
    c = F.col(col)
    floating = isinstance(df.schema[col].dataType, (T.FloatType, T.DoubleType))
    return c.isNotNull() & ~F.isnan(c) if floating else c.isNotNull()


def bucket_splits(df: DataFrame, key: str, keys_per_bucket: int = DEFAULT_KEYS_PER_BUCKET) -> list[float]:
    """Inner split points (strictly increasing) so that each bucket holds
    at most about ``keys_per_bucket`` keys, and -- while buckets keep at
    least MIN_KEYS_PER_BUCKET keys -- there are enough buckets to occupy
    every core.  The number of buckets follows from the number of keys
    alone.  One job gives count and quantiles together; only beyond
    FINE buckets does a second one ask for finer quantiles."""
    k = F.col(key).cast("double")

    def quantiles(n: int):
        probs = [i / n for i in range(1, n)]
        r = df.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(k, probs, 10 * n).alias("q")).first()
        return r["n"], r["q"] or []

    n, fine = quantiles(FINE)
    cores = df.sparkSession.sparkContext.defaultParallelism
    nb = max(1, math.ceil(n / max(1, keys_per_bucket)), min(cores, n // MIN_KEYS_PER_BUCKET))
    if nb > FINE:
        fine = quantiles(nb)[1]
    out: list[float] = []
    for i in range(1, nb):
        v = fine[max(0, round(i * (len(fine) + 1) / nb) - 1)] if fine else None
        if v is not None and not math.isnan(v) and (not out or v > out[-1]):
            out.append(float(v))
    return out


def with_bucket(df: DataFrame, key: str, splits: list[float]) -> DataFrame:
    """Add the bucket number of ``key`` (binary search, JVM side).  Even
    with one bucket the value comes from the Bucketizer, so joins on it
    stay equi-joins (a literal would be folded into a cross join)."""
    tmp = "_kestrel_key_double"
    inner = list(splits) or [sys.float_info.max]  # Bucketizer needs ≥ 3 split points
    b = Bucketizer(splits=[-math.inf, *inner, math.inf], inputCol=tmp, outputCol=BUCKET,
                   handleInvalid="keep")
    return b.transform(df.withColumn(tmp, F.col(key).cast("double"))).drop(tmp)


def running_sums(df: DataFrame, key: str, values: dict[str, Column | str], *,
                 splits: list[float] | None = None,
                 keys_per_bucket: int = DEFAULT_KEYS_PER_BUCKET,
                 with_totals: bool = False, bucketed: bool = False,
                 keep_bucket: bool = False, group: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Append inclusive running sums ordered by ``key`` ascending.

    ``values`` maps output name → column to sum.  With ``with_totals`` the
    grand total of each value is added as ``<name>_total`` (for descending
    forms: ``total - inclusive`` = strictly greater).  ``df`` is read
    twice (bucket totals, then the window); persist it when it is costly.
    ``bucketed`` means ``df`` already carries the bucket column from an
    earlier pass (kept with ``keep_bucket``): its cached partitioning and
    order by (bucket, key) are then reused without a new exchange.
    ``group`` restarts the sums per group (one row per (group, key) in
    ``df``): buckets are shared, offsets are per (group, bucket) -- a table
    of at most #groups × #buckets rows, joined (broadcast only when Spark
    finds it small).
    """
    group = list(group)
    if bucketed:
        tagged = df
    else:
        if splits is None:
            splits = bucket_splits(df, key, keys_per_bucket)
        tagged = with_bucket(df, key, splits)
    names = list(values)
    vals = {n: (F.col(c) if isinstance(c, str) else c) for n, c in values.items()}
    tagged = tagged.select("*", *[vals[n].alias(f"_v_{n}") for n in names])

    totals = tagged.groupBy(*group, BUCKET).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names])
    by = [F.col(g) for g in group] or [F.lit(1)]
    before = Window.partitionBy(*by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = totals.select(
        *group, BUCKET,
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in names],
        *([F.sum(f"_t_{n}").over(whole).alias(f"{n}_total") for n in names] if with_totals else []))

    inside = Window.partitionBy(*group, BUCKET).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    out = tagged.join(offsets, [*group, BUCKET])  # ≤ #groups × #buckets rows
    out = out.select("*", *[(F.col(f"_o_{n}") + F.sum(f"_v_{n}").over(inside)).alias(n) for n in names])
    drop = ([] if keep_bucket else [BUCKET]) + [f"_v_{n}" for n in names] + [f"_o_{n}" for n in names]
    return out.drop(*drop)
