"""Exact top-k inner-product search by pivot-table elimination.

``|q - x|^2 = |q|^2 + |x|^2 - 2 q.x``, so the largest inner products are
found from distances.  A table of distances to a fixed number of pivots
gives, by the triangle inequality, ``|q - x| >= max_p |d(q,p) - d(x,p)|``
and so an upper bound of every score.  Candidates are evaluated in bound
order until the k-th score found is above every bound that is left; what is
returned is therefore exact.

Shape: both sides are cut into blocks by a hash of the row (a block has at
most about ``block_rows`` rows, so a task's memory is fixed), each pair
(query block, candidate block) is one group, and the per-block top k are
merged by a partial, then final top k.  The query set is a stated part of
the rows and goes against all rows in blocks; no pair rows are made.

Pivots: ``pivots`` rows picked by a farthest-first walk over a hash-ordered
sample of at most ``pivot_sample`` rows (a documented bound; the pivots
decide only how much is skipped, never the result).

Cases: vectors that are null, of another length than ``dim`` (the most
frequent length), or that hold null or non-finite components take no part,
as query or candidate; null ids take no part; a query never meets rows of
its own id; fewer than k candidates give fewer rows; equal scores rank by
the smaller id; repeated rows with one id are one candidate if equal;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kestrel.session import ensure_shipped

BATCH = 256  # candidates scored at a time


def farthest_first(x: np.ndarray, k: int) -> np.ndarray:
    """k rows of x, each the farthest from those before it."""
    if not len(x):
        return x
    chosen, far = [0], np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < min(k, len(x)):
        i = int(far.argmax())
        if far[i] == 0:
            break
        chosen.append(i)
        far = np.minimum(far, np.linalg.norm(x - x[i], axis=1))
    return x[chosen]


def _dist(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * x @ p.T
    return np.sqrt(np.maximum(d2, 0))


def search_block(qid, q, cid, c, pivots, k: int):
    """Exact top k of each query within one candidate block, by bound order.
    Returns (query ids, candidate ids, scores, rows evaluated)."""
    out_q, out_c, out_s, seen = [], [], [], 0
    dq, dc = _dist(q, pivots), _dist(c, pivots)
    nq, nc = (q * q).sum(1), (c * c).sum(1)
    for i in range(len(q)):
        low = np.abs(dc[:, 0] - dq[i, 0])
        for p in range(1, pivots.shape[0]):
            np.maximum(low, np.abs(dc[:, p] - dq[i, p]), out=low)
        bound = (nq[i] + nc - low * low) / 2
        bound += 1e-9 * (nq[i] + nc) + 1e-6  # rounding of the distances
        bound[cid == qid[i]] = -np.inf
        best_s, best_c = np.empty(0), np.empty(0, np.int64)
        todo, take = np.arange(len(c)), BATCH
        while len(todo):
            # the next `take` bounds; what is below the k-th score is done with
            if len(todo) > take:
                part = np.argpartition(-bound[todo], take)
                now, todo = todo[part[:take]], todo[part[take:]]
            else:
                now, todo = todo, todo[:0]
            now = now[bound[now] > -np.inf]
            seen += len(now)
            best_s = np.concatenate([best_s, c[now] @ q[i]])
            best_c = np.concatenate([best_c, cid[now]])
            order = np.lexsort((best_c, -best_s))[:k]
            best_s, best_c = best_s[order], best_c[order]
            if len(best_s) == k:
                todo = todo[bound[todo] >= best_s[-1]]
            take *= 2
        out_q.append(np.full(len(best_s), qid[i]))
        out_c.append(best_c)
        out_s.append(best_s)
    return np.concatenate(out_q), np.concatenate(out_c), np.concatenate(out_s), seen


def pivot_search(rows: DataFrame, is_query: Column, vector: Column, id_col: str = "vec_id", k: int = 5,
                 pivots: int = 24, pivot_sample: int = 4096, block_rows: int = 8192) -> DataFrame:
    """Top ``k`` rows by inner product of ``vector`` (array<double>) for each
    row where ``is_query`` holds: query_id, rank, vec_id, score (double)."""
    spark = rows.sparkSession
    ensure_shipped(spark)
    v = rows.select(F.col(id_col).cast("long").alias("id"), vector.cast("array<double>").alias("v"),
                    F.coalesce(is_query, F.lit(False)).alias("is_query"))
    ok = v.where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall(
        "v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))
    # the sizes, and the most frequent vector length (a row for each length)
    sizes = ok.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.sum(F.col("is_query").cast("long")).alias("q"))
    top = sizes.where("dim > 0").orderBy(F.desc("n"), "dim").limit(1).collect()
    empty = "query_id long, rank int, vec_id long, score double"
    if not top:
        return spark.createDataFrame([], empty)
    dim, n, nq = top[0]["dim"], top[0]["n"], top[0]["q"] or 0
    ok = ok.where(F.size("v") == dim)
    sample = ok.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(pivot_sample).select("v").toPandas()
    piv = farthest_first(np.array(sample["v"].tolist(), float).reshape(-1, dim), pivots)
    cblocks, qblocks = max(1, math.ceil(n / block_rows)), max(1, math.ceil(nq / block_rows))

    def blocks(df, count, other, name, against):
        """Rows of a block for each block of the other side."""
        return (df.withColumn(name, F.pmod(F.xxhash64("id"), F.lit(count)).cast("int"))
                .withColumn(against, F.explode(F.sequence(F.lit(0), F.lit(other - 1)))))

    cand = blocks(ok.select("id", "v").distinct(), cblocks, qblocks, "cb", "qb")
    query = blocks(ok.where("is_query").select("id", "v").distinct(), qblocks, cblocks, "qb", "cb")

    def columns(t: pa.Table):
        vec = t.column("v").combine_chunks()
        flat = vec.flatten().to_numpy(zero_copy_only=False)
        return t.column("id").to_numpy(), flat.reshape(-1, dim)

    def tile(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            got = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        else:
            got = search_block(*columns(q), *columns(c), piv, k)[:3]
        return pa.table({"query_id": pa.array(got[0], pa.int64()), "vec_id": pa.array(got[1], pa.int64()),
                         "score": pa.array(got[2], pa.float64())})

    found = (query.groupBy("qb", "cb").cogroup(cand.groupBy("qb", "cb"))
             .applyInArrow(tile, "query_id long, vec_id long, score double"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
