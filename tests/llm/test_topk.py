"""Pivot search against brute force."""

import numpy as np
from pyspark.sql import functions as F

from kestrel.llm.topk import pivot_search, search_block


def brute(rows, queries, k):
    out = []
    for qi, q in rows:
        if qi in queries:
            best = sorted({(-float(np.dot(q, v)), i) for i, v in rows if i != qi})[:k]
            out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def test_blocks_are_exact_and_stop_early():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(10, 8)) * 20
    x = np.floor(centres[rng.integers(0, 10, 3000)] + rng.normal(size=(3000, 8)))
    ids = np.arange(3000)
    q, c, s, seen = search_block(ids[:40], x[:40], ids, x, centres, 5)
    assert seen < 0.6 * 40 * 3000
    full = x[:40] @ x.T
    for i in range(40):
        full[i, i] = -np.inf
        order = np.lexsort((ids, -full[i]))[:5]
        assert c[q == i].tolist() == order.tolist() and s[q == i].tolist() == full[i, order].tolist()


def test_search_with_ties_and_blocks(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.integers(-2, 3, 4)]) for i in range(300)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, v array<double>, rank string").repartition(5)
    got = pivot_search(df, F.col("vec_id") % 10 == 0, F.col("v"), k=5, block_rows=64).collect()
    assert sorted(map(tuple, got)) == brute(rows, set(range(0, 300, 10)), 5)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, [2.0, 2.0]), (6, [1.0]), (7, []), (None, [1.0, 1.0]), (8, [2.0, 2.0]), (8, [2.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    got = pivot_search(df, F.col("vec_id") == 0, F.col("v"), k=5).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 5, 2.0), (0, 2, 8, 2.0)]
    assert pivot_search(df.limit(0), F.lit(True), F.col("v")).count() == 0
    assert pivot_search(df, F.lit(False), F.col("v")).count() == 0
    assert pivot_search(df.where("vec_id = 0"), F.lit(True), F.col("v")).count() == 0
