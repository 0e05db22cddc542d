"""Mixing: targets, the splitting tree, and what is drawn."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm.mixing import mix, permuted, shard_quotas, targets


def test_targets():
    assert targets([100, 100], [1, 1], 1.5, 2) == [150, 150]
    t = targets([10, 100, 100], [5, 2, 1], 1.5, 2)
    assert t == pytest.approx([20, 295 * 2 / 3, 295 / 3])
    assert targets([0, 0], [5, 2], 1.5, 2) == [0, 0] and targets([], [], 1.5, 2) == []


def test_tree_splits_exactly():
    totals = np.array([1000, 37, 0, 5])
    for shards in (1, 2, 7, 33):
        upto = np.zeros(4, int)
        sizes = []
        for s in range(shards):
            offset, quota = shard_quotas(totals, shards, s, 3)
            assert (offset == upto).all() and (quota >= 0).all()
            upto += quota
            sizes.append(quota.sum())
        assert (upto == totals).all() and max(sizes) - min(sizes) <= 2


def test_tree_is_hypergeometric():
    draws = [shard_quotas(np.array([60, 40]), 2, 0, seed)[1][0] for seed in range(2000)]
    assert np.mean(draws) == pytest.approx(30, abs=0.3) and np.var(draws) == pytest.approx(50 * .6 * .4 * 50 / 99, rel=0.15)


def corpus(spark, n=600):
    rng = np.random.default_rng(4)
    rows = [(i, ["a", "b", None, "é"][int(rng.integers(0, 4)) if i % 3 else 0], " ".join(["w"] * int(rng.integers(0, 80))), i) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, text string, position long").repartition(4)


def test_mix(spark):
    rows, df = corpus(spark)
    out = mix(df, shard_words=2000).collect()
    again = mix(df.repartition(7), shard_words=2000).select("doc_id", "pass", "shard", "position").collect()
    assert sorted(map(tuple, again), key=str) == sorted(((r.doc_id, r["pass"], r.shard, r.position) for r in out), key=str)
    size = {i: len(t.split()) for i, _, t, _ in rows}
    by_source = defaultdict(int)
    for i, s, *_ in rows:
        by_source[s] += size[i]
    order = sorted(by_source, key=lambda s: (s is None, s or ""))
    goal = dict(zip(order, targets([by_source[s] for s in order], [5, 2, 1, 5], 1.5, 2)))
    taken, times = Counter(), Counter()
    for r in out:
        assert r.source_size == by_source[r.source] and r.target == pytest.approx(goal[r.source]) and r.size == size[r.doc_id]
        if r.shard is not None:
            taken[r.source] += r.size
            times[r.doc_id] += 1
    assert max(times.values()) <= 2 and {r.doc_id for r in out} == set(size)
    for s in order:
        assert abs(taken[s] - goal[s]) <= 2 + 0.005 * goal[s]
    shards = defaultdict(list)
    for r in out:
        if r.shard is not None:
            shards[r.shard].append(r.position)
    assert len(shards) > 5 and all(sorted(p) == list(range(1, len(p) + 1)) for p in shards.values())


def test_edges(spark):
    rows = [(1, "s", None), (2, "s", ""), (3, None, "a b"), (None, None, "a b"), (4, "t", "x " * 50_000), (4, "t", "x " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("target", F.lit("z"))
    out = mix(df).collect()
    assert sum(r["pass"] in (None, 0) for r in out) == len(rows)  # no row is lost
    assert {r.target for r in out if r.source == "s"} == {0.0}
    assert len({r["__row"] for r in out}) == len(rows)
    assert mix(df.limit(0)).count() == 0


def test_swap_moves_one_of_repeated_rows(spark):
    """A swap of a repeated row closes the gap by one row's size."""
    rows = [(k, f"s{s}", " ".join(["w"] * 100)) for s in range(8) for k in range(40)] + [(None, f"s{s}", "w " * 7) for s in range(8) for _ in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    taken, target = Counter(), {}
    for r in mix(df).collect():
        target[r.source] = r.target
        taken[r.source] += r.size if r.shard is not None else 0
    assert all(abs(taken[s] - target[s]) <= 50 for s in target)  # half a large document at most


def test_columns_named_like_its_own(spark):
    names = ["__h0", "__h1", "__j", "__row", "src", "sid", "gap", "slot", "block", "start", "inside", "a b"]
    docs = spark.createDataFrame([(i, "s", "w " * (i % 9 + 1), *range(len(names))) for i in range(40)], ["doc_id", "source", "text", *names])
    out = mix(docs)
    assert out.columns[:3 + len(names)] == docs.columns
    assert {tuple(r)[3:3 + len(names)] for r in out.collect()} == {tuple(range(len(names)))} and out.select("doc_id").distinct().count() == 40


def test_many_repeats_of_one_row(spark):
    """Each repeat is drawn on its own, without pairs of repeats."""
    df = spark.createDataFrame([(1, "s", "one two three")] * 5000 + [(k, "s", "w " * 10) for k in range(2, 500)], "doc_id long, source string, text string").repartition(6)
    out = mix(df, weights=(1,), budget=1.5, most=2.0).collect()
    times = Counter(tuple(r["__row"]) for r in out)
    assert len(times) == 5498 and max(times.values()) <= 2
    taken = sum(r["size"] for r in out if r.shard is not None)
    assert abs(taken - out[0].target) < 4


@pytest.mark.parametrize("m", [1, 2, 3, 4, 10, 97, 1000])
def test_permutation_is_keyed_and_whole(spark, m):
    rows = spark.range(m).select(*[permuted(F.col("id"), F.lit(m).cast("long"), F.lit(k).cast("long")).alias(f"p{k}") for k in (1, 2)]).collect()
    assert all(sorted(r[k] for r in rows) == list(range(m)) for k in (0, 1))
    if m > 90:
        p = [r[0] for r in rows]
        assert p != [r[1] for r in rows] and len({b - a for a, b in zip(p, p[1:])}) > m / 3  # no stride
