"""N-gram join against all pairs."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import ngramjoin
from kestrel.llm.components import components
from kestrel.session import scratch_path


def grams(text, n=5):
    words = [ngramjoin.Grams._bare(w) for w in (text or "").lower().split()]
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(texts, ids, threshold):
    sets = [grams(t) or {("no words", t or "")} for t in texts]  # equal texts alone
    links, root = [0] * len(texts), list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    inv = defaultdict(list)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for g in s:
            for j in inv[g]:
                common[j] += 1
            inv[g].append(i)
        for j, k in common.items():
            if k >= threshold * (len(s) + len(sets[j]) - k):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    first = {}
    for i in range(len(texts)):
        if ids[i] is not None:
            first[find(i)] = min(first.get(find(i), ids[i]), ids[i])
    return {k: (first.get(find(k)), links[k]) for k in range(len(texts))}


def near_copies(rng, groups, copies):
    out = []
    for _ in range(groups):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, copies)):
            v = list(base)
            for _ in range(rng.randint(0, 1 + len(v) // 40)):
                v[rng.randrange(len(v))] = f"z{rng.randrange(10**6)}"
            out.append(" ".join(v))
    return out


@pytest.mark.parametrize("chunk", [512, 7])
def test_equals_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(ngramjoin, "CHUNK_ROWS", chunk)
    rng = random.Random(chunk)
    texts = near_copies(rng, 60, 6) + near_copies(rng, 1, 1) * 40 + near_copies(random.Random(5), 2, 90)
    texts += ["", None, " \t", " \t", "...", "one two", "One, two.", "...", "a b c d e", "A b c, d e!", "word " * 20_000]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, group string").repartition(5)
    out = ngramjoin.ngram_join(df).collect()
    want = brute(texts, list(range(len(texts))), 0.8)
    assert {r.doc_id: (r.class_id, r.n_links) for r in out} == want and len(out) == len(texts)


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "q w e r t y"), (9, None), (9, None)]
    out = ngramjoin.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted([(r.doc_id, r.class_id, r.n_links) for r in out], key=str) == sorted(
        [(None, 3, 2), (3, 3, 2), (3, 3, 2), (None, None, 0), (9, 9, 1), (9, 9, 1)], key=str)


def test_empty_table(spark):
    assert ngramjoin.ngram_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_dense_and_sparse_verification_agree():
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 1 << 60, 300, dtype=np.uint64))
    sets = [np.unique(np.concatenate([base[rng.random(len(base)) > 0.1], rng.integers(0, 1 << 60, 20, dtype=np.uint64)])) for _ in range(30)]
    mask = np.triu(np.ones((30, 30), bool), 1)
    i, j = ngramjoin.linked_pairs(sets, None, mask, 0.7)
    want = {(a, b) for a in range(30) for b in range(a + 1, 30)
            if len(np.intersect1d(sets[a], sets[b])) >= 0.7 * len(np.union1d(sets[a], sets[b]))}
    assert set(zip(i.tolist(), j.tolist())) == want and 0 < len(want) < 435


def test_recall_sets_the_bands():
    assert ngramjoin.bands_for(0.8, 0.99999) == 22
    assert 1 - (1 - 0.8 ** 4) ** 22 >= 0.99999


def test_components(spark):
    rng = random.Random(1)
    n = 400
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(260)] + [(1000 + k, 1001 + k) for k in range(30)] + [(5, 5), (None, 3)]
    root = list(range(2000))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = components(spark.createDataFrame(edges, "a long, b long"), scratch_path(spark, "t")).collect()
    nodes = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    assert {r.key: r.label for r in got} == {x: find(x) for x in nodes}
    assert components(spark.createDataFrame([], "a long, b long"), scratch_path(spark, "t")).agg(F.count("*")).first()[0] == 0
