"""Fitted text vectors against numpy on a small corpus."""

import re
from collections import Counter

import numpy as np

from kestrel.operators import retrieval as rt
from kestrel.operators import wordvec


def corpus(seed=1, n=160):
    rng = np.random.default_rng(seed)
    topics = [["sun", "beach", "sand", "wave", "shore"], ["court", "judge", "law", "trial", "jury"], ["oven", "bread", "flour", "yeast", "dough"]]
    out = []
    for k in range(n):
        words = list(rng.choice(topics[k % 3], rng.integers(6, 20))) + list(rng.choice(["the", "of", "and"], 5))
        rng.shuffle(words)
        out.append(" ".join(words).title() + ".")
    return out


def numpy_vectors(texts, window, smooth):
    docs = [re.findall(r"\w+", t.lower()) for t in texts if t]
    vocab = sorted({w for d in docs for w in d})
    at = {w: i for i, w in enumerate(vocab)}
    x = np.zeros((len(vocab), len(vocab)))
    for d in docs:
        for i in range(len(d)):
            for j in range(i + 1, min(len(d), i + window + 1)):
                x[at[d[i]], at[d[j]]] += 1
                x[at[d[j]], at[d[i]]] += 1
    s = x.sum(1)
    with np.errstate(divide="ignore"):
        p = np.maximum(np.log(x * x.sum() / np.outer(s, s)), 0)
    share = Counter(w for d in docs for w in d)
    total = sum(share.values())
    return at, p, {w: smooth / (smooth + n / total) for w, n in share.items()}


def test_equals_numpy(spark):
    texts = [*corpus(), None, "", "unknown-free ... !"]
    texts[-1] = "!!!"
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "k long, t string, rid string").repartition(4)
    model = wordvec.fit(df, "t", dim=6, window=3, rounds=40)
    assert model.width == 6
    at, p, weight = numpy_vectors(texts, 3, model.smooth)
    u, s, vt = np.linalg.svd(p)
    words = (vt[:6] * np.sqrt(s[:6])[:, None]).T
    rows = model.embed(df, "t").orderBy("k").collect()
    assert model.embed(df, "t").columns == ["k", "t", "rid", "embedding"] and len(rows) == len(texts)
    want = []
    for t in texts:
        v = np.zeros(6)
        for w in re.findall(r"\w+", (t or "").lower()):
            v += weight[w] * words[at[w]]
        want.append(v / np.linalg.norm(v) if np.linalg.norm(v) else v)
    got, want = np.array([r.embedding for r in rows]), np.array(want)
    # singular vectors are known up to sign: compare the inner products of texts
    assert np.allclose(got @ got.T, want @ want.T, atol=1e-4)
    assert not got[-3:].any()


def test_related_words_are_nearer_than_by_hashing(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(corpus())], "k long, t string")
    model = wordvec.fit(df, "t", dim=8)
    pairs = spark.createDataFrame([(0, "beach"), (1, "shore"), (2, "judge"), (3, "jury"), (4, "bread"), (5, "yeast")], "k int, t string")
    a = np.array([r.embedding for r in model.embed(pairs, "t").orderBy("k").collect()])
    h = np.array([r.embedding for r in rt.embed_text(pairs, "t", dim=8).orderBy("k").collect()])
    same = [(0, 1), (2, 3), (4, 5)]
    other = [(0, 2), (1, 4), (3, 5), (0, 4)]
    gap = lambda v: np.mean([v[i] @ v[j] for i, j in same]) - np.mean([v[i] @ v[j] for i, j in other])
    assert gap(a) > 0.5 and gap(a) > gap(h)


def test_empty(spark):
    none = spark.createDataFrame([(1, None), (2, "")], "k int, t string")
    model = wordvec.fit(none, "t")
    assert model.width == 0 and [r.embedding for r in model.embed(none, "t").collect()] == [[], []]
    assert wordvec.fit(none.limit(0), "t").width == 0


def test_pairs_travel_in_cells_of_words(spark, monkeypatch):
    """A row a cell, not a row a pair; several cells and chunks of words give what one gives."""
    monkeypatch.setattr(wordvec, "CHUNK_WORDS", 150)
    texts = ["a a b", "b a", *corpus(n=40)]
    ids = spark.createDataFrame([(t,) for t in texts], "t string").repartition(3).select(wordvec.hashed_words("t").alias("ids"))
    rows = wordvec.pair_counts(ids, 2, [4, 9, 11]).collect()
    assert sorted(r.cell for r in rows) == [4, 9, 11]
    got = Counter()
    for r in rows:
        names, partners = np.frombuffer(r.words, np.int64), np.frombuffer(r.ids, np.int64)
        at, n = np.frombuffer(r.a, np.int32), np.frombuffer(r.n, np.int64)
        own = np.repeat(names, np.frombuffer(r.lens, np.int32))
        got.update({(int(a), int(b)): int(k) for a, b, k in zip(partners[at], own, n)})
        assert np.array_equal(np.frombuffer(r.sums, np.int64), [n[own == w].sum() for w in names])
    want = Counter()
    for r in ids.collect():
        for i, a in enumerate(r.ids):
            for b in r.ids[i + 1:i + 3]:
                want.update([(a, b), (b, a)])
    assert got == want
