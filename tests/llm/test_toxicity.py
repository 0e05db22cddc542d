"""The factorization machine: interactions, held-out accuracy, odd inputs."""

import random

import numpy as np
from pyspark.sql import functions as F

from kestrel.llm import toxicity


def test_scores_equal_the_formula():
    rng = np.random.default_rng(1)
    m = toxicity.Machine(0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    x = rng.integers(0, 2, (20, 6))
    doc, term = np.nonzero(x)
    pair = np.array([[sum(m.factors[i] @ m.factors[j] * r[i] * r[j] for i in range(6) for j in range(i + 1, 6))] for r in x])[:, 0]
    want = 1 / (1 + np.exp(-(m.bias + x @ m.weight + pair)))
    assert np.allclose(m.scores(doc, term, 20), want)


def test_learns_a_pure_interaction():
    # either term alone is harmless, both together are toxic, and so is neither: no additive weights can do it
    patterns = [(), (0, 1), (0,), (1,)]
    m = toxicity.fit(patterns, np.full(4, 50.0), np.array([50.0, 50, 0, 0]), 2)
    doc = np.repeat(np.arange(4), [len(p) for p in patterns])
    term = np.array([t for p in patterns for t in p])
    assert (m.scores(doc, term, 4) >= 0.5).tolist() == [True, True, False, False]


def corpus(spark, n=900):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["SCUM!", "moron", "loweiheit", "loweiung"])
        rows.append((i, " ".join(words), 1.5))
        labels.append((i, int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string, score double").repartition(3),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    m = toxicity.learn(docs, labels.where("doc_id % 5 > 0"))
    out = toxicity.score(docs, m)
    assert out.columns == ["doc_id", "score", "predicted"]
    got = out.join(labels, "doc_id").where("doc_id % 5 = 0").collect()
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.98
    again = toxicity.score(docs.repartition(5), toxicity.learn(docs.repartition(5), labels.where("doc_id % 5 > 0")))
    assert {r.doc_id: r.predicted for r in again.collect()} == {r.doc_id: r.predicted for r in out.collect()}


def test_edges(spark):
    docs, labels = corpus(spark, 600)
    extra = spark.createDataFrame([(None, None), (1000, ""), (1000, ""), (1001, "scum " * 20_000), (1002, "!!! ...")], "doc_id long, text string")
    both = docs.select("doc_id", "text").union(extra)
    odd = labels.union(spark.createDataFrame([(None, 1), (1000, None), (5, 1), (5, 0)], "doc_id long, toxic int"))
    m = toxicity.learn(both, odd)
    got = toxicity.score(both, m)
    assert got.count() == 605 and got.where("score is null or score < 0 or score > 1").count() == 0
    bias = 1 / (1 + np.exp(-m.bias))
    assert {round(r.score, 9) for r in got.where("doc_id = 1000 or doc_id = 1002").collect()} == {round(bias, 9)}
    assert got.where("doc_id = 1001").first().predicted == 1
    assert toxicity.score(both.limit(0), m).count() == 0
    for none in (labels.limit(0), labels.withColumn("toxic", F.lit(0))):
        assert toxicity.score(both, toxicity.learn(both, none)).where("score > 0.001").count() == 0
    assert toxicity.score(both, toxicity.learn(both, labels.withColumn("toxic", F.lit(1)))).where("score < 0.999").count() == 0


def test_training_bound(spark):
    docs, labels = corpus(spark, 200)
    a, b = toxicity.learn(docs, labels, max_train=150), toxicity.learn(docs, labels, max_train=150)
    assert a.numbers == b.numbers and np.allclose(a.weight, b.weight)
