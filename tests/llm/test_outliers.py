"""Quality rules: counts by brute force, the estimate against numpy."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import outliers
from kestrel.session import scratch_path


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside)


def texts():
    rng = random.Random(8)
    out = [None, "", "   \n\t ", "one", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 100, "é　ü\x0b#* <|>\nline\nline\n line", "a\r\nb\r\na\r\n",
           " ".join(f"w{i}" for i in range(20_000)), "r " * 20_000]
    for _ in range(60):
        out.append("\n".join(" ".join(rng.choice(["aa", "b", "c#", "dd"]) for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(1, 8))))
    return out


def test_counts(spark):
    ts = texts()
    df = spark.createDataFrame(list(enumerate(ts)), "doc_id long, text string").withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("s"))
    got = {r.doc_id: r for r in outliers.quality_rules(df).collect()}
    for i, t in enumerate(ts):
        n, chars, symbols, dup, rep = brute(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep), t
        assert r.base_failed == (n < 20 or 100 * rep > 30 * n) and not (r.base_failed and r.kept)


def test_chi2():
    assert outliers.chi2_quantile(0.95, 1) == pytest.approx(3.841458820694124)
    assert outliers.chi2_quantile(0.5, 6) == pytest.approx(5.348120627447116)


def numpy_best(x, subset, starts, seed=0):
    """Least log determinant (floors of 1, chi-square factor) that concentration
    steps reach from random starts of p + 1 rows each."""
    p = x.shape[1]
    factor = subset / outliers._gamma_p(p / 2 + 1, outliers.chi2_quantile(subset, p) / 2)
    h, rng, best = int(np.ceil(subset * len(x))), np.random.default_rng(seed), (np.inf, None)
    for _ in range(starts):
        near = x[rng.choice(len(x), p + 1, replace=False)]
        last = np.inf
        while True:
            m, c = near.mean(0), np.cov(near.T, bias=True) * factor + np.eye(p)
            d = x - m
            near = x[np.argsort(np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d), kind="stable")[:h]]
            now = np.linalg.slogdet(np.cov(near.T, bias=True) * factor + np.eye(p))[1]
            if now > last - 1e-9:
                break
            last = now
        best = min(best, (last, m), key=lambda b: b[0])
    return best


def contaminated(seed, n, bad, kind):
    rng = np.random.default_rng(seed)
    p = len(outliers.FEATURES)
    x = rng.normal(size=(n, p)) @ rng.normal(size=(p, p)) * 30
    if kind == "far":
        x[:bad] += 4000
    elif kind == "close cluster":
        x[:bad] = rng.normal(size=(bad, p)) * 3 + 250
    else:  # every outlier elsewhere
        x[:bad] *= rng.uniform(8, 60, size=(bad, 1))
    return x


@pytest.mark.parametrize("kind", ["far", "close cluster", "spread"])
def test_least_determinant(spark, kind):
    """At or below the best of 500 random starts in numpy (the border cell of
    the subset, 1/16 octave wide, may cost a little)."""
    x = contaminated(6, 500, 100, kind)
    p = x.shape[1]
    df = spark.createDataFrame([(i, "g", *map(float, r)) for i, r in enumerate(x)], ["i", "gid", *[f"x{k}" for k in range(p)]]).repartition(5)
    found = outliers.mcd(df, scratch_path(spark, "t"))
    row = found.first()
    logdet, mean = numpy_best(x, 0.75, 500)
    assert row.logdet <= logdet + 0.02 and row.n == 500
    c = np.zeros((p, p))
    for k, (i, j) in enumerate(outliers.PAIRS):
        c[i, j] = c[j, i] = row.c[k]
    assert np.linalg.slogdet(c)[1] == pytest.approx(row.logdet)
    d = x - np.array(row.m)
    want = np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d)
    got = df.join(found, "gid").withColumn("d2", outliers.distance()).orderBy("i").toPandas()["d2"].to_numpy()
    assert np.allclose(got, want, rtol=1e-6)
    limit = outliers.chi2_quantile(1 - 1e-9, p)
    assert got[:100].min() > limit > np.quantile(got[100:], 0.99)


def test_estimates_are_drawn_by_size(spark):
    """No switch at any size: a group's verdict moves smoothly with its rows."""
    own = spark.createDataFrame([("a", 1, [0.0] * 6, [1.0] * 21), ("b", 59, [0.0] * 6, [1.0] * 21), ("c", 61, [0.0] * 6, [1.0] * 21)],
                                "gid string, n long, m array<double>, c array<double>")
    wide = spark.createDataFrame([([10.0] * 6, [3.0] * 21)], "wm array<double>, wc array<double>")
    got = {r.gid: (r.m[0], r.c[0]) for r in outliers._drawn(own, wide, 30.0, [], "gid").collect()}
    for gid, n in (("a", 1), ("b", 59), ("c", 61)):
        assert got[gid] == pytest.approx((300 / (n + 30), (n + 90) / (n + 30)))


def test_groups_and_outliers(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["the", "of", "reading", "house", "water", "and", "stone", "light"]) + str(rng.randint(0, 9999))
    rows = []
    for i in range(400):
        words = [word() for _ in range(rng.randint(30, 200))]
        if i % 20 == 7:
            words = [w + "***" for w in words]
        # small groups lean on their language, a lone language on everything
        lang, source = ("xx" if i < 3 else None if i < 80 else "en"), (f"s{i}" if 80 <= i < 100 else "hot")
        rows.append((i, lang, source, " ".join(words), True))
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string, kept boolean").repartition(3)
    out = outliers.quality_rules(df)
    got = out.collect()
    assert sorted(r.doc_id for r in got if not r.kept) == list(range(7, 400, 20))
    assert out.columns[:4] == ["doc_id", "lang", "source", "text"] and all(r.distance is not None for r in got)


def test_edges(spark):
    df = spark.createDataFrame([(1, "en", "s", " ".join(["same words in every text of this small group are told again with nothing new at all here or there"] * 1))] * 70,
                               "doc_id long, lang string, source string, text string")
    got = outliers.quality_rules(df).collect()
    assert len(got) == 70 and len({(r.kept, r.distance) for r in got}) == 1 and got[0].distance < 1e-9 and got[0].kept
    assert outliers.quality_rules(df.limit(0)).count() == 0
    bad = outliers.quality_rules(df.withColumn("text", F.lit(None).cast("string"))).collect()
    assert not any(r.kept for r in bad)


def test_native_plan(spark):
    df = spark.createDataFrame([(1, "en", "s", "t")], "doc_id long, lang string, source string, text string")
    plan = outliers.quality_rules(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
