"""The language model against a plain dictionary version."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kestrel.llm import bitfilter, ngramlm
from kestrel.session import scratch_path

N = ngramlm.ORDER


def marks(text):
    code = [c + ngramlm.FIRST for c in map(ord, text or "")]
    return [ngramlm.BOS] * (N - 1) + [c if c < ngramlm.SHARED else ngramlm.SHARED + (c - ngramlm.FIRST) % 0xFF0 for c in code] + [ngramlm.EOS]


class Plain:
    def __init__(self, texts):
        counts = {N: Counter()}
        for t in texts:
            s = marks(t)
            counts[N].update(tuple(s[i - N + 1:i + 1]) for i in range(N - 1, len(s)))
        for k in range(N - 1, 0, -1):
            counts[k] = Counter(g[1:] for g in counts[k + 1])
        self.counts, self.ctx, self.disc = counts, {}, {}
        for k, c in counts.items():
            n = [sum(v == i for v in c.values()) for i in range(5)]
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
            d = [i - (i + 1) * y * n[i + 1] / n[i] if n[i] and n[i + 1] else 0.5 * i for i in (1, 2, 3)]
            self.disc[k] = [min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]
            self.ctx[k] = defaultdict(lambda: [0, 0.0])
            for g, v in c.items():
                self.ctx[k][g[:-1]][0] += v
                self.ctx[k][g[:-1]][1] += self.disc[k][min(v, 3) - 1]

    def p(self, g):
        if not g:
            return 1 / (len(self.counts[1]) + 1)
        k = len(g)
        below = self.p(g[1:])
        if g[:-1] not in self.ctx[k]:
            return below
        total, mass = self.ctx[k][g[:-1]]
        v = self.counts[k].get(g, 0)
        own = v - self.disc[k][min(v, 3) - 1] if v else 0
        return own / total + mass / total * below

    def bits(self, text):
        s = marks(text)
        return -sum(math.log2(self.p(tuple(s[i - N + 1:i + 1]))) for i in range(N - 1, len(s)))


def corpus(n=200):
    rng = random.Random(3)
    word = lambda: rng.choice(["stone", "water", "house", "le", "é", "and", "of"])
    good = [" ".join(word() for _ in range(rng.randint(20, 90))) for _ in range(n)]
    return good


def test_scores_equal_plain_model(spark):
    good = corpus()
    odd = [None, "", "Z", "stone 😀 \x01\x02 文", "stone " * 20_000, "house of stone"]
    rows = [(i, t, "en", 1) for i, t in enumerate(good + odd)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept int").repartition(4)
    trusted = spark.createDataFrame([(i,) for i in range(0, 120)] + [(None,), (5,), (10**9,)], "doc_id long")
    path = scratch_path(spark, "t")
    out = ngramlm.quality(docs, trusted, path=path)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows) and out.columns[:2] == ["doc_id", "lang"]
    plain = Plain(good[:120])
    for i, t, *_ in rows:
        assert got[i].n_chars == len(t or "") + 1
        assert math.log2(got[i].perplexity) * got[i].n_chars == pytest.approx(plain.bits(t), rel=1e-9), t
    # probabilities of a context sum to one
    symbols = {g[0] for g in plain.counts[1]}
    for ctx in [(1, 1, 1), tuple(marks("sto")[3:6])]:
        assert sum(plain.p((*ctx, s)) for s in symbols) + plain.p((*ctx, 10**6)) == pytest.approx(1)


def test_junk_goes_clean_text_stays(spark):
    good = corpus(300)
    junk = ["XQ#ZK!! " * 30, "zzzz qqqq " * 40]
    rows = [(i, t, "en" if i % 2 else None) for i, t in enumerate(good + junk)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(0, 200)], "doc_id long")
    kept = {r.doc_id for r in ngramlm.quality(docs, trusted).where("kept").collect()}
    assert set(range(300, 302)).isdisjoint(kept) and len(kept) >= 298


@pytest.mark.parametrize("known", [0, 1, 5, 49])
def test_clean_language_with_few_trusted_texts_stays(spark, known):
    rng = random.Random(5)
    other = [" ".join(rng.choice(["ŵyr", "ĝis", "ħobż", "ňuch", "žlutý"]) for _ in range(rng.randint(20, 90))) for _ in range(60)]
    rows = ([(i, t, "en") for i, t in enumerate(corpus(120))] + [(1000 + i, t, "xx") for i, t in enumerate(other)]
            + [(2000, "XQ#ZK!! " * 30, "en"), (2001, "zzzz qqqq " * 40, "en")])
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in [*range(100), *range(1000, 1000 + known)]], "doc_id long")
    got = {r.doc_id: r for r in ngramlm.quality(docs, trusted).collect()}
    assert all(got[1000 + i].kept and got[1000 + i].perplexity > 0 for i in range(60))
    assert not got[2000].kept and not got[2001].kept
    assert all((got[1000 + i].low is None) == (known == 0) for i in range(60))  # one trusted text gives limits


def test_columns_named_like_its_own(spark):
    names = ["bits", "mid", "lo", "hi", "l", "n", "q", "block", "rate", "seen", "texts", "fold", "key", "a b"]
    rows = [(i, t, "en", *range(len(names))) for i, t in enumerate(corpus(60))]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", *names])
    out = ngramlm.quality(docs, spark.createDataFrame([(i,) for i in range(50)], "doc_id long"))
    assert out.columns == ["doc_id", "lang", *names, *ngramlm.OUTS]
    assert {tuple(r)[2:2 + len(names)] for r in out.collect()} == {tuple(range(len(names)))}


def test_limits_suit_unseen_texts(spark):
    """Texts the model did not count are as good as those it did."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(40, 120))) for _ in range(500)]
    junk = ["XQ#ZK!! " * 30, "zzzz qqqq " * 40]
    rows = [(i, t, "en") for i, t in enumerate(texts + junk)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(200)], "doc_id long")
    gone = {r.doc_id for r in ngramlm.quality(docs, trusted).where("not kept").collect()}
    assert {500, 501} <= gone
    assert len(gone & set(range(200))) <= 1 and len(gone & set(range(200, 500))) <= 6


def test_edges(spark):
    docs = spark.createDataFrame([(1, "a", None), (None, None, "en"), (1, "a", None)], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long")
    got = ngramlm.quality(docs, none).collect()
    assert len(got) == 3 and all(r.kept and r.perplexity is None for r in got)
    assert ngramlm.quality(docs.limit(0), none).count() == 0
    one = ngramlm.quality(docs, spark.createDataFrame([(1,)], "doc_id long")).collect()
    assert len(one) == 3 and all(r.perplexity > 0 for r in one)


@pytest.mark.parametrize("log_bits", [6, 24])
def test_bit_filter_joins(spark, log_bits):
    rows = spark.createDataFrame([(i % 50 if i % 7 else None, str(i)) for i in range(300)], "k long, v string")
    keys = spark.createDataFrame([(i,) for i in range(0, 40, 3)] * 2 + [(None,), (99,)], "k long")
    semi, anti = bitfilter.semi_join(rows, keys, ["k"], log_bits), bitfilter.anti_join(rows, keys, ["k"], log_bits)
    want = set(range(0, 40, 3))
    assert sorted(r.v for r in semi.collect()) == sorted(r.v for r in rows.collect() if r.k in want)
    assert sorted(r.v for r in anti.collect()) == sorted(r.v for r in rows.collect() if r.k not in want)
    assert anti.columns == ["k", "v"]
    assert bitfilter.anti_join(rows, keys.limit(0), ["k"]).count() == 300
    assert bitfilter.semi_join(rows.limit(0), keys, ["k"]).agg(F.count("*")).first()[0] == 0
