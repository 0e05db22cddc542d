"""Dictionary lattice against all paths."""

import math
import random

import pytest

from kestrel.operators import lattice
from kestrel.operators.textml import tokenize_content_words

WORDS = [("東京", "名詞,固有名詞", "東京"), ("東京都", "名詞,固有名詞", "東京都"), ("京都", "名詞,固有名詞", "京都"), ("都", "名詞", "都"), ("に", "助詞", "に"),
         ("住む", "動詞", "住む"), ("住ん", "動詞", "住む"), ("で", "助詞", "で"), ("いる", "動詞", "いる"), ("美しい", "形容詞", "美しい"), ("本", "名詞", "本"), ("日本", "名詞", "日本")]


def paths(l, text, a=0):
    """Every path as (edges)."""
    if a == len(text):
        yield []
        return
    for b, i in list(l.edges(text))[a]:
        for rest in paths(l, text, b):
            yield [(a, b, i), *rest]


def lattice_of(seed):
    r = random.Random(seed)
    return lattice.Lattice(WORDS, [r.uniform(1, 9) for _ in WORDS]), r


@pytest.mark.parametrize("seed", range(8))
def test_cut_and_expectation_equal_all_paths(seed):
    l, r = lattice_of(seed)
    text = "".join(r.choice(["東京", "東京都", "京都", "都", "に", "住ん", "で", "xy", "ヌ", "本", "日", "。"]) for _ in range(5))
    every = [(sum(l.cost(*e) for e in p), len(p), p) for p in paths(l, text)]
    cost, n, _ = min(every, key=lambda w: (round(w[0], 9), w[1]))
    got = l.cut(text)
    assert sum(l.cost(*e) for e in got) == pytest.approx(cost) and len(got) == n
    assert "".join(text[a:b] for a, b, _ in got) == text
    total = sum(math.exp(-c) for c, _, _ in every)
    want = {}
    for c, _, p in every:
        for _, _, i in p:
            if i >= 0:
                want[i] = want.get(i, 0.0) + math.exp(-c) / total
    assert l.expected(text) == pytest.approx(want)


def entries(spark, words):
    return spark.createDataFrame(words, "surface string, pos string, base string")


def test_expectation_maximisation(spark):
    """Costs equal a plain count over all paths, round by round."""
    texts = ["東京都に住んでいる", "京都 に住む", "東京都", None, "", "日本の本"] * 2 + ["東京都に"] * 5
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    got = lattice.fit(df, "t", entries(spark, WORDS + WORDS[:2] + [("", "名詞", "")]), rounds=3)
    words = sorted(set(WORDS))
    want = lattice._lattice(words, [1.0] * len(words))
    for _ in range(3):
        counts = [0.1] * len(words)
        for t in texts:
            for run in (t or "").split():
                for i, x in want.expected(run).items():
                    counts[i] += x
        want = lattice._lattice(words, counts)
    assert got.words == words and got.costs == pytest.approx(want.costs)
    assert [w[0] for w in got.words if got.costs[words.index(w)] < 3][:1]


def test_user_dictionary_changes_the_cut(spark, tmp_path):
    df = spark.createDataFrame([(1, "東京都に住んでいる。ＡＢＣ社の美しい本"), (2, None), (3, "")], "k int, t string")

    def words(dictionary):
        l = lattice.fit(df, "t", dictionary, rounds=2)
        out = tokenize_content_words(df, "t", "w", tokenizer_factory=lambda: l).orderBy("k").collect()
        return [r.w for r in out]

    plain = words(entries(spark, [w for w in WORDS if w[0] != "東京都"]))
    assert plain[0] == ["東京", "都", "住む", "いる", "abc", "社", "美しい", "本"] and plain[2] == []
    (tmp_path / "user.csv").write_text("東京都,名詞,東京都\n東京,-1,-1,1000,名詞,固有名詞,*,*,*,*,東京,*,*\n\nに,助詞,*\n住ん,動詞,住む\nで,助詞,で\nいる,動詞,いる\n都,名詞,都\n", encoding="utf-8")
    own = lattice.read_dictionary(spark, str(tmp_path / "user.csv"))
    assert {tuple(r) for r in own.collect()} >= {("東京都", "名詞", "東京都"), ("東京", "名詞", "東京"), ("に", "助詞", "に")}
    assert words(own)[0][:3] == ["東京都", "住む", "いる"]  # particles are dropped by their part of speech


def test_long_runs_and_no_dictionary(spark):
    text = "あ漢" * 5000 + "x" * 9000
    assert "".join(lattice.runs(text)) == text and max(map(len, lattice.runs(text))) <= lattice.LONGEST_RUN
    df = spark.createDataFrame([(text,)], "t string")
    l = lattice.fit(df, "t", entries(spark, [("あ", "助詞", "あ")]), rounds=1)
    assert sum(1 for _ in l.tokenize(text)) == 10003
    none = lattice.fit(df, "t", entries(spark, WORDS).limit(0))
    assert list(none.tokenize("ab 漢字")) == [("ab", "名詞"), ("漢字", "名詞")]
