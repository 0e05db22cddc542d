import pytest
from pyspark.sql import functions as F

from kestrel.functions import format as fmt
from kestrel.functions import text as tx
from kestrel.operators import metrics as mt
from kestrel.operators import relational as rl
from kestrel.operators import textml as tm


def _one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_presplit_order_and_lower(spark):
    s = "A。。<B>。)C<HTML>D\nE"
    py = s.lower()
    for a, b in tx.PRESPLIT_RULES:
        py = py.replace(a, b)
    py = py.replace("\n", "。")
    assert _one(spark, tx.presplit_text(F.lower(F.lit(s)))) == py
    assert "<html>" in py  # lower-casing first: the upper-case marker rule never fires


def test_markers_concat_and_recodes(spark):
    df = spark.createDataFrame([("s", None, "<HTML>x<XML>", "HTML y", "2", "1.0"),
                                (None, "v", None, None, "7", "FALSE")],
                               "SUBJECT string, VOC string, SUPPLEMENT string, FOLLOWUP string, LV string, CORRECT string")
    r = df.select(tx.strip_markers("SUPPLEMENT").alias("a"), tx.strip_markers("FOLLOWUP", tx.FOLLOWUP_MARKERS).alias("b"),
                  tx.concat_fields("SUBJECT", "VOC", "SUPPLEMENT").alias("c"),
                  rl.bucket_level("LV").alias("lv"), rl.recode_correct("CORRECT").alias("ok")).collect()
    assert (r[0].a, r[0].b, r[0].c, r[0].lv, r[0].ok) == ("x", " y", "s  <HTML>x<XML>", "LOW", "USE")
    assert (r[1].a, r[1].c, r[1].lv, r[1].ok) == (None, " v ", "7", "OMIT")


def test_domain_check(spark):
    df = spark.createDataFrame([("USE",), ("OMIT",), ("MAYBE",)], "c string")
    bad = {(r.value, r.problem) for r in rl.assert_domain(df, "c", ["USE", "OMIT", "X"]).collect()}
    assert bad == {("MAYBE", "unexpected"), ("X", "missing")}
    with pytest.raises(AssertionError):
        rl.check_domain(df, "c", ["USE", "OMIT"])


class FakeTokenizer:
    """(base form, part of speech) pairs, like a morphological analyser."""

    def tokenize(self, text):
        pos = {"ｒｐｎ": "名詞,一般", "good": "形容詞", "is": "助動詞", "の": "助詞"}
        for w in text.replace("。", " 。 ").split():
            yield w, pos.get(w, "記号")


def test_tokenizer_plugin_pos_stoplist_nfkc(spark):
    df = spark.createDataFrame([("ＲＰＮ is good の。",)], "t string")
    out = tm.tokenize_content_words(df, "t", "w", "str", tokenizer_factory=FakeTokenizer).first().w
    assert out == "rpn good"


def test_builtin_tokens(spark):
    df = spark.createDataFrame([("Élan, the  café's 42 の する x",)], "t string")
    assert tm.tokenize_content_words(df, "t", "w", "list").first().w == ["élan", "the", "café", "s", "42", "x"]


def test_split_is_repeatable_disjoint_exact(spark):
    import math
    for n, frac in ((5000, 0.25), (30_001, 0.2), (7, 0.5), (3, 0.0), (3, 1.0), (0, 0.3)):
        df = spark.range(n).withColumnRenamed("id", "k")
        a = tm.train_test_split(df, "k", frac, 42)
        b = tm.train_test_split(df.repartition(7), "k", frac, 42)
        assert a.join(b, "k").where(a.split != b.split).count() == 0
        assert a.where("split = 'test'").count() == math.ceil(n * frac) and a.count() == n
        assert tm.train_test_split(df, "k", frac, 42, subset="train").count() == n - math.ceil(n * frac)
    with pytest.raises(ValueError):
        tm.train_test_split(df, "k", subset="dev")


def test_split_with_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(None,)] * 3 + [("a",)] * 4 + [("b",), ("c",)], "k string")
    parts = tm.train_test_split(df, "k", 0.4, 1)
    assert parts.count() == 9 and parts.where("split = 'test'").count() >= 4
    assert parts.groupBy("k").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0


def test_integral_columns_are_checked(spark):
    from pyspark.errors import PySparkException
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert [r.v for r in rl.nan_to_null(df, integral={"v": True}).collect()] == [1, None, None]
    with pytest.raises(PySparkException, match="not integral"):
        rl.nan_to_null(spark.createDataFrame([(1.5,)], "v double"), integral={"v": True}).collect()


def test_tfidf_unit_norm_and_idf(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "c"])], "k int, t array<string>")
    w = {(r.k, r.term): r.weight for r in tm.tfidf_weights(docs, "k", "t").collect()}
    import math
    idf = lambda df: math.log(3 / (df + 1)) + 1
    v1 = [2 * idf(1), idf(2)]
    n1 = math.sqrt(sum(x * x for x in v1))
    assert w[(1, "a")] == pytest.approx(v1[0] / n1) and w[(1, "b")] == pytest.approx(v1[1] / n1)


def test_classification_report_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 1)], "label int, prediction int")
    r = {x.cls: x for x in mt.classification_report(df).collect()}
    assert r["2"].precision == 0.0 and r["2"].recall == 0.0 and r["2"].f1 == 0.0
    assert r["1"].precision == pytest.approx(2 / 4) and r["1"].recall == 1.0
    assert r["accuracy"].f1 == pytest.approx(3 / 5) and r["accuracy"].support == 5
    assert r["macro avg"].recall == pytest.approx((0.5 + 1 + 0) / 3)


def test_typed_report_and_types(spark):
    import datetime as dt
    df = spark.createDataFrame([(1234567, 1.23, "00000123", dt.datetime(2023, 1, 23))],
                               "i bigint, f double, s string, t timestamp")
    r = fmt.typed_report(df).first()
    assert (r.i, r.f, r.s, r.t) == ("1,234,567", "1.230", "00000123", "2023/01/23 00:00:00")
    with pytest.raises(TypeError):
        rl.assert_types(spark.createDataFrame([([1],)], "a array<int>"))


def test_number_report_text(spark):
    assert _one(spark, fmt.number_report_text(F.lit(1234567.891), 0)) == "1,234,568 (1.23E+06)"
    assert _one(spark, fmt.number_report_text(F.lit(2.5), 0)) == "2 (2.50E+00)"
    assert _one(spark, fmt.round_half_even(F.lit(2.5), 0)) == 2.0


def test_scientific_text_is_the_script_form(spark):
    values = [0.0, 1.0, 316.5, -316.5, 9.996, 999.95, 1e5, 99999.5, 1.239e-7, 1e100, 5e-5, 123456789.0, 2.5, 0.125]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", fmt.scientific_text("v").alias("t")).collect():
        assert r.t == f"{r.v:.2E}"


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 99, 1000, 4097])
def test_permutation_is_a_bijection(spark, n):
    rows = spark.range(n).select("id", tm.permuted(F.col("id"), n, 3).alias("p"), tm.permuted(F.col("id"), n, 4).alias("q")).orderBy("id").collect()
    for c in ("p", "q"):
        assert sorted(r[c] for r in rows) == list(range(n))
    if n > 90:
        p = [r.p for r in rows]
        assert p != [r.q for r in rows] and sum(abs(i - x) for i, x in enumerate(p)) > n * n / 5  # n * n / 3 expected
        assert sum(b == a + 1 for a, b in zip(p, p[1:])) < n / 20
    big = 10 ** 12 + 39  # places of a large table, found alone
    far = spark.range(0, 1000).select(tm.permuted(F.col("id") * 999_999_937, big).alias("p")).collect()
    assert len({r.p for r in far}) == 1000 and all(0 <= r.p < big for r in far)


def test_shuffle_positions(spark):
    df = spark.createDataFrame([(k, "x", 1) for k in range(300)], "k int, position string, _index int").repartition(7)
    a = tm.shuffle_positions(df, ["k"], 5).orderBy("k").collect()
    assert a == tm.shuffle_positions(df.repartition(3), ["k"], 5).orderBy("k").collect()
    assert sorted(r.position for r in a) == list(range(300))
    assert tm.shuffle_positions(df.limit(0), ["k"]).count() == 0


def test_nfkc_holds_few_texts_as_python_strings(spark):
    """A batch of 5,000 texts is normalised a slice at a time; ASCII, null and composed texts come out right."""
    import tracemalloc
    import unicodedata
    import pyarrow as pa
    from kestrel.functions import text as tx
    batch = pa.array(["ＡＢＣ　" * 500 + str(i) for i in range(5000)])  # 20 MB as Python strings
    tracemalloc.start()
    got = tx.nfkc_normalize.func(batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3_000_000 and got[4999].as_py() == "ABC " * 500 + "4999"
    texts = ["plain ASCII\n", "", None, "é", "ﬁ①", "ạ̇", "が", "x\x00\x7f"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(3)
    out = {r.i: r.n for r in rows.select("i", tx.nfkc_normalize("t").alias("n")).collect()}
    assert out == {i: t if t is None else unicodedata.normalize("NFKC", t) for i, t in enumerate(texts)}
