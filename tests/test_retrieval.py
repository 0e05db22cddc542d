import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kestrel.operators import retrieval as rt
from kestrel.operators import search


def test_html_nested_and_class_tokens(spark):
    html = ('<div class="x">no</div><div class="entry-content main-entry">A<div>B &amp; C</div>D</div>'
            '<div class="entry-content main-entry">second</div>')
    assert rt.element_text(html, "entry-content main-entry") == "AB & CD"
    assert rt.element_text('<div class="ad big">t</div>', "ad") == "t"
    assert rt.element_text("<p>none</p>", "ad") is None
    assert rt.element_text('<div class="ad">a<script>var x = "<div>";</script><style>p {}</style>b</div>c', "ad") == "ab"
    df = spark.createDataFrame([(1, html), (2, "<p/>")], "page_id int, html string")
    out = {r.page_id: r.content for r in rt.html_element_text(df, "entry-content main-entry").collect()}
    assert out == {1: "AB & CD", 2: None}


@pytest.mark.parametrize("size,overlap", [(100, 10), (150, 20), (20, 5)])
def test_recursive_split_properties(size, overlap):
    rng = np.random.default_rng(size)
    words = ["".join(rng.choice(list("abcdefghij"), rng.integers(1, 12))) for _ in range(600)]
    text = ""
    for i, w in enumerate(words):
        text += w + ("\n\n" if i % 37 == 0 else "\n" if i % 11 == 0 else " ")
    text += "x" * (size * 2 + 3)  # one word longer than a chunk
    chunks = rt.recursive_split(text, size, overlap)
    assert chunks and all(len(c) <= size for c in chunks)
    # every word survives in some chunk, in order of first appearance
    joined = "\n".join(chunks)
    for w in words:
        assert w in joined


def test_fixed_chunks_rejoin(spark):
    df = spark.createDataFrame([(1, "abcdefghij" * 25), (2, "")], "k int, t string")
    c = rt.fixed_chunks(df, "t", 100, 10).orderBy("k", "chunk_no").collect()
    assert [r.chunk_no for r in c] == [0, 1, 2]
    rebuilt = c[0].chunk + "".join(r.chunk[10:] for r in c[1:])
    assert rebuilt == "abcdefghij" * 25


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_similarity_search_exact(spark, metric):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 16)).astype(np.float32)
    q = rng.normal(size=(9, 16)).astype(np.float32)
    store = spark.createDataFrame(pd.DataFrame({"id": np.arange(700), "embedding": list(x)})).repartition(6)
    qs = spark.createDataFrame(pd.DataFrame({"qid": np.arange(9), "embedding": list(q)}))
    got = rt.similarity_search(store, qs, 4, metric).orderBy("qid", "rank").toPandas()
    xd, qd = x.astype(np.float64), q.astype(np.float64)
    if metric == "l2":
        d = np.sqrt(((qd[:, None, :] - xd[None]) ** 2).sum(-1))
    else:
        d = 1 - (qd / np.linalg.norm(qd, axis=1, keepdims=True)) @ (xd / np.linalg.norm(xd, axis=1, keepdims=True)).T
    for i in range(9):
        assert list(got[got.qid == i]["id"]) == list(np.lexsort((np.arange(700), d[i]))[:4])


@pytest.mark.parametrize("metric", ["l2", "cosine", "ip"])
def test_similarity_search_cells(spark, monkeypatch, metric):
    """Exact through the cell index, ties and zero vectors included, with a
    small share of the pairs looked at where vectors cluster."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 20
    x = (centres[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 16)) * 0.5).round(3)
    x[100:2100] = x[7]  # a third in one place
    x[50], x[5000] = 0, 0
    monkeypatch.setattr(rt, "BLOCK_ROWS", 512)
    store = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<double>").repartition(6)
    asked = [*range(0, 6000, 40), 50, 7]
    qs = spark.createDataFrame([(None if i == 80 else i, x[i].tolist()) for i in asked], "qid long, embedding array<double>")
    seen = spark.sparkContext.accumulator(0)
    got = rt.similarity_search(store, qs, 5, metric, round_digits=None, cells=60, evaluated=seen).toPandas()
    for i in asked:
        d = search.exact(metric, x[i], x)
        want = np.lexsort((np.arange(6000), d))[:5]
        rows = got[got.qid.isna() if i == 80 else got.qid == i].sort_values("rank")
        assert rows.id.tolist() == want.tolist() and np.array_equal(rows.dist.to_numpy(), d[want] + 0.0)
    share = seen.value / (len(asked) * 6000)
    print(f"{metric}: {share:.3f} of the pairs looked at")
    assert share < (0.45 if metric == "ip" else 0.4)


def test_similarity_search_cells_few_rows(spark):
    """Fewer rows than k, than cells, and no rows."""
    store = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(3)], "id long, embedding array<double>")
    for cells in (1, 2, 7):
        got = rt.similarity_search(store, store.withColumnRenamed("id", "qid"), 4, "l2", cells=cells).orderBy("qid", "rank").collect()
        assert [(r.qid, r.id) for r in got] == [(0, 0), (0, 1), (0, 2), (1, 1), (1, 0), (1, 2), (2, 2), (2, 1), (2, 0)]
        assert rt.similarity_search(store, store.limit(0).withColumnRenamed("id", "qid"), 4, "l2", cells=cells).count() == 0


@pytest.mark.parametrize("metric", ["l2", "cosine", "ip"])
def test_similarity_search_close_vectors_copies_and_blocks(spark, monkeypatch, metric):
    """Vectors 1e-6 apart rank by the raw distance, copies by id, over more
    queries and rows than a block holds; odd vectors take no part."""
    monkeypatch.setattr(rt, "BLOCK_ROWS", 40)
    monkeypatch.setattr(rt, "TILE_CELLS", 100)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 8))
    x = np.concatenate([base, base + 1e-6 * rng.normal(size=base.shape), base, base[:1].repeat(50, 0)])
    rows = [(int(i), [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(9001, None), (9002, [1.0]), (9003, [float("nan")] * 8), (9004, [None] * 8)]
    df = spark.createDataFrame(rows + odd, "id long, embedding array<double>").repartition(5)
    qs = df.withColumnRenamed("id", "qid")
    got = rt.similarity_search(df, qs, 5, metric, round_digits=None).toPandas()
    assert set(got.qid) == set(range(len(x))) and set(got["rank"]) == {1, 2, 3, 4, 5}
    for i in (0, 1, 59, 60, 130, 229):
        d = rt._exact(metric, x[i], x)
        assert list(got[got.qid == i].sort_values("rank")["id"]) == list(np.lexsort((np.arange(len(x)), d))[:5])
    assert rt.similarity_search(df.where("id > 9002"), qs, 5, metric).count() == 0


def test_search_against_rounding(spark):
    """The nearest vector wins although both distances round to zero."""
    store = spark.createDataFrame([(1, [4e-6, 0.0]), (2, [0.0, 0.0])], "id long, embedding array<double>")
    q = spark.createDataFrame([(7, [0.0, 0.0])], "qid long, embedding array<double>")
    assert [(r.id, r.dist) for r in rt.similarity_search(store, q, 2).orderBy("rank").collect()] == [(2, 0.0), (1, 0.0)]


def test_prompt_golden_text(spark):
    ctx = ["こんにちは、開発チームです。", "作業中は回路の意味を考えないことにしました。",
           "背の高い部品を先に付けると基板が安定しません。\nそして小さな問題が積み重なります・・・",
           "It's \"quoted\" \\ back"]
    q = "作業で使った道具を教えて下さい。"
    hits = spark.createDataFrame([("q1", i + 1, t) for i, t in enumerate(ctx)], "qid string, rank int, chunk string")
    qs = spark.createDataFrame([("q1", q)], "qid string, question string")
    got = rt.prompt_build(hits, qs).first().prompt
    assert got == rt.PROMPT_TEMPLATE_TEXT.format(context=str(ctx), question=q)


def test_markers_inside_values_stay(spark):
    hits = spark.createDataFrame([("q", 1, "see {question} and {context}")], "qid string, rank int, chunk string")
    qs = spark.createDataFrame([("q", "what is {context}?")], "qid string, question string")
    got = rt.prompt_build(hits, qs).first().prompt
    assert got == rt.PROMPT_TEMPLATE_TEXT.format(context=["see {question} and {context}"], question="what is {context}?")


def test_chunks_of_a_long_text_take_linear_time(spark):
    import time
    took = []
    for n in (600_000, 600_000, 1_200_000):
        df = spark.createDataFrame([(1, "あいうえお\n" * (n // 6))], "k int, t string")
        start = time.time()
        c = rt.fixed_chunks(df, "t", 100, 10)
        assert c.agg(F.sum(F.length("chunk"))).first()[0] > n
        took.append(time.time() - start)
    assert took[2] < 3.5 * took[1] + 1


def test_chunk_batches_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(rt, "CHUNKS_PER_BATCH", 7)
    df = spark.createDataFrame([(1, "ab " * 300, "x"), (2, None, "y"), (3, "", "z"), (4, "tiny", "w")], "k int, t string, chunk string")
    c = rt.recursive_chunks(df.drop("chunk"), "k", "t", 20, 5).collect()
    assert [r.chunk for r in c if r.k == 1] == rt.recursive_split("ab " * 300, 20, 5) and [r.chunk for r in c if r.k == 4] == ["tiny"]
    f = rt.fixed_chunks(df, "t", 20, 5)
    assert f.columns == ["k", "chunk_no", "chunk"] and f.where("k in (2, 3)").count() == 0


def test_py_repr_quotes(spark):
    for s in ["a'b", 'a"b', "a'b\"c", "tab\tnl\n", "back\\slash", "wide\u3000space", "\x00\x1f\x7f\xa0\xad", "\u200b\u2028\ufeff",
              "é文😀", "\U000e0001 \ue000"]:
        got = spark.range(1).select(rt.py_str_repr(F.lit(s)).alias("r")).first().r
        assert got == repr(s)


def test_qa_pairs_context_and_tokens(spark):
    turns = spark.createDataFrame([(1, 0, "system", "sys"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"),
                                   (1, 3, "user", "q2"), (1, 4, "assistant", "a2"), (2, 0, "user", "lonely")],
                                  "conv_id int, turn int, role string, text string")
    p = {(r.conv_id, r.turn): r for r in rt.qa_pairs(turns).collect()}
    assert set(p) == {(1, 1), (1, 3)}
    assert p[(1, 3)].question == "q2" and p[(1, 3)].answer == "a2"
    pairs = rt.qa_pairs(turns).withColumn("embedding", F.when(F.col("turn") == 1, F.array(F.lit(1.0), F.lit(0.0))).otherwise(
        F.array(F.lit(0.0), F.lit(1.0))))
    store = spark.createDataFrame([(1, "x", [1.0, 0.1]), (2, "y", [0.1, 1.0]), (3, "z", [5.0, 5.0])], "id int, text string, embedding array<double>")
    ctx = rt.with_context(pairs, store, ["conv_id", "turn"], k=2)
    assert {r.turn: r.context for r in ctx.collect()} == {1: ["x", "y"], 3: ["y", "x"]}
    examples = rt.sft_examples(ctx)
    assert {r.turn: r.inputs for r in examples.collect()}[1] == rt.PROMPT_TEMPLATE_DIALOGUE.format(context=["x", "y"], question="q1")
    ex = rt.sft_tokenize(examples, max_length=50)
    for r in ex.collect():
        assert r.input_ids == [ord(c) for c in r.inputs + r.labels + "</s>"][:50]
        assert len(r.input_ids) <= 50 and r.attention_mask == [1] * len(r.input_ids)
    b = rt.collate_batches(ex, ["conv_id", "turn"], batch_rows=12).collect()
    assert len({len(r.input_ids) for r in b}) == 1


def test_collection_append_idempotent(spark, tmp_path):
    from kestrel.sources.collection import collection_append, collection_scan
    rows = rt.assign_chunk_id(spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], "d int, c int, t string"),
                              "col", "d", "c")
    root = str(tmp_path / "store")
    collection_append(rows, root, "col")
    collection_append(rows, root, "col")
    assert collection_scan(spark, root, "col").count() == 2 and "shard" not in collection_scan(spark, root, "col").columns
    # an edited chunk is a new row where the id covers the content
    texts = spark.createDataFrame([(1, 0, "a"), (1, 0, "edited")], "d int, c int, t string")
    ids = [r.id for r in rt.assign_chunk_id(texts, "col", "d", "c", content="t").collect()]
    assert len(set(ids)) == 2
    from kestrel.sources.collection import collection_overwrite
    collection_append(rows, root, "other")
    collection_overwrite(rows.limit(1), root, "col")
    assert collection_scan(spark, root, "col").count() == 1 and collection_scan(spark, root, "other").count() == 2
    # a broken store is an error, not an empty one
    import pathlib
    from py4j.protocol import Py4JError
    from pyspark.errors import PySparkException
    (pathlib.Path(root) / "collection=col" / "shard=1").mkdir(exist_ok=True)
    for f in pathlib.Path(root).rglob("*.parquet"):
        f.write_bytes(b"not parquet")
    with pytest.raises((PySparkException, Py4JError)):
        collection_append(rows, root, "col")


def test_collection_versions(spark, tmp_path, monkeypatch):
    """Growing shards, filters that spare reads, whole versions, merged segments."""
    from kestrel.sources import collection as co
    monkeypatch.setattr(co, "SHARD_ROWS", 100)
    monkeypatch.setattr(co, "MOST_SEGMENTS", 4)
    root = str(tmp_path / "store")

    def rows(a, b, extra=False):
        df = spark.range(a, b).select(F.concat(F.lit("k"), "id").alias("id"), (F.col("id") * 2).alias("v"), F.lit("x").alias("shard"))
        return df.withColumn("more", F.lit(1)) if extra else df

    folder = co._Folder(spark, root, "c")
    co.collection_append(rows(0, 730), root, "c")
    assert folder.version() == 1 and folder.segments(1)[0]["shards"] == 8
    first = co.collection_scan(spark, root, "c")
    # shards the filters do not hit are not read: broken ones do no harm
    import pathlib
    sizes = {p.name: spark.read.parquet(str(p)).count() for p in (pathlib.Path(root) / "collection=c").rglob("shard=*")}
    assert sorted(sizes) == [f"shard={k}" for k in range(8)] and max(sizes.values()) < 160
    touched = co._stored_ids(spark, folder, folder.segments(1), rows(700, 760), "id")
    assert {f"k{k}" for k in range(700, 730)} <= {r.id for r in touched.collect()}
    assert co._stored_ids(spark, folder, folder.segments(1), rows(5000, 5020), "id") is None
    co.collection_append(rows(700, 760), root, "c")
    assert co.collection_scan(spark, root, "c").count() == 760 and first.count() == 730  # an open version stays
    # an append that dies before its manifest leaves no row
    monkeypatch.setattr(co._Folder, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        co.collection_append(rows(760, 800), root, "c")
    monkeypatch.undo()
    monkeypatch.setattr(co, "SHARD_ROWS", 100)
    monkeypatch.setattr(co, "MOST_SEGMENTS", 4)
    assert co.collection_scan(spark, root, "c").count() == 760
    # a version that exists is not replaced: the slower append starts again and sees the other's rows
    assert not folder.commit(folder.version(), [])
    real, raced = co._Folder.commit, []

    def race(self, version, segments):
        if not raced:
            raced.append(1)
            co.collection_append(rows(755, 770), root, "c")
        return real(self, version, segments)

    monkeypatch.setattr(co._Folder, "commit", race)
    co.collection_append(rows(760, 765), root, "c")
    monkeypatch.setattr(co._Folder, "commit", real)
    assert sorted(int(r.id[1:]) for r in co.collection_scan(spark, root, "c").collect()) == list(range(770))
    for k in range(4):
        co.collection_append(rows(770 + k, 771 + k, extra=k == 2), root, "c")
    assert len(folder.segments(folder.version())) <= 4
    last = co.collection_scan(spark, root, "c")
    assert last.count() == 774 and last.where("more = 1").count() == 1 and last.select("id").distinct().count() == 774
    co.collection_append(rows(0, 774), root, "c")
    assert co.collection_scan(spark, root, "c").count() == 774
    co.collection_append(rows(0, 1), root, "c", dedupe=False)
    assert co.collection_scan(spark, root, "c").count() == 775


@pytest.mark.parametrize("shards", [1, 2, 3, 5, 8, 13])
def test_linear_shards(spark, shards):
    from kestrel.sources.collection import linear_shard
    got = spark.range(2000).select(F.xxhash64("id").alias("h")).select(F.shiftrightunsigned("h", 1).alias("h")).select(
        "h", linear_shard(F.col("h"), shards).alias("a"), linear_shard(F.col("h"), F.lit(shards).cast("long")).alias("b"),
        linear_shard(F.col("h"), shards + 1).alias("c")).collect()
    assert {r.a for r in got} == set(range(shards)) and all(r.a == r.b for r in got)
    moved = {(r.a, r.c) for r in got if r.a != r.c}
    assert all(c == shards for _, c in moved) and len(moved) <= 1  # a new shard splits one


def test_embed_text_dimension(spark):
    df = spark.createDataFrame([("hello world",), ("",)], "t string")
    out = rt.embed_text(df, "t", dim=32).collect()
    assert all(len(r.embedding) == 32 for r in out)
    assert rt.dimension_guard(rt.embed_text(df, "t", dim=32), "embedding", 32).count() == 0


def test_chunk_ids_repeatable_or_random(spark):
    df = spark.createDataFrame([(1, 0), (1, 1)], "d int, c int")
    a = [r.id for r in rt.assign_chunk_id(df, "col", "d", "c").orderBy("c").collect()]
    b = [r.id for r in rt.assign_chunk_id(df, "col", "d", "c").orderBy("c").collect()]
    assert a == b and len(set(a)) == 2 and all(len(x) == 64 for x in a)
    u = [r.id for r in rt.assign_chunk_id(df, "col", "d", "c", random_uuid=True).collect()]
    assert len(set(u)) == 2 and all(len(x) == 36 for x in u)


def test_requests_hold_a_query_once_in_its_own_precision(spark, monkeypatch, tmp_path):
    """A round writes a row a query that still searches, whatever cells it asks for, and floats as floats."""
    monkeypatch.setattr(search, "scratch_path", lambda _, name: f"{tmp_path}/{name}")
    v = np.random.default_rng(8).normal(size=(600, 6)).astype(np.float32)
    e = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, embedding array<float>")
    q = e.where("id % 3 = 0").withColumnRenamed("id", "qid")
    got = {(r.qid, r["rank"]): r.id for r in rt.similarity_search(e, q, 3, cells=12).collect()}
    wide = v.astype(np.float64)
    for i in range(0, 600, 3):
        d = np.sqrt(((wide - wide[i]) ** 2).sum(1))
        assert [got[i, k] for k in (1, 2, 3)] == np.lexsort((np.arange(600), d))[:3].tolist()
    turns = sorted(p.name for p in (tmp_path / "cells").iterdir() if p.name.startswith("asked"))
    rows = [spark.read.parquet(f"{tmp_path}/cells/{t}") for t in turns]
    assert rows[0].count() == 200 and all(r.count() == r.select("qid").distinct().count() for r in rows)
    assert rows[0].schema["v"].dataType.elementType.simpleString() == "float"
