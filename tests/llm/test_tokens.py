"""Token counts against the library, and the cache."""

import pytest

from kestrel.llm import tokens
from kestrel.session import scratch_path

P = pytest.importorskip("public_tokenizers")
TEXTS = ["plain words here", "", None, "  lead", "trail  ", "a\n b\n\nc", "x <|endoftext|> y", "don't 's", "é　ü\x85z\x1c q", "word " * 30_000, "a b", "a b"]


def library(path, texts):
    if path.endswith(".model"):
        import sentencepiece
        return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode([t or "" for t in texts])]
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts(spark, name):
    path = P.path(name)
    df = spark.createDataFrame([(i, t, 9) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r for r in tokens.token_counts(df, path, limit=3).collect()}
    want = library(path, TEXTS)
    for i, t in enumerate(TEXTS):
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), want[i], want[i] > 3)


def test_cache_is_used_and_only_misses_are_added(spark):
    path = P.path("byte_bpe_50k.json")
    cache = scratch_path(spark, "cache")
    one = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, "d")], "doc_id long, text string")
    assert [r.n_tokens for r in tokens.token_counts(one, path, cache).orderBy("doc_id").collect()] == [3, 3, 1]
    stored = spark.read.parquet(cache)
    assert stored.count() == 2
    # a stored count is believed, other versions are not
    version = tokens.tokenizer_digest(path)
    digest = one.selectExpr("unhex(sha2('zz', 256)) as d").first().d
    spark.createDataFrame([(version, digest, 77), ("other", digest, 5)], tokens.CACHE_SCHEMA).write.mode("append").parquet(cache)
    two = one.union(spark.createDataFrame([(4, "zz"), (5, "new")], "doc_id long, text string"))
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(two, path, cache).collect()}
    assert got[4] == 77 and got[1] == 3
    assert spark.read.parquet(cache).count() == 5  # one new text


def test_piece_cache_overflow(monkeypatch):
    path = P.path("byte_bpe_50k.json")
    monkeypatch.setattr(tokens, "PIECES_KEPT", 5)
    texts = [f"w{k} x{k} y{k} common" for k in range(30)]
    c = tokens.TokenCounter(path)
    assert [n for t in texts for n in c.count([t])] == library(path, texts)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.token_counts(df, P.path("byte_bpe_50k.json")).count() == 0
