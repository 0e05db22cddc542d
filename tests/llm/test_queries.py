"""Registered queries of the subpackage against DuckDB, and the pipeline."""

import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from kestrel.llm import mixing, ngramjoin, ngramlm, outliers
from kestrel.llm.queries import ORACLE_SQL, QUERIES
from kestrel.sources.tables import table
from tests.conftest import SF001


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_duckdb(spark, name):
    from tests.oracle import compare, duck
    ok, msg = compare(spark, SF001, name, QUERIES[name], ORACLE_SQL[name], duck(SF001))
    assert ok, msg


def test_contract_columns(spark):
    want = {
        "op3_quality_lm": ["doc_id", "lang", "n_chars", "perplexity", "low", "high", "kept"],
        "op4_toxicity": ["doc_id", "held_out", "score", "predicted"],
        "op5_ngram_join": ["doc_id", "class_id", "n_links"],
        "op6_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        "op7_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"],
        "op8_mixing": ["doc_id", "size", "source_size", "target", "taken"],
        "op10_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        "op11_group_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        "op12_token_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    }
    n = table(spark, SF001, "documents").count()
    for name, cols in want.items():
        df = QUERIES[name](spark, SF001)
        assert df.columns == cols
        if name not in ("op6_packing", "op11_group_packing"):
            assert df.count() == n
    assert set(QUERIES) == set(want) | set(ORACLE_SQL)


def test_held_out_rows(spark):
    got = QUERIES["op4_toxicity"](spark, SF001).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_mixing_query(spark):
    got = QUERIES["op8_mixing"](spark, SF001).collect()
    by_target = Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        by_target[r.target, r.source_size] += r.taken
    assert sum(t for t, _ in by_target) == pytest.approx(1.5 * sum(s for _, s in by_target))
    for (target, size), taken in by_target.items():
        assert abs(taken - target) <= 0.05 * size  # ten documents a source


def test_pipeline_stages(spark):
    """Each stage against its operator's verdicts, or their brute-force meaning."""
    docs = table(spark, SF001, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "ngram_join", "source_mixing", "packing"]
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF001).cache()
        rows[name] = Counter(map(tuple, docs.collect()))
        if name != "packing":
            assert docs.columns == before.columns
        old = Counter(map(tuple, before.collect()))
        if name == "quality_classifier":
            good = ngramlm.quality(before, spark.read.parquet(f"{SF001}/labels.parquet").where("quality = 1").select("doc_id"))
            ids = {r.doc_id for r in good.where("kept").collect()}
            assert rows[name] == Counter({k: v for k, v in old.items() if k[0] in ids}) and 0 < len(ids) < before.count()
        elif name == "quality_rules":
            ids = {r.doc_id for r in outliers.quality_rules(before).where("kept").collect()}
            assert rows[name] == Counter({k: v for k, v in old.items() if k[0] in ids})
        elif name == "ngram_join":
            ids = {r.class_id for r in ngramjoin.ngram_join(before).collect()}
            assert rows[name] == Counter({k: 1 for k in old if k[0] in ids}) and len(ids) < before.count()
        elif name == "source_mixing":
            assert set(rows[name]) <= set(old) and max(rows[name].values()) <= 2
            words = mixing.mix(before).where("shard is not null").agg({"size": "sum"}).first()[0]
            assert words == sum(len(k[1].split()) * v for k, v in rows[name].items())
        else:
            assert {k[0] for k in rows[name]} == {k[0] for k in old}
            fill = Counter()
            for k, v in rows[name].items():
                fill[k[5]] += k[2] * v
            assert max(fill.values()) <= 4096 and sum(f < 4096 for f in fill.values()) <= 1
    assert np.array(sorted(fill.values()))[-1] == 4096


def test_pipeline_edges(spark):
    docs = spark.createDataFrame(
        [(None, None, None, None, None, "x"), (1, "", "en", "s", 0, "x"), (2, "w " * 30, "en", None, 1, "x"), (2, "w " * 30, "en", None, 1, "x"),
         *[(k, " ".join(f"word{(k * 37 + j * j) % 997}" for j in range(40)), "en", "s", 1, "x") for k in range(3, 60)]],
        "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for d in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, d, SF001)
            assert out.columns == docs.columns
            out.count()
        corpus_pipeline.STAGES[-1][1](spark, d, SF001).count()


def test_stages_begin_with_empty_workers(spark):
    """What Python workers kept for the stage before is gone when the next begins."""
    from kestrel.llm import workercache
    from kestrel.session import ensure_shipped
    ensure_shipped(spark)

    def kept(batches):
        yield from batches
        workercache.kept("test", lambda: [0])

    def count(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(workercache._KEPT)] * b.num_rows, pa.int64())], names=["n"])

    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).mapInArrow(kept, "id long").collect()
    corpus_pipeline._settle(spark)
    assert sum(r.n for r in spark.range(0, n, 1, n).mapInArrow(count, "n long").collect()) == 0
