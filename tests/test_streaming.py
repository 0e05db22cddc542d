from pyspark.sql import types as T

from kestrel.sinks.export import csv_lines
from kestrel.streaming.ingest import export_stream


def test_export_stream_matches_batch_lines(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType()),
                           T.StructField("v", T.DoubleType())])
    rows = [(1, 'a"b', 1.5), (2, None, None), (3, "plain", 2.0)]
    src = str(tmp_path / "landing")
    spark.createDataFrame(rows, schema).write.parquet(src)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    q = export_stream(spark.readStream.schema(schema).parquet(src), out, ckpt)
    q.awaitTermination()
    got = sorted(r.value for r in spark.read.text(out).collect())
    want = sorted(r.value for r in csv_lines(spark.createDataFrame(rows, schema)).collect())
    assert got == want == sorted(['1,"a""b",1.5', '2,"",""', '3,"plain",2.0'])
    # a second run over the same input adds nothing (file sink commit log)
    export_stream(spark.readStream.schema(schema).parquet(src), out, ckpt).awaitTermination()
    assert spark.read.text(out).count() == 3


def test_ingest_replay_is_idempotent(spark, tmp_path):
    from kestrel.sources.collection import collection_scan
    from kestrel.streaming.ingest import DOCUMENT_SCHEMA, ingest_documents
    docs = [(1, "alpha beta " * 30, "en", "s1", 330), (2, "gamma " * 50, "en", "s2", 300)]
    src, root = str(tmp_path / "landing"), str(tmp_path / "store")
    spark.createDataFrame(docs, DOCUMENT_SCHEMA).write.parquet(src)
    ingest_documents(spark, src, root, str(tmp_path / "ck1")).awaitTermination()
    n = collection_scan(spark, root, "documents").count()
    assert n == 4 + 4  # 330 and 300 characters in windows of 100 every 90
    # the same files again under a new checkpoint (a lost checkpoint): nothing is added twice
    ingest_documents(spark, src, root, str(tmp_path / "ck2")).awaitTermination()
    assert collection_scan(spark, root, "documents").count() == n


def test_ingest_deals_rows_once_without_vectors(spark, tmp_path, monkeypatch):
    """One exchange for equal ids and shards; equal rows and other batches' rows are stored once, with their vectors."""
    from pyspark.sql import DataFrameWriter
    from pyspark.sql import functions as F

    from kestrel.operators import retrieval as rt
    from kestrel.sources import collection as co
    from kestrel.streaming.ingest import DOCUMENT_SCHEMA, ingest_documents
    monkeypatch.setattr(co, "SHARD_ROWS", 5)
    docs = [(k, f"alpha beta {k % 3} " * 20, "en", "s", 0) for k in range(9)]
    src, root, plans = str(tmp_path / "landing"), str(tmp_path / "store"), []
    spark.createDataFrame(docs + docs[:4], DOCUMENT_SCHEMA).write.parquet(src)
    write = DataFrameWriter.parquet

    def noted(self, path, *a, **b):
        if path.endswith("/rows"):
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *a, **b)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    ingest_documents(spark, src, root, str(tmp_path / "ck1")).awaitTermination()
    above = plans[0].split("InMemoryTableScan")[0]
    assert len(plans) == 1 and above.count("Exchange hashpartitioning") == 1
    spark.createDataFrame(docs[2:] + [(20, "gamma " * 30, "en", "s", 0)], DOCUMENT_SCHEMA).write.mode("append").parquet(src)
    ingest_documents(spark, src, root, str(tmp_path / "ck2")).awaitTermination()
    got = co.collection_scan(spark, root, "documents")
    want = spark.createDataFrame(docs + [(20, "gamma " * 30, "en", "s", 0)], DOCUMENT_SCHEMA).select("doc_id", "text", "source")
    want = rt.assign_chunk_id(rt.fixed_chunks(want, "text", 100, 10), "documents", "doc_id", "chunk_no", content="chunk")
    cols = ["doc_id", "chunk_no", "chunk", "id", F.transform("embedding", lambda x: F.round(x, 5)).alias("embedding")]
    key = lambda r: (r.doc_id, r.chunk_no)
    assert sorted(got.select(*cols).collect(), key=key) == sorted(rt.embed_text(want, "chunk").select(*cols).collect(), key=key)
