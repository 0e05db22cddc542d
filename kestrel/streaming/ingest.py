"""Incremental document ingestion and export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kestrel.operators import retrieval as rt
from kestrel.sinks.export import csv_lines
from kestrel.sources.collection import collection_append

DOCUMENT_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


def document_chunks_stream(spark: SparkSession, src: str, size: int = 100, overlap: int = 10,
                           collection: str = "documents", dim: int = 64,
                           schema: T.StructType = DOCUMENT_SCHEMA, max_files_per_trigger: int = 64) -> DataFrame:
    """Streaming DataFrame of (doc_id, chunk_no, chunk, id, embedding)."""
    c = _chunks(spark, src, size, overlap, schema, max_files_per_trigger)
    return _finished(c, collection, dim).select("doc_id", "source", "chunk_no", "chunk", "id", "embedding")


def _chunks(spark: SparkSession, src: str, size: int, overlap: int, schema: T.StructType = DOCUMENT_SCHEMA, max_files_per_trigger: int = 64) -> DataFrame:
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(src)
    return rt.fixed_chunks(s.select("doc_id", "text", "source"), "text", size, overlap)


def _finished(chunks: DataFrame, collection: str, dim: int = 64) -> DataFrame:
    """Chunks with id and vector."""
    return rt.embed_text(rt.assign_chunk_id(chunks, collection, "doc_id", "chunk_no", content="chunk"), "chunk", dim=dim)


def ingest_documents(spark: SparkSession, src: str, root: str, checkpoint: str, collection: str = "documents",
                     size: int = 100, overlap: int = 10, available_now: bool = True) -> StreamingQuery:
    """Chunk, id and embed arriving documents into a collection; each
    micro-batch is appended with id de-duplication (exactly-once effect)."""
    chunks = rt.assign_chunk_id(_chunks(spark, src, size, overlap), collection, "doc_id", "chunk_no", content="chunk")

    def sink(batch: DataFrame, epoch_id: int) -> None:
        # vectors are made of the chunks once these are dealt to their shards
        collection_append(batch, root, collection, dedupe=True, finish=lambda c: _finished(c, collection))

    w = chunks.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def export_stream(df: DataFrame, out_dir: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Delimited export of a streaming table (file sink: exactly-once
    through its commit log)."""
    w = (csv_lines(df).writeStream.format("text").option("path", out_dir)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
