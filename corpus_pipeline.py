"""Corpus pipeline: five stages from ``documents`` to packed sequences.

1. quality_classifier  documents outside their language's perplexity limits go
2. quality_rules       documents that fail the base rules or lie far out go
3. ngram_join          one document of each group of near copies stays
4. source_mixing       documents leave and repeat by their sources' targets
5. packing             pieces of sequences of at most 4096 tokens

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``.  Decisions meet the wide rows through
keys and fixed-size bit filters, so texts are shuffled only where a stage's
method needs it.

Cases: null texts count as empty and fail the base rules; rows that repeat
are one group of copies, of which one row stays; extra columns pass through
the first four stages; an empty table passes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kestrel.llm import bitfilter, mixing, ngramjoin, ngramlm, outliers, packing, workercache
from kestrel.llm.inputs import tokenizer, trusted
from kestrel.session import ensure_shipped, free_shuffles, scratch_path
from kestrel.sources.tables import table

KEY, MAYBE, NUMBER = "__pipeline_key", "__pipeline_maybe", "__pipeline_number"


def _settle(spark: SparkSession) -> None:
    """Frees what the stage before left: on the driver plans that nothing holds
    any more and the classes generated for them; on the executors garbage, so
    that heaps shrink to what is used, and tables kept by Python workers."""
    free_shuffles(spark)
    ensure_shipped(spark)

    def forget(batches):
        workercache.drop()
        yield from batches

    n = spark.sparkContext.defaultParallelism  # a task a core, on all executors
    spark.range(0, n, 1, n).select(F.reflect(F.lit("java.lang.System"), F.lit("gc")).alias("gc")).mapInArrow(forget, "gc string").collect()


def _text_md5() -> Column:
    return F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _settle(spark)
    # the verdict depends on language and text alone
    keyed = docs.withColumn(KEY, F.concat_ws("\u0001", F.coalesce("lang", F.lit("\u0002")), _text_md5()))
    judged = ngramlm.quality(keyed, trusted(spark, sf_dir), carry=[KEY])
    path = scratch_path(spark, "rejected")
    judged.where("not kept").select(KEY).distinct().write.parquet(path)
    rejected = spark.read.schema(f"{KEY} string").parquet(path)
    return bitfilter.anti_join(keyed, rejected, [KEY]).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _settle(spark)
    return outliers.quality_rules(docs).where("kept").select(*docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _settle(spark)
    def key(doc_id: Column, md5: Column) -> Column:
        return F.concat_ws("\u0001", F.coalesce(doc_id.cast("string"), F.lit("\u0002")), md5)

    found = ngramjoin.ngram_join(docs)
    members = found.groupBy("group", F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key").agg(F.count("*").alias("rows"))
    path = scratch_path(spark, "near-copies")
    members.write.parquet(path)  # without texts
    members = spark.read.parquet(path)
    first = members.groupBy("group").agg(F.min(F.struct("no_id", "doc_id", "text_key")).alias("first"))
    members = members.join(first, "group").select(
        key(F.col("doc_id"), F.lower(F.hex("text_key"))).alias(KEY), "rows",
        F.struct("no_id", "doc_id", "text_key").eqNullSafe(F.col("first")).alias("stays"))
    members.write.parquet(f"{path}-judged")
    members = spark.read.schema(f"{KEY} string, rows long, stays boolean").parquet(f"{path}-judged")
    # rows that go, and those that stay but have equal rows, by key; others never shuffle
    judged = members.where("not stays or rows > 1").select(KEY, "stays")
    keyed = bitfilter.with_flag(docs.withColumn(KEY, key(F.col("doc_id"), _text_md5())), judged, [KEY], MAYBE)
    first_of = F.row_number().over(Window.partitionBy(KEY).orderBy(F.lit(0)))
    some = keyed.where(MAYBE).join(judged, KEY, "left").where(F.coalesce("stays", F.lit(True)))
    some = some.withColumn(NUMBER, F.when(F.col("stays"), first_of).otherwise(1)).where(F.col(NUMBER) == 1)
    return keyed.where(~F.col(MAYBE)).select(*docs.columns).unionByName(some.select(*docs.columns))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _settle(spark)
    placed = mixing.mix(docs).where("shard is not null")
    return placed.repartition("shard").sortWithinPartitions("shard", "position").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _settle(spark)
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"), keep_ids=False)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("ngram_join", ngram_join),
    ("source_mixing", source_mixing),
    ("packing", pack),
]

#: No SQL form (fitted models); tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each stage's rows are written to the
    shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{path}/{k}-{name}")
            docs = spark.read.parquet(f"{path}/{k}-{name}")
    return docs
