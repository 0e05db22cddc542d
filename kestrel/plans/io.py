"""Source/sink plans.  Each writes a table Spark derives from the driver
tables into the shared checkpoint folder and reads it back through the
source under test, so the SQL oracle is the original table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.plans.registry import plan
from kestrel.plans.reliability import _PARTS, _SEG
from kestrel.session import scratch_path
from kestrel.sinks import export as ex
from kestrel.sources.tables import table


@plan("csv_export", ops=(99,), sql="""
select concat_ws(',', cast(c_custkey as varchar), '"' || replace(c_name, '"', '""') || '"',
                 cast(c_nationkey as varchar), cast(c_acctbal as varchar),
                 '"' || replace(c_mktsegment, '"', '""') || '"') as value from customer""")
def q_csv_export(spark, sf):
    path = ex.csv_export(table(spark, sf, "customer"), scratch_path(spark, "export"), "customer")
    return spark.read.text(path)


@plan("csv_export_numbers", ops=(99, 60), sql="""
select concat_ws(',', cast(l_orderkey as varchar), cast(l_extendedprice * 1000 as varchar),
                 cast(l_discount / 10000 as varchar), '"' || strftime(l_shipdate, '%Y-%m-%d') || '"') as value from lineitem""")
def q_csv_export_numbers(spark, sf):
    """Large and small doubles and dates in script form."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_extendedprice") * 1000, F.col("l_discount") / 10000, F.col("l_shipdate").cast("date").alias("d"))
    return spark.read.text(ex.csv_export(li, scratch_path(spark, "export"), "lineitem"))


LINEITEM_TSV_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.StringType())])


@plan("delimited_scan", ops=(3,), sql="""
select l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus,
       strftime(l_shipdate, '%Y/%m/%d') as l_shipdate from lineitem""")
def q_delimited_scan(spark, sf):
    from kestrel.sources.delimited import delimited_scan
    path = scratch_path(spark, "tsv")
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
        F.date_format("l_shipdate", "yyyy/MM/dd").alias("l_shipdate"))
    li.write.option("sep", "\t").option("header", True).csv(path)
    return delimited_scan(spark, path, LINEITEM_TSV_SCHEMA, sep="\t", encoding="cp932")


ORDERS_BOOK_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderpriority", T.StringType()), T.StructField("o_orderdate", T.TimestampType())])


@plan("workbook_roundtrip", ops=(4, 101), sql="""
select o_orderkey, o_totalprice, o_orderpriority || chr(7) as o_orderpriority, strftime(o_orderdate, '%Y/%m/%d %H:%M:%S') as o_orderdate
from orders""")
def q_workbook_roundtrip(spark, sf):
    """Numbers, date cells and a control character through workbooks."""
    from kestrel.sources.workbook import workbook_scan, workbook_write
    path = scratch_path(spark, "workbooks")
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.concat("o_orderpriority", F.lit("\x07")).alias("o_orderpriority"),
                                          F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    workbook_write(o, path, row_cap=100_000)
    return workbook_scan(spark, path, ORDERS_BOOK_SCHEMA).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss"))


@plan("report_workbook", ops=(101, 4, 40), sql="""
select o_orderpriority, cast(count(*) as bigint) as n from orders group by 1
union all select 'region ' || r_name, cast(r_regionkey as bigint) from region""")
def q_report_workbook(spark, sf):
    """Two named sheets in one workbook, the second at an offset."""
    from kestrel.sources.workbook import report_workbook, workbook_scan
    path = scratch_path(spark, "report")
    counts = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    regions = table(spark, sf, "region").select(F.concat(F.lit("region "), "r_name").alias("name"), F.col("r_regionkey").cast("bigint").alias("key"))
    report_workbook({"counts": counts, "regions & more": (regions, 2, 2)}, path)
    a = workbook_scan(spark, path, T.StructType([T.StructField("o_orderpriority", T.StringType()), T.StructField("n", T.LongType())]), "counts")
    b = workbook_scan(spark, path, T.StructType([T.StructField("name", T.StringType()), T.StructField("key", T.LongType())]), "regions & more")
    return a.union(b)


@plan("text_roundtrip", ops=(102, 7), sql="""
select cast(sum(length(text) + 1) as bigint) as n_chars,
       cast(sum(length(text) - length(replace(text, chr(10), '')) + 1) as bigint) as n_lines from documents""")
def q_text_roundtrip(spark, sf):
    """Texts written as text files of some hundred documents, read back
    whole file by whole file."""
    from kestrel.sources.text import text_document_scan
    path = scratch_path(spark, "text")
    ex.text_write(table(spark, sf, "documents"), "text", path, rows_per_file=500)
    docs = text_document_scan(spark, path)
    return docs.agg(F.sum(F.length("page_content")).cast("bigint").alias("n_chars"),
                    F.sum(F.length("page_content") - F.length(F.replace("page_content", F.lit("\n"), F.lit(""))))
                    .cast("bigint").alias("n_lines"))


@plan("staging_overwrite", ops=(100,), sql="select o_orderkey, o_custkey, o_orderstatus from orders")
def q_staging_overwrite(spark, sf):
    path = scratch_path(spark, "staging")
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_orderkey"), F.col("c_nationkey").cast("bigint").alias("o_custkey"),
        F.col("c_mktsegment").alias("o_orderstatus"))
    ex.staging_overwrite(c, path)
    ex.staging_overwrite(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), path)
    return spark.read.parquet(path)


@plan("inline_table", ops=(5, 17), sql="""
select l.l_orderkey, l.l_linenumber, m.event from lineitem l
join (values ('R', '故障'), ('A', '生存'), ('N', '生存')) m(flag, event) on m.flag = l.l_returnflag""")
def q_inline_table(spark, sf):
    from kestrel.operators.reliability import FAILURE, SURVIVOR
    from kestrel.sources.inline import inline_table
    m = inline_table(spark, [("R", FAILURE), ("A", SURVIVOR), ("N", SURVIVOR)], "flag string, event string")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return li.join(F.broadcast(m), li.l_returnflag == m.flag).select("l_orderkey", "l_linenumber", "event")


@plan("parameter_output", ops=(104, 72), sql=f"{_SEG}, {_PARTS}")
def q_parameter_output(spark, sf):
    """The parameter table written as CSV and read again."""
    from kestrel.operators.reliability import weibull_parameter_table
    from kestrel.plans.reliability import _fit_and_seg, _shown
    _, seg = _fit_and_seg(spark, sf)
    path = scratch_path(spark, "params")
    table_ = weibull_parameter_table(seg)
    ex.parameter_output(table_, path)
    return _shown(spark.read.option("header", True).schema(table_.schema).csv(path))


@plan("stream_ingest", ops=(86, 88, 87, 89), sql="""
select doc_id, cast(i // 90 as int) as chunk_no,
       sha256(concat_ws('/', 'documents', doc_id, cast(i // 90 as int), md5(substring(text, i + 1, 100)))) as id
from (select doc_id, text, unnest(generate_series(0, greatest(length(text) - 1, 0), 90)) as i from documents)
where length(substring(text, i + 1, 100)) > 0""")
def q_stream_ingest(spark, sf):
    """Documents land in a folder; the streaming job chunks, ids and
    embeds them into a collection (idempotent micro-batches)."""
    from kestrel.sources.collection import collection_scan
    from kestrel.streaming.ingest import ingest_documents
    src = scratch_path(spark, "landing")
    table(spark, sf, "documents").write.parquet(src)
    root = scratch_path(spark, "stream-collections")
    q = ingest_documents(spark, src, root, scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    return collection_scan(spark, root, "documents").select("doc_id", "chunk_no", "id")
