"""Projection, recode, filter, check, aggregate and scalar-function plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions import format as fmt
from kestrel.functions import text as tx
from kestrel.operators import aggregate as agg
from kestrel.operators import relational as rl
from kestrel.operators import windows
from kestrel.plans.registry import plan
from kestrel.sources.tables import table


@plan("select_columns", ops=(10,), sql="""
select o_orderkey, o_custkey, o_totalprice, o_orderpriority,
       round(o_totalprice / 1000, 6) as o_totalprice_k from orders""")
def q_select_columns(spark, sf):
    o = table(spark, sf, "orders")
    return rl.select_columns(o, ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"],
                             [F.round(F.col("o_totalprice") / 1000, 6).alias("o_totalprice_k")])


@plan("drop_columns", ops=(11,), sql="select c_custkey, c_name, c_nationkey, c_mktsegment from customer")
def q_drop_columns(spark, sf):
    return rl.drop_columns(table(spark, sf, "customer"), "c_acctbal")


@plan("rename_upper", ops=(12,), sql="""
select n_nationkey as N_NATIONKEY, n_name as N_NAME, n_regionkey as N_REGIONKEY from nation""")
def q_rename_upper(spark, sf):
    return rl.rename_upper(table(spark, sf, "nation"))


@plan("staging_scan", ops=(2, 12, 46), sql="""
select s_suppkey as "INDEX", s_name as S_NAME, s_nationkey as S_NATIONKEY, s_acctbal as S_ACCTBAL
from supplier order by s_suppkey""")
def q_staging_scan(spark, sf):
    from kestrel.sources.staging import staging_scan
    s = table(spark, sf, "supplier").withColumnRenamed("s_suppkey", "index")
    return staging_scan(s, order_by="INDEX")


@plan("sql_select_alias", ops=(13, 60, 46), sql="""
select o_orderpriority as username, o_orderkey as user_id, strftime(o_orderdate, '%Y/%m/%d') as created
from orders order by created""")
def q_sql_select_alias(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("orders")
    return spark.sql("""select o_orderpriority as username, o_orderkey as user_id,
                        date_format(o_orderdate, 'yyyy/MM/dd') as created
                        from orders order by created""")


@plan("cast_string", ops=(14,), sql="""
select cast(c_custkey as varchar) as c_custkey, cast(c_nationkey as varchar) as c_nationkey from customer""")
def q_cast_string(spark, sf):
    return rl.cast_string(table(spark, sf, "customer").select("c_custkey", "c_nationkey"),
                          "c_custkey", "c_nationkey")


@plan("fill_null", ops=(15,), sql="""
select c.c_custkey, coalesce(o.last_priority, 'UNKNOWN') as last_priority, coalesce(o.n_orders, 0) as n_orders
from customer c left join (select o_custkey, max(o_orderpriority) as last_priority, count(*) as n_orders
                           from orders group by o_custkey) o on o.o_custkey = c.c_custkey""")
def q_fill_null(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.max("o_orderpriority").alias("last_priority"), F.count(F.lit(1)).alias("n_orders"))
    c = table(spark, sf, "customer").select("c_custkey")
    j = c.join(o, c.c_custkey == o.o_custkey, "left").drop("o_custkey")
    return rl.fill_null(j, {"last_priority": "UNKNOWN", "n_orders": 0})


@plan("nan_to_null", ops=(16,), sql="""
select event_id, case when value < 1 then null else value end as value,
       cast(floor(value) as bigint) as value_int from events""")
def q_nan_to_null(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", F.when(F.col("value") < 1, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        F.floor("value").cast("double").alias("value_int"))
    return rl.nan_to_null(e, ["value"], integral={"value_int": True})


@plan("bucket_level", ops=(18,), sql="""
select l_orderkey, l_linenumber, case when l_linenumber in (1, 2, 3) then 'LOW'
       when l_linenumber in (4, 5) then 'HIGH' else cast(l_linenumber as varchar) end as LV from lineitem""")
def q_bucket_level(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", rl.bucket_level("l_linenumber").alias("LV"))


@plan("recode_correct", ops=(19,), sql="""
select doc_id, case when cast(quality as varchar) in ('1', '1.0', 'T', 'TRUE') then 'USE'
       when cast(quality as varchar) in ('0', '0.0', 'F', 'FALSE') then 'OMIT'
       else cast(quality as varchar) end as CORRECT from labels""")
def q_recode_correct(spark, sf):
    lb = table(spark, sf, "labels")
    return lb.select("doc_id", rl.recode_correct("quality").alias("CORRECT"))


@plan("filter_eq", ops=(21,), sql="""
select l_orderkey, l_linenumber, l_linestatus from lineitem where l_linestatus = 'F'""")
def q_filter_eq(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    return rl.filter_eq(li, "l_linestatus", "F")


@plan("filter_range", ops=(22, 98), sql="""
select event_id, value from events where value > 5 and value <= 20""")
def q_filter_range(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    return rl.filter_range(e, "value", 5, 20)


@plan("filter_in_list", ops=(23,), sql="""
select o_orderkey, o_orderpriority from orders where o_orderpriority in ('1-URGENT', '2-HIGH')""")
def q_filter_in_list(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return rl.filter_in_list(o, "o_orderpriority", ["1-URGENT", "2-HIGH"])


@plan("dense_row_index", ops=(24, 46), sql="""
select o_orderkey, row_number() over (order by o_totalprice, o_orderkey) - 1 as "index" from orders""")
def q_dense_row_index(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return windows.dense_row_index(o, ["o_totalprice", "o_orderkey"]).select("o_orderkey", "index")


@plan("assert_domain", ops=(25,), sql="""
with f as (select distinct l_returnflag as v from lineitem),
     e as (select * from (values ('A'), ('R'), ('X')) t(v))
select coalesce(f.v, e.v) as value, case when e.v is null then 'unexpected' else 'missing' end as problem
from f full outer join e on f.v = e.v where f.v is null or e.v is null""")
def q_assert_domain(spark, sf):
    return rl.assert_domain(table(spark, sf, "lineitem"), "l_returnflag", ["A", "R", "X"])


@plan("assert_count", ops=(26, 75), sql="""
select cast(count(*) as bigint) as split_total, cast(count(*) as bigint) as total, true as ok from documents
union all select cast(count(*) - ceil(count(*) * 0.25) as bigint), cast(count(*) as bigint), false from documents""")
def q_assert_count(spark, sf):
    """The parts of an exact split against all rows, and one part alone."""
    from kestrel.operators.textml import train_test_split
    d = table(spark, sf, "documents").select("doc_id")
    parts = train_test_split(d, "doc_id", 0.25, 42)
    return rl.assert_count(parts, "split").union(rl.assert_count(parts, "split", ("train",)))


@plan("zip_columns", ops=(30, 20), sql="""
select o_orderkey as ID, o_totalprice as price, n_lines from orders
join (select l_orderkey, count(*) as n_lines from lineitem where l_shipdate is not null group by l_orderkey) on l_orderkey = o_orderkey""")
def q_zip_columns(spark, sf):
    left = table(spark, sf, "orders").select(F.col("o_orderkey").alias("ID"), F.col("o_totalprice").alias("price"))
    lines = rl.filter_not_null(table(spark, sf, "lineitem"), "l_shipdate")
    right = lines.groupBy(F.col("l_orderkey").alias("ID")).agg(F.count(F.lit(1)).alias("n_lines"))
    return rl.zip_columns(left, right, "ID")


@plan("semi_join_split", ops=(29,), sql="""
select doc_id, lang from documents where doc_id in (select doc_id from labels)""")
def q_semi_join_split(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return rl.semi_join_split(d, table(spark, sf, "labels"), "doc_id")


@plan("distinct_values", ops=(32,), sql="select distinct o_orderpriority, o_orderstatus from orders")
def q_distinct_values(spark, sf):
    return agg.distinct_values(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")


@plan("row_count", ops=(33,), sql="select cast(count(*) as bigint) as n from lineitem")
def q_row_count(spark, sf):
    return agg.row_count(table(spark, sf, "lineitem"))


@plan("filtered_sum", ops=(35,), sql="""
select round(sum(l_extendedprice) filter (where l_returnflag = 'R'), 2) as sum_failed from lineitem""")
def q_filtered_sum(spark, sf):
    li = table(spark, sf, "lineitem")
    s = agg.filtered_sum(li, "l_extendedprice", F.col("l_returnflag") == "R", "sum_failed")
    return s.select(F.round("sum_failed", 2).alias("sum_failed"))


@plan("column_profile", ops=(42,), sql="""
select 0 as pos, 'c_custkey' as "column", count(c_custkey) as non_null, 'bigint' as dtype from customer union all select 1 as pos, 'c_name' as "column", count(c_name) as non_null, 'string' as dtype from customer union all select 2 as pos, 'c_nationkey' as "column", count(c_nationkey) as non_null, 'int' as dtype from customer union all select 3 as pos, 'c_acctbal' as "column", count(c_acctbal) as non_null, 'double' as dtype from customer union all select 4 as pos, 'c_mktsegment' as "column", count(c_mktsegment) as non_null, 'string' as dtype from customer""")
def q_column_profile(spark, sf):
    return agg.column_profile(table(spark, sf, "customer"))


@plan("grouped_bar_table", ops=(40,), sql="""
select o_orderpriority, round(sum(o_totalprice) filter (where o_orderstatus = 'F'), 2) as F,
       round(sum(o_totalprice) filter (where o_orderstatus = 'O'), 2) as O,
       round(sum(o_totalprice) filter (where o_orderstatus = 'P'), 2) as P
from orders group by o_orderpriority""")
def q_grouped_bar_table(spark, sf):
    t = agg.grouped_bar_table(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus",
                              "o_totalprice", ["F", "O", "P"])
    return t.select("o_orderpriority", *[F.round(c, 2).alias(c) for c in ("F", "O", "P")])


@plan("log_histogram", ops=(41, 45, 6), sql="""
with b as (select case when value <= 0 then 0
                  when log10(value) < 0 then 0 when log10(value) >= 5 then 21
                  else cast(floor(log10(value) * 20 / 5) as int) + 1 end as bin, count(*) as n
           from events where value is not null group by 1),
     e as (select bin, edge, lead(edge) over (order by bin) - edge as width
           from (select cast(i + 1 as int) as bin, pow(10, i * 0.25) as edge from range(21) t(i)))
select b.bin, cast(b.n as bigint) as n, round(e.edge, 9) as edge, round(e.width, 9) as width,
       round(case when e.bin <= 20 then pow(sin(0.01 * (e.edge - 20)) + 3, 10) end, 6) as formula
from b left join e on e.bin = b.bin""")
def q_log_histogram(spark, sf):
    h = agg.log_histogram(table(spark, sf, "events"), "value", with_formula=True)
    return h.select("bin", "n", F.round("edge", 9).alias("edge"), F.round("width", 9).alias("width"),
                    F.round("formula", 6).alias("formula"))


@plan("order_by", ops=(46,), sql="select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey")
def q_order_by(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey")


@plan("shuffle_rows", ops=(47, 24), sql="""
select conv_id, turn, role, row_number() over (order by md5(conv_id || '/' || turn || ':7'), conv_id, turn) - 1 as pos
from conversations""")
def q_shuffle_rows(spark, sf):
    """The shuffled order as row numbers."""
    from kestrel.operators.textml import shuffle_key
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    order = [shuffle_key(["conv_id", "turn"], 7), F.col("conv_id"), F.col("turn")]
    return windows.dense_row_index(c, order, "pos")


# ---- scalar text / date / number functions (whole texts) ----

@plan("strip_markers", ops=(49,), sql="""
select doc_id, md5(replace(replace(replace(text, '<HTML>', ''), '<XML>', ''), '<SGML>', '')) as h,
       md5(replace(replace(replace(text, 'HTML', ''), '<XML>', ''), '<SGML>', '')) as h_followup
from (select doc_id, replace(replace(text, ' the ', ' <HTML> '), ' de ', '<XML>HTML<SGML>') as text from documents)""")
def q_strip_markers(spark, sf):
    marked = F.replace(F.replace("text", F.lit(" the "), F.lit(" <HTML> ")), F.lit(" de "), F.lit("<XML>HTML<SGML>"))
    d = table(spark, sf, "documents").withColumn("text", marked)
    return d.select("doc_id", F.md5(tx.strip_markers("text")).alias("h"),
                    F.md5(tx.strip_markers("text", tx.FOLLOWUP_MARKERS)).alias("h_followup"))


#: Every pre-split case, after each text.
_CASES = "。)x>。y。<z。。w>。。<v<HTML>u<XML>t<SGML>"


def _presplit_sql(e: str) -> str:
    for x, y in tx.PRESPLIT_RULES:
        y = "chr(10)" if y == "\n" else f"'{y}'"
        e = f"replace({e}, '{x}', {y})"
    return f"replace({e}, chr(10), '。')"


_CASED = f"text || '{_CASES}'"


@plan("presplit_text", ops=(50,), sql=f"""
select doc_id, md5({_presplit_sql(f"lower({_CASED})")}) as h_lower, md5({_presplit_sql(_CASED)}) as h,
       cast(length({_presplit_sql(_CASED)}) as int) as n from documents""")
def q_presplit_text(spark, sf):
    t = F.concat("text", F.lit(_CASES))
    p = tx.presplit_text(t)
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(tx.presplit_text(F.lower(t))).alias("h_lower"), F.md5(p).alias("h"), F.length(p).alias("n"))


@plan("lower_strip", ops=(51,), sql="""
select conv_id, turn, regexp_replace(regexp_replace(lower(text), '^\\s+', ''), '\\s+$', '') as t
from conversations""")
def q_lower_strip(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", tx.lower_strip("text").alias("t"))


@plan("concat_fields", ops=(52,), sql="""
select doc_id, md5(source || ' ' || lang || ' ' || text) as h from documents""")
def q_concat_fields(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.md5(tx.concat_fields("source", "lang", "text")).alias("h"))


@plan("url_tail", ops=(53, 55), sql="""
select page_id, regexp_extract(url, '([^/]*)$', 1) as tail,
       regexp_replace(regexp_extract(url, '([^/]*)$', 1), '\\.[^.]*$', '') || '-predict' as stem from pages""")
def q_url_tail(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", tx.url_tail("url").alias("tail"), tx.path_stem("url", "-predict").alias("stem"))


@plan("first_field", ops=(54,), sql="""
select conv_id, turn, split_part(text, ',', 1) as first from conversations""")
def q_first_field(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", tx.first_field("text").alias("first"))


@plan("regex_strip", ops=(59,), sql="""
select doc_id, md5(regexp_replace(text, '(?m)^[^\\n]*(?:[Ll]icen[cs]e|[Cc]opyright)[^\\n]*\\n?', '', 'g')) as h
from documents""")
def q_regex_strip(spark, sf):
    d = table(spark, sf, "documents")
    pat = r"(?m)^[^\n]*(?:[Ll]icen[cs]e|[Cc]opyright)[^\n]*\n?"
    return d.select("doc_id", F.md5(tx.regex_strip("text", pat)).alias("h"))


@plan("date_to_text", ops=(60, 61), sql="""
select event_id, strftime(ts, '%Y/%m/%d') as day, strftime(ts, '%Y/%m/%d %H:%M:%S') as stamp,
       strftime(strptime(strftime(ts, '%Y/%m/%d %H:%M:%S'), '%Y/%m/%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') as parsed
from events""")
def q_date_to_text(spark, sf):
    e = table(spark, sf, "events")
    stamp = fmt.date_to_text("ts", "yyyy/MM/dd HH:mm:ss")
    return e.select("event_id", fmt.date_to_text("ts").alias("day"), stamp.alias("stamp"),
                    F.date_format(fmt.text_to_date(stamp), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@plan("math_expr", ops=(62,), sql="""
select event_id, round(pow(sin(0.01 * (value - 20)) + 3, 10), 3) as height,
       round(exp(-value / 100), 9) as surv, round(ln(value), 9) as ln_v, round(1 / value, 9) as inv
from events where value > 0""")
def q_math_expr(spark, sf):
    e = table(spark, sf, "events").where(F.col("value") > 0)
    v = F.col("value")
    return e.select("event_id", F.round(F.pow(F.sin(F.lit(0.01) * (v - 20)) + 3, 10), 3).alias("height"),
                    F.round(F.exp(-v / 100), 9).alias("surv"), F.round(F.ln(v), 9).alias("ln_v"),
                    F.round(F.lit(1.0) / v, 9).alias("inv"))


@plan("round_half_even", ops=(63,), sql="""
select l_orderkey, l_linenumber, round_even(l_quantity / 2, 0) as half_even, round(l_quantity / 2, 0) as half_up
from lineitem""")
def q_round_half_even(spark, sf):
    li = table(spark, sf, "lineitem")
    h = F.col("l_quantity") / 2
    return li.select("l_orderkey", "l_linenumber", fmt.round_half_even(h, 0).alias("half_even"),
                     F.round(h, 0).alias("half_up"))


@plan("number_report_text", ops=(64,), sql="""
select o_orderpriority, printf('%,.2f (%.2E)', round(avg(o_totalprice), 4), round(avg(o_totalprice), 4)) as avg_text,
       printf('%,.0f (%.2E)', round_even(count(*) + 0.5, 0), count(*) + 0.5::double) as tie_text
from orders group by o_orderpriority""")
def q_number_report_text(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.round(F.avg("o_totalprice"), 4).alias("a"), (F.count(F.lit(1)) + F.lit(0.5)).cast("double").alias("t"))
    return o.select("o_orderpriority", fmt.number_report_text("a", 2).alias("avg_text"),
                    fmt.number_report_text("t", 0).alias("tie_text"))


@plan("typed_report", ops=(65, 27), sql="""
select printf('%,d', o_orderkey) as o_orderkey, printf('%,.3f', o_totalprice) as o_totalprice,
       o_orderpriority, strftime(o_orderdate, '%Y/%m/%d %H:%M:%S') as o_orderdate from orders""")
def q_typed_report(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    return fmt.typed_report(rl.assert_types(o))
