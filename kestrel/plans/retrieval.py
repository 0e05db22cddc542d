"""Retrieval plans: pages, documents, embeddings, conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import retrieval as rt
from kestrel.plans.registry import plan
from kestrel.sources.tables import table
from kestrel.sources.text import page_scan


@plan("html_element_text", ops=(84, 8), sql="""
select page_id, url, 'ad' as class_name, regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1) as content
from pages""")
def q_html_element_text(spark, sf):
    pages = page_scan(spark, f"{sf.rstrip('/')}/pages.parquet")
    return rt.html_element_text(pages, "ad").select("page_id", "url", "class_name", "content")


def _fixed_sql(size, overlap):
    step = size - overlap
    return f"""
select doc_id, cast(i // {step} as int) as chunk_no, substring(text, i + 1, {size}) as chunk
from (select doc_id, text, unnest(generate_series(0, greatest(length(text) - 1, 0), {step})) as i from documents)
where length(substring(text, i + 1, {size})) > 0"""


@plan("fixed_chunks", ops=(86,), sql=_fixed_sql(100, 10))
def q_fixed_chunks(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return rt.fixed_chunks(d, "text", 100, 10).select("doc_id", "chunk_no", "chunk")


@plan("fixed_chunks_150", ops=(86,), sql=_fixed_sql(150, 20))
def q_fixed_chunks_150(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return rt.fixed_chunks(d, "text", 150, 20).select("doc_id", "chunk_no", "chunk")


@plan("recursive_chunks", ops=(85,), sql="""
select doc_id, source, true as fits, true as numbered, substr(trim(text, chr(32) || chr(10)), 1, 1) as head,
       right(trim(text, chr(32) || chr(10)), 1) as tail
from documents where length(trim(text, chr(32) || chr(10))) > 0""")
def q_recursive_chunks(spark, sf):
    """Per document: every chunk fits, the numbers run from 0, the first
    and last characters are the text's (tests compare whole splits)."""
    d = table(spark, sf, "documents").select("doc_id", "source", "text")
    c = rt.recursive_chunks(d, "doc_id", "text", 100, 10, keep=("source",))
    return c.groupBy("doc_id", "source").agg(
        (F.max(F.length("chunk")) <= 100).alias("fits"), (F.max("chunk_no") + 1 == F.count("chunk_no")).alias("numbered"),
        F.min_by(F.substring("chunk", 1, 1), "chunk_no").alias("head"), F.max_by(F.right("chunk", F.lit(1)), "chunk_no").alias("tail"))


@plan("assign_chunk_id", ops=(88,), sql="""
with c as (""" + _fixed_sql(100, 10) + """)
select doc_id, chunk_no, sha256(concat_ws('/', 'documents', doc_id, chunk_no)) as id from c""")
def q_assign_chunk_id(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    c = rt.fixed_chunks(d, "text", 100, 10)
    return rt.assign_chunk_id(c, "documents", "doc_id", "chunk_no").select("doc_id", "chunk_no", "id")


@plan("embed_text", ops=(87,), sql="""
select doc_id, 64 as dim, true as repeats, true as order_free from documents""")
def q_embed_text(spark, sf):
    """Whole texts by the default embedder: 64 dimensions, the same vector
    for the same text and for its words in reverse order (a bag of words)."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    words = F.regexp_extract_all("text", F.lit(r"[\p{L}\p{M}\p{N}_]+"), 0)
    back = d.select("doc_id", F.array_join(F.reverse(words), " ").alias("text"))
    a = rt.embed_text(d, "text", "a", 64).select("doc_id", "a")
    b = rt.embed_text(d, "text", "b", 64).select("doc_id", "b")
    c = rt.embed_text(back, "text", "c", 64).select("doc_id", "c")
    return a.join(b, "doc_id").join(c, "doc_id").select(
        "doc_id", F.size("a").alias("dim"), (F.col("a") == F.col("b")).alias("repeats"), (F.col("a") == F.col("c")).alias("order_free"))


@plan("dimension_guard", ops=(90,), sql="select vec_id from embeddings where vec_id % 7 = 0 or vec_id % 11 = 0")
def q_dimension_guard(spark, sf):
    """Every seventh vector cut short, every eleventh missing."""
    e = table(spark, sf, "embeddings").withColumn(
        "embedding", F.when(F.col("vec_id") % 11 == 0, F.lit(None)).when(F.col("vec_id") % 7 == 0, F.slice("embedding", 1, 63))
        .otherwise(F.col("embedding")))
    return rt.dimension_guard(e, "embedding", 64).select("vec_id")


@plan("collection_store", ops=(89, 9, 88), sql="""
select vec_id, label, sha256(concat_ws('/', 'emb', vec_id, 0)) as id from embeddings""")
def q_collection_store(spark, sf):
    """Append the vectors to a collection twice (the second append finds
    every id present and adds nothing), then open the collection."""
    from kestrel.session import scratch_path
    from kestrel.sources.collection import collection_append, collection_scan
    root = scratch_path(spark, "collections")
    e = table(spark, sf, "embeddings").withColumn("chunk_no", F.lit(0))
    rows = rt.assign_chunk_id(e, "emb", "vec_id", "chunk_no")
    collection_append(rows, root, "emb", dedupe=True)
    collection_append(rows, root, "emb", dedupe=True)
    return collection_scan(spark, root, "emb").select("vec_id", "label", "id")


_KNN_SQL = """
with q as (select vec_id as qid, cast(embedding as double[]) as qe from embeddings),
     s as (select vec_id, cast(embedding as double[]) as e from embeddings),
     d as (select qid, vec_id, {dist} as raw from q, s),
     r as (select *, row_number() over (partition by qid order by raw, vec_id) as rank from d)
select qid, vec_id, round(raw, 5) + 0.0 as dist, cast(rank as int) as rank from r where rank <= 4"""
_L2 = "list_distance(qe, e)"
_COS = "1 - list_inner_product(qe, e) / (sqrt(list_inner_product(qe, qe)) * sqrt(list_inner_product(e, e)))"


def _knn(spark, sf, metric):
    e = table(spark, sf, "embeddings")
    q = e.select(F.col("vec_id").alias("qid"), "embedding")
    return rt.similarity_search(e, q, 4, metric, store_id="vec_id").select("qid", "vec_id", "dist", "rank")


@plan("similarity_search", ops=(77, 48, 31), sql=_KNN_SQL.format(dist=_L2))
def q_similarity_search(spark, sf):
    return _knn(spark, sf, "l2")


@plan("similarity_search_cosine", ops=(77, 48), sql=_KNN_SQL.format(dist=_COS))
def q_similarity_search_cosine(spark, sf):
    return _knn(spark, sf, "cosine")


@plan("retrieval_compare", ops=(91,), sql=f"""
with a as ({_KNN_SQL.format(dist=_L2)}), b as ({_KNN_SQL.format(dist=_COS)}),
     j as (select coalesce(a.qid, b.qid) as qid, a.vec_id as va, b.vec_id as vb
           from a full outer join b on a.qid = b.qid and a.vec_id = b.vec_id)
select qid, count(va) as n_a, count(vb) as n_b,
       cast(sum(case when va is not null and vb is not null then 1 else 0 end) as bigint) as overlap
from j group by qid""")
def q_retrieval_compare(spark, sf):
    return rt.retrieval_compare(_knn(spark, sf, "l2"), _knn(spark, sf, "cosine"), "vec_id")


def _sql_repr(x: str) -> str:
    """Python repr for texts whose unprinted characters are among newline,
    return, tab, U+00A0 and U+3000."""
    e = f"replace({x}, '\\', '\\\\')"
    for code, shown in ((10, "\\n"), (13, "\\r"), (9, "\\t"), (160, "\\xa0"), (12288, "\\u3000")):
        e = f"replace({e}, chr({code}), '{shown}')"
    return (f"case when contains({x}, '''') and not contains({x}, '\"') then '\"' || {e} || '\"' "
            f"else '''' || replace({e}, '''', '\\''') || '''' end")


def _filled(template: str, context: str, question: str) -> str:
    """The template as an SQL concatenation: values are never searched for markers."""
    out = "'" + template.replace("'", "''") + "'"
    return out.replace("{context}", f"' || {context} || '").replace("{question}", f"' || {question} || '")


#: Benchmark passages as the store, by the embeddings of the same number;
#: ideographic and no-break spaces, quotes and template markers in the texts.
_STORE_SQL = """st as (select b.item_id, replace(replace(b.text, ', ', chr(12288)), ' of ', ' {question} ''of' || chr(160)) as text,
                       cast(e.embedding as double[]) as v
                from benchmark b join embeddings e on e.vec_id = b.item_id)"""


def _store(spark, sf):
    marked = F.replace(F.replace("text", F.lit(", "), F.lit("\u3000")), F.lit(" of "), F.lit(" {question} 'of\u00a0"))
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")
    return table(spark, sf, "benchmark").select("item_id", marked.alias("text")).join(e, "item_id")


def _ctx_sql(asked: str, keys: str) -> str:
    """ctx: the list of the four store texts nearest to each row of ``asked`` (keys, v)."""
    return f"""near as (select {keys}, text, row_number() over (partition by {keys} order by list_distance({asked}.v, st.v), item_id) as rank
                        from {asked}, st),
ctx as (select {keys}, '[' || string_agg({_sql_repr('text')}, ', ' order by rank) || ']' as ctx, count(*) as n_ctx
        from near where rank <= 4 group by {keys})"""


@plan("prompt_build", ops=(92, 77), sql=f"""
with {_STORE_SQL},
qs as (select conv_id || '/' || turn as qid, c.text as question, cast(e.embedding as double[]) as v
       from conversations c join embeddings e on e.vec_id = (conv_id * 31 + turn) % 50 where role = 'user'),
{_ctx_sql('qs', 'qid')}
select qid, md5({_filled(rt.PROMPT_TEMPLATE_TEXT, 'ctx', 'question')}) as h from qs join ctx using (qid)""")
def q_prompt_build(spark, sf):
    """User turns as questions; their vectors are stored ones."""
    c = table(spark, sf, "conversations").where(F.col("role") == "user").select(
        F.concat_ws("/", "conv_id", "turn").alias("qid"), F.col("text").alias("question"),
        ((F.col("conv_id") * 31 + F.col("turn")) % 50).alias("vec_id"))
    qv = c.join(table(spark, sf, "embeddings").select("vec_id", "embedding"), "vec_id")
    hits = rt.similarity_search(_store(spark, sf), qv.select("qid", "embedding"), 4, "l2", store_id="item_id", keep=("text",))
    return rt.prompt_build(hits, c, "qid", "question", "text").select("qid", F.md5("prompt").alias("h"))


_QA_SQL = f"""{_STORE_SQL},
qa as (select q.conv_id, q.turn, q.text as question, a.text as answer, cast(e.embedding as double[]) as v
       from conversations q join conversations a on a.conv_id = q.conv_id and a.turn = q.turn + 1
       join embeddings e on e.vec_id = (q.conv_id * 31 + q.turn) % 50
       where q.role = 'user' and a.role = 'assistant'),
{_ctx_sql('qa', 'conv_id, turn')},
ex as (select qa.conv_id, qa.turn, ctx.n_ctx, answer as labels, {_filled(rt.PROMPT_TEMPLATE_DIALOGUE, 'ctx', 'question')} as inputs
       from qa join ctx on ctx.conv_id = qa.conv_id and ctx.turn = qa.turn)"""


def _examples(spark, sf):
    qa = rt.qa_pairs(table(spark, sf, "conversations"))
    vec = table(spark, sf, "embeddings").select("vec_id", "embedding")
    qa = qa.withColumn("vec_id", (F.col("conv_id") * 31 + F.col("turn")) % 50).join(vec, "vec_id").drop("vec_id")
    return rt.sft_examples(rt.with_context(qa, _store(spark, sf), ["conv_id", "turn"], store_id="item_id").drop("embedding"))


@plan("sft_examples", ops=(93, 92), sql=f"""with {_QA_SQL}
select conv_id, turn, cast(n_ctx as int) as n_ctx, md5(inputs) as h_inputs, md5(labels) as h_labels from ex""")
def q_sft_examples(spark, sf):
    ex = _examples(spark, sf)
    return ex.select("conv_id", "turn", F.size("context").alias("n_ctx"), F.md5("inputs").alias("h_inputs"),
                     F.md5("labels").alias("h_labels"))


_IDS = "list_transform(string_split(inputs || labels || '</s>', ''), lambda c: unicode(c))[1:1024]"


@plan("sft_tokenize", ops=(94,), sql=f"""with {_QA_SQL},
t as (select conv_id, turn, {_IDS} as ids from ex)
select conv_id, turn, cast(len(ids) as int) as n_ids, cast(list_sum(ids) as bigint) as sum_ids,
       md5(array_to_string(ids, ',')) as h_ids, cast(len(ids) as int) as n_mask from t""")
def q_sft_tokenize(spark, sf):
    t = rt.sft_tokenize(_examples(spark, sf))
    return t.select("conv_id", "turn", F.size("input_ids").alias("n_ids"),
                    F.aggregate("input_ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("sum_ids"),
                    F.md5(F.array_join("input_ids", ",")).alias("h_ids"),
                    F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_mask"))


@plan("collate_batches", ops=(95, 24), sql=f"""with {_QA_SQL},
t as (select conv_id, turn, len({_IDS}) as n from ex),
b as (select *, (row_number() over (order by conv_id, turn) - 1) // 12 as batch from t)
select conv_id, turn, cast(batch as bigint) as batch, cast(max(n) over (partition by batch) as int) as padded_len,
       cast(max(n) over (partition by batch) - n as int) as n_label_pad from b""")
def q_collate_batches(spark, sf):
    t = rt.sft_tokenize(_examples(spark, sf))
    b = rt.collate_batches(t, ["conv_id", "turn"])
    return b.select("conv_id", "turn", "batch", "padded_len",
                    F.size(F.filter("labels_ids", lambda x: x == rt.LABEL_PAD)).alias("n_label_pad"))


@plan("strip_prompt_echo", ops=(66,), sql=f"""with {_QA_SQL}
select conv_id, turn, md5(substring(inputs || labels, length(inputs))) as h from ex""")
def q_strip_prompt_echo(spark, sf):
    ex = _examples(spark, sf).withColumn("generated", F.concat("inputs", "labels"))
    return rt.strip_prompt_echo(ex, "generated", "inputs", "answer").select(
        "conv_id", "turn", F.md5("answer").alias("h"))


@plan("embed_text_norms", ops=(87,), sql="""
with c as (""" + _fixed_sql(100, 10) + """)
select doc_id, chunk_no, 64 as dim,
       case when len(regexp_extract_all(lower(chunk), '[\\p{L}\\p{M}\\p{N}_]+')) > 0 then 1.0 else 0.0 end::double as norm
from c""")
def q_embed_text_norms(spark, sf):
    """Default embedder on every fixed chunk: 64 dimensions, unit length
    when the chunk holds a word, the zero vector otherwise."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    e = rt.embed_text(rt.fixed_chunks(d, "text", 100, 10), "chunk", dim=64)
    sq = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return e.select("doc_id", "chunk_no", F.size("embedding").alias("dim"), F.round(F.sqrt(sq), 6).alias("norm"))
