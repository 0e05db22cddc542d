"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import alignment, dialogue, grouping, mixing, ngramjoin, ngramlm, outliers, packing, tokens, topk, toxicity, urlfilter, warc
from kestrel.llm.inputs import tokenizer, trusted
from kestrel.sources.tables import table

#: Fixed values of the query: domain rules, and the globs of hosts to block.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]
GLOBS = ["*cheap-pills*/**", "*casino*/**", "*adult*/**", "*spam-*/**", "*free-bets*/**", "*ads-track*/**"]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [urlfilter.Rule(v, r) for v, r in RULES] + [urlfilter.Rule("block", g, glob=True) for g in GLOBS]
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def _op1_sql() -> str:
    rules = ", ".join(f"('{v}', '{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}')" for v, r in RULES)
    globs = " or ".join(f"'.' || host || path like '%{g.strip('*/')}%/%' and host like '%{g.strip('*/')}%'" for g in GLOBS)
    return rf"""
with u as (
  select row_number() over () as k, page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
r(verdict, rule, rhost, rpath) as (values {rules}),
m as (
  select k, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
  from u join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
  group by k)
select page_id, host, path, rule,
       coalesce(verdict, case when {globs} then 'block' else 'allow' end) as verdict
from u left join m using (k)"""


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive_and_index(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "capture_rank")


OP2_SQL = r"""
with p as (
  select page_id, coalesce(html, '') as body, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as digest,
         regexp_replace(url, '[\x00-\x20\x7f]', '', 'g') as u
  from pages),
k as (
  select page_id, n, digest,
         case when n >= 1000 and count(*) over (partition by digest) > 1 then max(page_id) over (partition by digest) end as first_id,
         coalesce(array_to_string(list_reverse(string_split(translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.')), ','), '')
         || ')' || coalesce(regexp_extract(u, '(?s)^.*?://[^/?#]*([^#]*)', 1), '') as url_key
  from p)
select page_id, n::bigint as payload_bytes, digest as payload_digest,
       case when first_id is not null and page_id is distinct from first_id then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from first_id then first_id end as refers_to, url_key,
       row_number() over (order by url_key, page_id % 1000000000, page_id nulls first) as capture_rank
from k"""


def op3_quality_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return ngramlm.quality(docs, trusted(spark, sf_dir), carry=["doc_id", "lang"])


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out).select("doc_id", "toxic")
    machine = toxicity.learn(docs, labels)
    return toxicity.score(docs, machine, carry=["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngramjoin.ngram_join(docs, threshold=0.8, n=5).select("doc_id", "class_id", "n_links")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"), capacity=4096, end_id=2, keep_ids=False)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return outliers.quality_rules(docs, carry=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    rows = mixing.mix(docs, weights=(5, 2, 1), budget=1.5, most=2.0)
    return rows.groupBy("__row", "doc_id", "size", "source_size", "target").agg(
        (F.count("shard") * F.col("size")).alias("taken")).drop("__row")


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double"))
    # floor() of a non-finite component would be a finite long
    whole = F.when(F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), whole)
    found = topk.pivot_search(emb, F.col("vec_id") % 50 == 0, whole, "vec_id", k=5)
    return found.select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))


OP9_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 50 = 0)
select query_id, (row_number() over w)::integer as rank, vec_id, score from s
window w as (partition by query_id order by score desc, vec_id)
qualify row_number() over w <= 5"""


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.token_counts(docs, tokenizer("byte_bpe_50k.json"), limit=512).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit")


def op11_group_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return grouping.group_pack(docs, tokenizer("word_bpe_49k.json"), capacity=2048, end_id=0, keep_ids=False)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return alignment.align(docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return dialogue.report(dialogue.repair(dialogue.damage(turns), keep_turns=False)).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _op13_sql() -> str:
    def then(x: str, cost: str, edits: str, role: str = "", text: str = "''") -> str:
        """State ``x`` after an edit that adds a line of ``role``, if any."""
        line = f"case when {x}.t = '' then '' else {x}.t || chr(10) end || {role} || ':' || {text}" if role else f"{x}.t"
        return f"{{'c': {x}.c + {cost}, 'e': {x}.e || '{edits}', 't': {line}}}"

    def least(*ways: str) -> str:
        return f"list_sort([{', '.join(ways)}])[1]"

    def stay(role: str, kept: str, *states: str) -> list[str]:
        """Ways to keep or rerole a row; far too dear where it may not stay."""
        far = "case when fault in (1, 2) then 1000000000000 else 0 end + case when fault = 3 then 3 else 0 end"
        keep = f"{far} + case when left(role, 1) = '{role}' then 0 else 1000000000000 end"
        return [w for x in states for w in (then(x, keep, "K", "role", "text"), then(x, f"{far} + 3", "R", f"'{kept}'", "text"))]

    none = "{'c': 1000000000000::bigint, 'e': '', 't': ''}"
    keep_s = then("s0", "case when fault in (1, 2) or left(role, 1) <> 's' then 1000000000000 when fault = 3 then 3 else 0 end", "K", "role", "text")
    return rf"""
with recursive crcs as (
  select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crc_of),
rows as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         xor(list_reduce([4294967295] || list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda h: ascii(h)::bigint),
           lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])), 4294967295) % 20 as k
  from conversations, crcs),
ids as (select conv_id, row_number() over () as g from (select distinct conv_id from conversations)),
hurt as (
  select g, turn, case when k = 4 then 'user' else role end as role,
         case when k = 1 then '' when k = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(range(case when k = 0 then 0 when k = 3 then 2 else 1 end)) as copy
  from rows join ids on rows.conv_id is not distinct from ids.conv_id),
placed as (select *, row_number() over (partition by g order by turn nulls first, role, text) as i from hurt),
faulty as (
  select *, case when not regexp_matches(text, '[^ 	-
]') then 1
                 when row_number() over (partition by g, role, text order by i) > 1 then 2
                 when not regexp_matches(text, '[.!?][ 	-
]*$') then 3 else 0 end as fault,
         left(lag(role) over (partition by g order by i), 1) || left(role, 1) as pair
  from placed),
states as (
  select g, 0::bigint as i, {{'c': 0::bigint, 'e': '', 't': ''}} as s0, {none} as s1, {none} as u, {none} as a from ids
  union all
  select g, i, {then('s0', '4', 'D')}, {least(then('s1', '4', 'D'), keep_s)},
         {least(then('u', '4', 'D'), *stay('u', 'user', 's0', 's1', 'a'))}, {least(then('a', '4', 'D'), *stay('a', 'assistant', 'u'))}
  from (select * replace ({least('a', then('u', '3', 'I', "'assistant'"))} as a) from (
    select f.g, f.i, role, text, fault, s0, s1, {least('u', *(then(x, '3', 'I', "'user'") for x in ('s0', 's1', 'a')))} as u, a
    from states join faulty f on f.g = states.g and f.i = states.i + 1))),
ends as (
  select g, arg_max({least('s0', 'a', then('u', '3', 'I', "'assistant'"),
                           then('s2', '3', 'I', "'assistant'"))}, i) as best
  from (select *, {then('s1', '3', 'I', "'user'")} as s2 from states) group by g)
select ids.conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
       count(*) filter (fault = 1) as blank, count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 3) as truncated,
       count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal,
       any_value(best.c) as cost, any_value(best.e) as audit, sha256(any_value(best.t)) as repaired_sha256
from ids join ends using (g) left join faulty using (g) group by ids.conv_id, g"""


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_warc": op2_warc,
    "op3_quality_lm": op3_quality_lm,
    "op4_toxicity": op4_toxicity,
    "op5_ngram_join": op5_ngram_join,
    "op6_packing": op6_packing,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_exact_topk": op9_exact_topk,
    "op10_token_counts": op10_token_counts,
    "op11_group_packing": op11_group_packing,
    "op12_token_alignment": op12_token_alignment,
    "op13_dialogue_repair": op13_dialogue_repair,
}

ORACLE_SQL = {
    "op1_url_filter": _op1_sql(),
    "op2_warc": OP2_SQL,
    "op9_exact_topk": OP9_SQL,
    "op13_dialogue_repair": _op13_sql(),
}
