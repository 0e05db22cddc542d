"""Review-text plans.  Stand-in: ``documents`` ⋈ ``labels`` as the review
table (ID = doc_id, VOC = text, SUBJECT = first line, PRODUCT = source,
CORRECT = quality); prediction = rule ``n_chars > 500``."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions import text as tx
from kestrel.operators import metrics as mt
from kestrel.operators import textml as tm
from kestrel.plans.registry import plan
from kestrel.sources.tables import table

_STOP_SQL = "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in tx.STOPLIST) + "]"


def _presplit_sql(expr: str) -> str:
    out = f"lower({expr})"
    for a, b in tx.PRESPLIT_RULES:
        b_sql = "chr(10)" if b == "\n" else f"'{b}'"
        out = f"replace({out}, '{a}', {b_sql})"
    return f"replace({out}, chr(10), '。')"


def _tokens_sql(expr: str) -> str:
    return (f"list_filter(regexp_extract_all({_presplit_sql(expr)}, '{tm.WORD_PATTERN}'), "
            f"lambda x: not list_contains({_STOP_SQL}, x))")


@plan("tokenize_content_words", ops=(73, 50, 56, 57, 58), sql=f"""
select doc_id, md5(array_to_string({_tokens_sql('text')}, ' ')) as h,
       cast(len({_tokens_sql('text')}) as int) as n_tokens from documents""")
def q_tokenize(spark, sf):
    d = tm.tokenize_content_words(table(spark, sf, "documents"), "text", "toks", "list")
    return d.select("doc_id", F.md5(tx.join_tokens("toks", "str")).alias("h"),
                    F.size("toks").alias("n_tokens"))


@plan("nfkc_normalize", ops=(56,), sql="select doc_id, md5('ABC 12 ' || text) as h from documents")
def q_nfkc(spark, sf):
    """Texts with ideographic spaces and a full-width head; NFKC gives the
    plain text back (the texts hold composed forms only)."""
    d = table(spark, sf, "documents")
    wide = F.concat(F.lit("ＡＢＣ　１２　"), F.replace("text", F.lit(" "), F.lit("\u3000")))
    return d.select("doc_id", F.md5(tx.nfkc_normalize(wide)).alias("h"))


@plan("stoplist_filter", ops=(57,), sql=f"""
select doc_id, cast(len(toks) as int) as n_tokens, md5(array_to_string(toks, '|')) as h
from (select doc_id, list_filter(string_split(replace(replace(replace(text, ',', ' , '), '.', ' . '), ' the ', ' の '), ' '),
                                 lambda x: not list_contains({_STOP_SQL}, x)) as toks from documents)""")
def q_stoplist_filter(spark, sf):
    """Punctuation as tokens of their own, and a listed word in place of
    the most frequent one."""
    t = F.col("text")
    for a, b in ((",", " , "), (".", " . "), (" the ", " の ")):
        t = F.replace(t, F.lit(a), F.lit(b))
    d = table(spark, sf, "documents").select("doc_id", tx.stoplist_filter(F.split(t, " ")).alias("toks"))
    return d.select("doc_id", F.size("toks").alias("n_tokens"), F.md5(F.array_join("toks", "|")).alias("h"))


def review_input(spark, sf):
    d = table(spark, sf, "documents")
    lb = table(spark, sf, "labels")
    j = d.join(lb, "doc_id", "left")  # every document; CORRECT may be NULL
    return j.select(
        F.col("doc_id").alias("ID"), F.col("source").alias("PRODUCT"),
        F.when(F.col("toxic") == 1, F.lit(None)).otherwise(F.col("lang")).alias("CUSTOMER"),
        F.substring_index("text", "\n", 1).alias("SUBJECT"),
        F.concat(F.lit("2024/01/"), F.lpad(((F.col("doc_id") % 28) + 1).cast("string"), 2, "0")).alias("SUBMITDATE"),
        F.col("text").alias("VOC"),
        F.when(F.col("quality") == 0, F.lit("<HTML>needs review<XML>")).alias("SUPPLEMENT"),
        F.lit("HTML follow-up <SGML>").alias("FOLLOWUP"),
        F.col("lang").alias("CLASS"), (F.col("doc_id") % 7).cast("string").alias("LV"),
        F.col("quality").cast("string").alias("CORRECT"))


_REVIEW_SQL = """
with r as (select d.doc_id as ID, d.source as PRODUCT, case when l.toxic = 1 then null else d.lang end as CUSTOMER,
                  split_part(d.text, chr(10), 1) as SUBJECT,
                  '2024/01/' || lpad(cast(d.doc_id % 28 + 1 as varchar), 2, '0') as SUBMITDATE,
                  d.text as VOC, case when l.quality = 0 then '<HTML>needs review<XML>' end as SUPPLEMENT,
                  'HTML follow-up <SGML>' as FOLLOWUP, d.lang as CLASS, cast(d.doc_id % 7 as varchar) as LV,
                  cast(l.quality as varchar) as CORRECT
           from documents d left join labels l on l.doc_id = d.doc_id),
c as (select cast(ID as varchar) as ID, coalesce(CUSTOMER, 'UNKNOWN') as CUSTOMER,
             strftime(strptime(SUBMITDATE, '%Y/%m/%d'), '%Y-%m-%d') as SUBMITDATE,
             case when LV in ('1','2','3') then 'LOW' when LV in ('4','5') then 'HIGH' else LV end as LV,
             case when CORRECT in ('1','1.0','T','TRUE') then 'USE' when CORRECT in ('0','0.0','F','FALSE') then 'OMIT'
                  else CORRECT end as CORRECT,
             SUBJECT || ' ' || VOC || ' ' ||
               replace(replace(replace(coalesce(SUPPLEMENT, ''), '<HTML>', ''), '<XML>', ''), '<SGML>', '') || ' ' ||
               replace(replace(replace(FOLLOWUP, 'HTML', ''), '<XML>', ''), '<SGML>', '') as VOC_CAT, SUBJECT
      from r)
"""


@plan("clean_reviews", ops=(74, 10, 14, 15, 49, 52, 61, 18, 19), sql=_REVIEW_SQL + f"""
select ID, CUSTOMER, SUBMITDATE, LV, CORRECT, md5(VOC_CAT) as h_cat,
       md5(array_to_string({_tokens_sql('VOC_CAT')}, ' ')) as h_voc,
       array_to_string({_tokens_sql('SUBJECT')}, ' ') as SUBJECT_MORPHEME_S from c""")
def q_clean_reviews(spark, sf):
    c = tm.clean_reviews(review_input(spark, sf))
    return c.select("ID", "CUSTOMER", F.date_format("SUBMITDATE", "yyyy-MM-dd").alias("SUBMITDATE"), "LV",
                    "CORRECT", F.md5("VOC_CAT").alias("h_cat"), F.md5("VOC_MORPHEME_S").alias("h_voc"),
                    "SUBJECT_MORPHEME_S")


_SPLIT_SQL = """case when row_number() over (order by substr(md5(doc_id || ':{seed}'), 1, 15), cast(doc_id as varchar))
                     <= ceil(count(*) over () * {frac}) then 'test' else 'train' end"""


@plan("train_test_split", ops=(75,), sql=f"select doc_id, {_SPLIT_SQL.format(seed=42, frac=0.25)} as split from documents")
def q_train_test_split(spark, sf):
    return tm.train_test_split(table(spark, sf, "documents").select("doc_id"), "doc_id", 0.25, 42)


@plan("train_test_subset", ops=(75,), sql=f"""
select doc_id, split from (select doc_id, {_SPLIT_SQL.format(seed=42, frac=0.25)} as split from documents) where split = 'test'""")
def q_train_test_subset(spark, sf):
    return tm.train_test_split(table(spark, sf, "documents").select("doc_id"), "doc_id", 0.25, 42, subset="test")


@plan("label_encode", ops=(76,), sql="""
select doc_id, cast(dense_rank() over (order by case when quality = 1 then 'USE' else 'OMIT' end) - 1 as double) as label
from labels""")
def q_label_encode(spark, sf):
    from kestrel.operators.ml import label_encode
    from kestrel.operators.relational import recode_correct
    lb = table(spark, sf, "labels").select("doc_id", recode_correct("quality").alias("CORRECT"))
    return label_encode(lb, "CORRECT", "label").select("doc_id", "label")


_DOC_TOK_SQL = f"select doc_id, {_tokens_sql('text')} as toks from documents"


@plan("tfidf", ops=(78,), sql=f"""
with t as ({_DOC_TOK_SQL}),
tf as (select doc_id, term, cast(count(*) as double) as tf from (select doc_id, unnest(toks) as term from t) group by all),
n as (select count(*) as N from documents),
idf as (select term, ln((N + 1) / (count(*) + 1)) + 1 as idf from tf, n group by term, N),
w as (select doc_id, tf.term, tf * idf as w from tf join idf on idf.term = tf.term),
nr as (select doc_id, sqrt(sum(w * w)) as nrm from w group by doc_id)
select w.doc_id, term, round(w / nrm, 9) as weight from w join nr on nr.doc_id = w.doc_id""")
def q_tfidf(spark, sf):
    d = tm.tokenize_content_words(table(spark, sf, "documents"), "text", "toks", "list")
    w = tm.tfidf_weights(d.select("doc_id", "toks"), "doc_id", "toks")
    return w.select("doc_id", "term", F.round("weight", 9).alias("weight"))


def _rule_predictions(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    lb = table(spark, sf, "labels").select("doc_id", "quality")
    return lb.join(d, "doc_id").select(
        "doc_id", F.col("quality").alias("label"), (F.col("n_chars") > 500).cast("int").alias("prediction"))


_PRED_SQL = """p as (select l.doc_id, l.quality as label, cast(d.n_chars > 500 as int) as prediction
                     from labels l join documents d on d.doc_id = l.doc_id)"""


@plan("accuracy", ops=(37,), sql=f"""with {_PRED_SQL}
select round(avg(cast(label = prediction as double)), 9) as accuracy, count(*) as n from p""")
def q_accuracy(spark, sf):
    a = mt.accuracy(_rule_predictions(spark, sf))
    return a.select(F.round("accuracy", 9).alias("accuracy"), "n")


@plan("confusion_counts", ops=(39,), sql=f"""with {_PRED_SQL}
select label, prediction, count(*) as n from p group by all""")
def q_confusion(spark, sf):
    return mt.confusion_counts(_rule_predictions(spark, sf))


@plan("classification_report", ops=(38,), sql=f"""with {_PRED_SQL},
cls as (select distinct label as c from p union select distinct prediction from p),
s as (select c, count(*) filter (where label = c) as support, count(*) filter (where prediction = c) as predicted,
             count(*) filter (where label = c and prediction = c) as tp from cls, p group by c),
m as (select cast(c as varchar) as cls,
             case when predicted > 0 then tp / predicted else 0 end as precision,
             case when support > 0 then tp / support else 0 end as recall, support, tp from s),
f as (select *, case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0 end as f1 from m)
select cls, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1, support from f
union all select 'accuracy', null, null, round(sum(tp) / sum(support), 9), cast(sum(support) as bigint) from f
union all select 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9),
                 cast(sum(support) as bigint) from f
union all select 'weighted avg', round(sum(precision * support) / sum(support), 9),
                 round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
                 cast(sum(support) as bigint) from f""")
def q_classification_report(spark, sf):
    r = mt.classification_report(_rule_predictions(spark, sf))
    return r.select("cls", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


@plan("prediction_table", ops=(82, 30), sql=f"""with {_PRED_SQL}
select cast(doc_id as varchar) as ID, label as TARGET, prediction as PRED from p""")
def q_prediction_table(spark, sf):
    from kestrel.operators.ml import prediction_table
    p = _rule_predictions(spark, sf).withColumnRenamed("doc_id", "ID")
    return prediction_table(p, "ID", "label", "prediction")


def _reviews(spark, sf, by_language=False):
    """Labelled documents as reviews: tokens, class, split.  The class is the
    quality label or, ``by_language``, whether the text is English: one that a
    classifier can learn from words, and a majority vote (three in five) cannot."""
    from kestrel.operators.ml import HOLDOUT, drop_short_tokens
    from kestrel.operators.relational import recode_correct
    lb = table(spark, sf, "labels").select("doc_id", recode_correct("quality").alias("CORRECT"))
    parts = tm.train_test_split(lb, "doc_id", HOLDOUT, 0)  # of the small rows, before the texts come in
    d = table(spark, sf, "documents").select("doc_id", "text", "lang").join(parts, "doc_id")
    if by_language:
        d = d.withColumn("CORRECT", F.when(F.col("lang") == "en", "USE").otherwise("OMIT"))
    t = tm.tokenize_content_words(d, "text", "toks", "list")
    return drop_short_tokens(t, "toks", "terms", 2).select("doc_id", "CORRECT", "split", "toks", "terms")


def _written(rows):
    """The table, written once: what reads it again joins and cuts no text again."""
    from kestrel.session import scratch_path
    path = scratch_path(rows.sparkSession, "reviews")
    rows.write.partitionBy("split").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


_HOLDOUT_SQL = f"""s as (select doc_id, {_SPLIT_SQL.format(seed=0, frac=0.2)} as split from labels),
h as (select doc_id, case when lang = 'en' then 'USE' else 'OMIT' end as CORRECT, split from s join documents using (doc_id))"""


@plan("classify_predict", ops=(81, 79, 80, 82, 76, 75), sql=f"""with {_HOLDOUT_SQL}
select cast(doc_id as varchar) as ID, cast(case when CORRECT = 'USE' then 1 else 0 end as int) as TARGET, true as IS_CLASS, true as LEARNED
from h where split = 'test'""")
def q_classify_predict(spark, sf):
    """TF-IDF → 200-component SVD → RBF features → SVM on the train part,
    then the hold-out part as a second table: ID, TARGET, that PRED is one of
    the classes, and that over nine in ten are right (a constant is right in
    six)."""
    from kestrel.operators.ml import TextClassifier, score_table
    from kestrel.session import keep
    t = _written(_reviews(spark, sf, by_language=True).drop("toks"))
    model = TextClassifier().fit(t.where("split = 'train'"), "terms", "CORRECT")
    p = score_table(model, t.where("split = 'test'"), "doc_id", "terms", "CORRECT")
    p = keep(p)
    right = p.agg(F.avg((F.col("PRED") == F.col("TARGET")).cast("int"))).first()[0] or 0
    return p.select("ID", "TARGET", F.coalesce(F.col("PRED").isin(0, 1), F.lit(False)).alias("IS_CLASS"), F.lit(right > 0.9).alias("LEARNED"))


@plan("truncated_svd", ops=(79, 78), sql=f"""
with t as (select cast(doc_id as varchar) as doc_id, list_filter({_tokens_sql('text')}, lambda x: length(x) >= 2) as toks
           from documents join labels using (doc_id)),
tf as (select doc_id, term, cast(count(*) as double) as tf from (select doc_id, unnest(toks) as term from t) group by all),
n as (select count(*) as N from t),
idf as (select term, ln((N + 1) / (count(*) + 1)) + 1 as idf from tf, n group by term, N),
w as (select doc_id, tf.term, tf * idf as w from tf join idf on idf.term = tf.term),
x as (select doc_id, term, w / sqrt(sum(w * w) over (partition by doc_id)) as w from w)
select cast(20 as bigint) as components, true as descending, true as orthonormal,
       round(sum(w * w), 6) as total from x""")
def q_truncated_svd(spark, sf):
    """Twenty components of the reviews' tf-idf matrix: singular values
    descend, vectors are orthonormal, and the squared entries sum to the
    whole (all singular values' squares)."""
    import numpy as np
    from kestrel.operators import lsa
    from kestrel.session import scratch_path
    path = scratch_path(spark, "svd-plan")
    _reviews(spark, sf).select(F.monotonically_increasing_id().alias("rid"), "terms").write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    n = rows.count()
    counts = lsa.term_entries(rows, "rid", "terms")
    lsa.idf_table(counts, n).write.parquet(f"{path}/idf")
    lsa.tfidf_entries(counts, spark.read.parquet(f"{path}/idf")).write.parquet(f"{path}/entries")
    entries = spark.read.parquet(f"{path}/entries")
    basis, values = lsa.svd(entries, n, 20)
    g = lsa.gram(basis, len(values))
    return entries.agg(F.round(F.sum(F.col("w") * F.col("w")), 6).alias("total")).select(
        F.lit(len(values)).cast("bigint").alias("components"), F.lit(bool((np.diff(values) <= 0).all())).alias("descending"),
        F.lit(bool(np.allclose(g, np.eye(len(values)), atol=1e-6))).alias("orthonormal"), "total")


@plan("grid_search", ops=(83,), sql="""
select cast(g as int) as ngram_max, cast(k as int) as components, kernel, cast(c as double) as C, true as learned
from (values (1), (2)) n(g), (values (50), (75), (100), (125), (150), (200)) a(k), (values (0.8), (0.9), (1.0), (1.1), (1.2)) b(c),
     (values ('linear'), ('rbf')) d(kernel)""")
def q_grid_search(spark, sf):
    """The whole grid in five folds: a row per setting, and whether it tells
    the languages apart (mean balanced accuracy over 0.8; a majority vote has 0.5)."""
    from kestrel.operators.ml import grid_search
    t = _reviews(spark, sf, by_language=True).where("split = 'train'")
    _, found = grid_search(t, "toks", "CORRECT")
    return found.select("ngram_max", "components", "kernel", "C", (F.col("mean_balanced") > 0.8).alias("learned"))


@plan("model_save", ops=(103, 80, 81), sql=f"""with {_HOLDOUT_SQL}
select cast(doc_id as varchar) as ID, true as SAME, true as LEARNED from h where split = 'test'""")
def q_model_save(spark, sf):
    """Fit the SVD and RBF model, save it to the shared folder, load it
    back: does the loaded model predict the same for every hold-out row, and
    over nine in ten right?"""
    from kestrel.operators.ml import TextClassifier, model_save
    from kestrel.session import keep, scratch_path
    t = _written(_reviews(spark, sf, by_language=True).drop("toks"))
    m = TextClassifier(components=50).fit(t.where("split = 'train'"), "terms", "CORRECT")
    path = scratch_path(spark, "model")
    model_save(m, path)
    test = t.where("split = 'test'").select("doc_id", "CORRECT", "terms")
    a = m.transform(test, "terms").select("doc_id", "CORRECT", F.col("prediction").alias("a"))
    b = TextClassifier.load(path).transform(test, "terms").select("doc_id", F.col("prediction").alias("b"))
    both = keep(a.join(b, "doc_id"))
    right = both.agg(F.avg((F.col("b") == F.col("CORRECT")).cast("int"))).first()[0] or 0
    return both.select(F.col("doc_id").cast("string").alias("ID"), F.col("a").eqNullSafe(F.col("b")).alias("SAME"), F.lit(right > 0.9).alias("LEARNED"))


def _permuted_sql(seed: int, walk: int = 8) -> str:
    """The permutation of ``shuffle_positions`` step by step; a place beyond n
    goes round again, ``walk`` times at most."""
    def mix(x: str, k: int) -> str:
        m = f"(({x} * 48271 + {k} * 69621 + {seed}) % 2147483647)"
        return f"(({m} * {m} + {m}) % 2147483647)"

    steps, last = [], "grid"
    for w in range(walk):
        steps.append(f"w{w}r0 as (select *, p // b as l, p % b as r from {last})")
        for k in range(4):
            steps.append(f"w{w}h{k} as (select * replace ((l + {mix('r', 2 * k)}) % a as l) from w{w}r{k})")
            steps.append(f"w{w}r{k + 1} as (select * replace ((r + {mix('l', 2 * k + 1)}) % b as r) from w{w}h{k})")
        moved = "l * b + r" if w == 0 else "case when p < n then p else l * b + r end"
        steps.append(f"w{w} as (select id, n, a, b, {moved} as p from w{w}r4)")
        last = f"w{w}"
    return ",\n".join(steps) + f"\nselect id as doc_id, p::bigint as position from {last}"


@plan("shuffle_positions", ops=(47,), sql=f"""
with grid as (
  select doc_id as id, row_number() over (order by doc_id) - 1 as p, count(*) over () as n,
         floor(sqrt(count(*) over () - 1))::bigint + 1 as a,
         ceil(count(*) over () / (floor(sqrt(count(*) over () - 1)) + 1))::bigint as b from documents),
{_permuted_sql(7)}""")
def q_shuffle_positions(spark, sf):
    """Every document's place in a random order, found without sorting by it."""
    return tm.shuffle_positions(table(spark, sf, "documents").select("doc_id"), ["doc_id"], 7)


_LATTICE_SQL = r"""
with recursive t as (select item_id, regexp_replace(lower(text), '\s+', '', 'g') as s from benchmark),
words as (select distinct unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}]{2,}')) as w from benchmark),
size as (select ln(count(*))::double as cost, max(length(w)) as longest from words),
places as (select item_id, s, unnest(range(length(s))) as a from t),
kinds as (select *, case when regexp_matches(substr(s, a + 1, 1), '\p{N}') then 'n' when regexp_matches(substr(s, a + 1, 1), '[\p{L}\p{M}]') then 'l' else 'm' end as kind from places),
marked as (select *, sum(case when kind is distinct from before then 1 else 0 end) over (partition by item_id order by a) as run
           from (select *, lag(kind) over (partition by item_id order by a) as before from kinds)),
ends as (select *, max(a) over (partition by item_id, run) + 1 as stop from marked),
edges as (
  select item_id, a + 1 as b, a, 14::double as cost from ends union all select item_id, stop, a, (12 + 2 * (stop - a))::double from ends
  union all select c.item_id, c.a + c.n, c.a, size.cost from (select item_id, s, a, unnest(range(2, longest + 1)) as n from places, size) c
            join words on w = substr(c.s, c.a + 1, c.n) and length(w) = c.n, size),
into_b as (select item_id, b, list({'a': a, 'cost': cost::double}) as ways from edges group by item_id, b),
steps as (
  select item_id, 0::bigint as b, [0::double] as best from t
  union all
  select s.item_id, i.b, list_append(best, list_min(list_transform(i.ways, lambda e: best[e.a + 1] + e.cost)))
  from steps s join into_b i on i.item_id = s.item_id and i.b = s.b + 1)
select item_id, round(arg_max(best[-1], b), 6) as cost, length(any_value(s)) as n_chars from steps join t using (item_id) group by item_id"""


@plan("lattice_tokens", ops=(73,), sql=_LATTICE_SQL)
def q_lattice_tokens(spark, sf):
    """Benchmark texts without their spaces, cut by a dictionary of the table's
    words that all cost alike: the cost of the cheapest cut (SQL finds it place
    by place), and the characters its words join up to."""
    import pandas as pd
    from kestrel.operators import lattice
    from kestrel.session import ensure_shipped
    ensure_shipped(spark)
    rows = table(spark, sf, "benchmark").select("item_id", F.lower("text").alias("text"))
    found = rows.select(F.explode(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{M}]{2,}"), 0)).alias("surface")).distinct()
    cutter = lattice.fit(rows, "text", found.select("surface", F.lit(lattice.NOUN).alias("pos"), F.col("surface").alias("base")), rounds=0)

    def cut_texts(texts):
        out = []
        for t in texts.fillna(""):
            edges = [(run, e) for run in lattice.runs(t) for e in cutter.cut(run)]
            out.append((sum(cutter.cost(*e) for _, e in edges), sum(len(run[e[0]:e[1]]) for run, e in edges)))
        return pd.DataFrame(out, columns=["cost", "n_chars"])

    cut_texts.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}  # not as text: Spark reads them
    cut = F.pandas_udf(cut_texts, "struct<cost: double, n_chars: long>")

    unspaced = rows.select("item_id", cut(F.regexp_replace("text", r"\s+", "")).alias("c"))
    return unspaced.select("item_id", F.round("c.cost", 6).alias("cost"), "c.n_chars")


@plan("embed_fitted", ops=(87,), sql="select doc_id, 16 as dim, true as unit from documents")
def q_embed_fitted(spark, sf):
    """Vectors of 16 numbers fitted to all documents: their length, and that the
    norm is 1, or 0 without known words (values against numpy in the tests)."""
    from kestrel.operators import wordvec
    d = table(spark, sf, "documents").select("doc_id", "text")
    v = wordvec.fit(d, "text", dim=16, window=2, rounds=2).embed(d, "text")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    return v.select("doc_id", F.size("embedding").alias("dim"), F.round(norm, 6).isin(0.0, 1.0).alias("unit"))
