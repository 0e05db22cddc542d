"""Document retrieval and training-row preparation.

page → element text → chunks → vectors → collection; questions → vectors
→ k nearest chunks → prompts; question/answer pairs → tokenised rows →
padded batches.

Scale notes
* Chunking and HTML extraction are per-row (Arrow batches of a bounded
  number of chunks); every text is processed whole.
* Nearest-neighbour search never materialises (query, vector) pairs as
  rows: queries meet the blocks of those cells only that can hold a nearer
  row, and a window over at most k rows per query and block picks the top-k.
* Question/answer pairing joins on (conversation, turn) keys, so one long
  conversation cannot pile up in one task.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators.partitioning import spread
from kestrel.operators.search import TILE_CELLS, cell_search  # noqa: F401
from kestrel.operators.search import exact as _exact  # noqa: F401
from kestrel.session import ensure_shipped

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for equal results)
# recursive splitter separators, tried in this order
SEPARATORS = ("\n\n", "\n", " ", "")
# chunk size / overlap settings used by the reference
CHUNK_SETTINGS = ((100, 10), (150, 20))
DEFAULT_K = 4
# first prompt template ({context} is the Python-style list of texts)
PROMPT_TEMPLATE_TEXT = """以下の情報を参照し、Questionに対するAnswerを日本語で作成してください。

-----------
{context}
-----------

Question:{question}
Answer:"""
# second prompt template (user/system dialogue form)
PROMPT_TEMPLATE_DIALOGUE = """ユーザー: 以下の情報を参照し、質問に回答してください。

-----------
{context}
-----------

質問 → {question}
システム: """
MAX_TOKENS = 1024
BATCH_ROWS = 12
LABEL_PAD = -100
# ---------------------------------------------------------------------------


# ---- HTML ----------------------------------------------------------------

class _FirstDivText(HTMLParser):
    """Text of the first <div> whose class matches, nested divs included,
    the contents of script, style and template elements left out."""

    def __init__(self, class_name: str):
        super().__init__(convert_charrefs=True)
        self.want = class_name.split()
        self.depth = 0  # >0 while inside the matched div
        self.done = False
        self.silent: str | None = None  # the open script or style element
        self.parts: list[str] = []

    def _matches(self, attrs) -> bool:
        for k, v in attrs:
            if k == "class" and v is not None:
                toks = v.split()
                return toks == self.want or (len(self.want) == 1 and self.want[0] in toks)
        return False

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        if self.depth:
            if tag in ("script", "style", "template"):
                self.silent = self.silent or tag
            if tag == "div":
                self.depth += 1
        elif tag == "div" and self._matches(attrs):
            self.depth = 1

    def handle_endtag(self, tag):
        if tag == self.silent:
            self.silent = None
        if self.depth and tag == "div":
            self.depth -= 1
            if self.depth == 0:
                self.done = True

    def handle_data(self, data):
        if self.depth and not self.done and not self.silent:
            self.parts.append(data)


def element_text(html: str | None, class_name: str) -> str | None:
    if html is None:
        return None
    p = _FirstDivText(class_name)
    p.feed(html)
    p.close()
    return "".join(p.parts) if (p.done or p.depth) else None


def html_element_text(pages: DataFrame, class_name: str, html_col: str = "html",
                      out: str = "content") -> DataFrame:
    """Text of the first ``div`` of the given class per page (NULL when
    the page has none; ``rejected_pages`` lists those).  Adds
    ``class_name`` and ``out``; the html column is dropped."""

    ensure_shipped(pages.sparkSession)
    pages = spread(pages)

    @F.pandas_udf(T.StringType())
    def _extract(s: pd.Series) -> pd.Series:
        return pd.Series([element_text(h, class_name) for h in s])

    return (pages.withColumn(out, _extract(F.col(html_col)))
            .withColumn("class_name", F.lit(class_name)).drop(html_col))


def rejected_pages(extracted: DataFrame, out: str = "content") -> DataFrame:
    return extracted.where(F.col(out).isNull())


def text_documents(df: DataFrame, text: str, source: str) -> DataFrame:
    """Rows → documents: struct(page_content, metadata{'source': …})."""
    return df.select("*", F.struct(F.col(text).alias("page_content"),
                                   F.create_map(F.lit("source"), F.col(source).cast("string")).alias("metadata")
                                   ).alias("document"))


# ---- chunking ------------------------------------------------------------

CHUNKS_PER_BATCH = 4096


def _chunk_rows(df: DataFrame, text: str, cols: list[str], chunks_of: Callable[[str], Iterator[str]],
                out: str) -> DataFrame:
    """``cols`` with chunk_no (int) and ``out``: the chunks of each text, in
    Arrow batches of a bounded number of chunks (a text's chunks may span
    several)."""
    ensure_shipped(df.sparkSession)
    schema = T.StructType([*[df.schema[c] for c in cols], T.StructField("chunk_no", T.IntegerType()),
                           T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            at, numbers, chunks = [], [], []

            def batch(b=b):
                rows = pa.array(at, pa.int64())
                return pa.RecordBatch.from_arrays([*[c.take(rows) for c in b.columns[1:]], pa.array(numbers, pa.int32()),
                                                   pa.array(chunks, pa.string())], names=[*cols, "chunk_no", out])

            for i in range(b.num_rows):
                t = b.column(0)[i].as_py()
                if t is None:
                    continue
                for n, c in enumerate(chunks_of(t)):
                    at.append(i)
                    numbers.append(n)
                    chunks.append(c)
                    if len(chunks) == CHUNKS_PER_BATCH:
                        yield batch()
                        at, numbers, chunks = [], [], []
            if chunks:
                yield batch()

    return df.select(F.col(text).cast("string"), *cols).mapInArrow(run, schema)


def fixed_chunks(df: DataFrame, text: str, size: int, overlap: int, out: str = "chunk") -> DataFrame:
    """Plain character windows of ``size`` starting every size-overlap
    characters: the columns of ``df`` but the text, ``chunk_no`` (from 0)
    and ``out``.  Each text is walked once, so the time is linear in its
    length."""
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    step = size - overlap

    def windows(t: str) -> Iterator[str]:
        for i in range(0, len(t), step):
            yield t[i:i + size]

    return _chunk_rows(spread(df), text, [c for c in df.columns if c not in (text, "chunk_no", out)], windows, out)


def _split_keep(text: str, sep: str) -> list[str]:
    """Split keeping each separator at the start of the following piece."""
    if sep == "":
        return list(text)
    parts = text.split(sep)
    out = [parts[0]] + [sep + p for p in parts[1:]]
    return [p for p in out if p != ""]


def recursive_split(text: str, size: int, overlap: int, separators=SEPARATORS,
                    length: Callable[[str], int] = len) -> list[str]:
    """Chunks of at most ``size`` (by ``length``) preferring breaks at
    blank lines, then newlines, then spaces, then anywhere; consecutive
    pieces merge up to ``size`` and the next chunk restarts with trailing
    pieces of at most ``overlap``.  Chunks are stripped of surrounding
    whitespace and empty ones dropped."""
    sep = separators[-1]
    rest: tuple[str, ...] = ()
    for i, s in enumerate(separators):
        if s == "" or s in text:
            sep, rest = s, tuple(separators[i + 1:])
            break
    pieces = _split_keep(text, sep)
    chunks: list[str] = []
    window: list[str] = []
    total = 0

    def flush():
        c = "".join(window).strip()
        if c:
            chunks.append(c)

    for p in pieces:
        lp = length(p)
        if lp > size:
            if window:
                flush()
                window, total = [], 0
            if rest:
                chunks.extend(recursive_split(p, size, overlap, rest, length))
            else:
                c = p.strip()
                if c:
                    chunks.append(c)
            continue
        if total + lp > size and window:
            flush()
            while window and (total > overlap or total + lp > size):
                total -= length(window[0])
                window.pop(0)
        window.append(p)
        total += lp
    if window:
        flush()
    return chunks


def recursive_chunks(df: DataFrame, key: str, text: str, size: int = 100, overlap: int = 10,
                     keep: tuple[str, ...] = (), length: Callable[[str], int] = len) -> DataFrame:
    """One row per chunk: key, kept columns, ``chunk_no``, ``chunk``.
    Runs the splitter per document inside Arrow batches."""
    return _chunk_rows(spread(df), text, [key, *keep], lambda t: recursive_split(t, size, overlap, SEPARATORS, length), "chunk")


# ---- vectors -------------------------------------------------------------

def embed_text(df: DataFrame, text: str, out: str = "embedding", dim: int = 64,
               model: Callable[[list[str]], np.ndarray] | None = None,
               model_factory: Callable[[], Callable[[list[str]], np.ndarray]] | None = None) -> DataFrame:
    """Text → float vector.  Default: hashed bag of lower-cased words
    (HashingTF, L2-normalised, JVM side; deterministic, no download).
    ``model_factory()`` returns ``encode(list_of_texts) → array`` and is
    called once per Python worker (e.g. a sentence-embedding model)."""
    if model_factory is None and model is None:
        words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))),
                                     F.lit(r"[\p{L}\p{M}\p{N}_]+"), 0)
        tmp = df.withColumn("_words", words)
        tf = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dim).transform(tmp)
        nv = Normalizer(inputCol="_tf", outputCol="_nv", p=2.0).transform(tf)
        return nv.withColumn(out, vector_to_array("_nv", "float32")).drop("_words", "_tf", "_nv")
    factory = model_factory or (lambda: model)
    ensure_shipped(df.sparkSession)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _enc(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = factory()
        for s in it:
            v = np.asarray(enc(s.fillna("").tolist()), dtype=np.float32)
            yield pd.Series(list(v))

    return df.withColumn(out, _enc(F.col(text)))


def assign_chunk_id(df: DataFrame, collection: str | Column, doc: str, chunk_no: str,
                    out: str = "id", random_uuid: bool = False, content: str | None = None) -> DataFrame:
    """Repeatable id: sha256 of 'collection/doc/chunk_no' (re-runs give
    the same ids, so appends can skip rows already stored), with
    ``content`` also of that column's MD5, so an edited chunk is a new row.  With
    ``random_uuid`` a fresh UUID per row instead (the non-repeatable
    behaviour; re-running an insert then stores copies)."""
    if random_uuid:
        return df.withColumn(out, F.expr("uuid()"))
    coll = F.lit(collection) if isinstance(collection, str) else collection
    parts = [coll, F.col(doc).cast("string"), F.col(chunk_no).cast("string")]
    if content is not None:
        parts.append(F.md5(F.coalesce(F.col(content), F.lit(""))))
    return df.withColumn(out, F.sha2(F.concat_ws("/", *parts), 256))


def dimension_guard(df: DataFrame, vec: str = "embedding", dim: int | None = None,
                    model_col: str | None = None, model: str | None = None) -> DataFrame:
    """Rows whose vector length or model differs from the expected ones
    (empty when the store is consistent)."""
    bad = F.lit(False)
    if dim is not None:
        bad = bad | (F.size(vec) != dim) | F.col(vec).isNull()
    if model_col and model is not None:
        bad = bad | (F.col(model_col) != model)
    return df.where(bad)


# ---- search --------------------------------------------------------------

BLOCK_ROWS = 8192  # rows of a block of either side


def similarity_search(store: DataFrame, queries: DataFrame, k: int = DEFAULT_K, metric: str = "l2",
                      store_id: str = "id", store_vec: str = "embedding", query_id: str = "qid",
                      query_vec: str = "embedding", keep: tuple[str, ...] = (),
                      round_digits: int | None = 5, cells: int | None = None, evaluated=None) -> DataFrame:
    """Exact k nearest store rows per query: (qid, store id, kept store
    columns, ``dist``, ``rank`` 1..k), ranked by the raw distance, then id;
    only the shown ``dist`` is rounded.

    Both sides stay distributed; queries visit the cells of a metric index in
    order of their bounds until none can hold a nearer row (``search``).
    ``cells`` sets their number, the accumulator ``evaluated`` counts the pairs
    looked at.  Vectors that are
    NULL, hold NULL or non-finite numbers, or differ in length from the
    most frequent length of the store take no part (``dimension_guard``
    lists them)."""
    spark = store.sparkSession
    ensure_shipped(spark)

    def fit(df, vec):
        return df.where(F.col(vec).isNotNull() & F.forall(F.col(vec).cast("array<double>"), lambda x: F.coalesce(
            ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))

    sizes = fit(store, store_vec).groupBy(F.size(store_vec).alias("d")).agg(F.count(F.lit(1)).alias("n")).where("d > 0")
    top = sizes.orderBy(F.desc("n"), "d").first()
    kept = [F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]
    sid, qid = store.schema[store_id].dataType, queries.schema[query_id].dataType
    out = T.StructType([T.StructField("qid", qid), T.StructField(store_id, sid), *[store.schema[c] for c in keep],
                        T.StructField("dist", T.DoubleType()), T.StructField("rank", T.IntegerType())])
    if top is None:
        return spark.createDataFrame([], out)
    dim, n = top["d"], top["n"]
    # single precision travels as such, and is widened where it is used
    single = all(isinstance(t, T.ArrayType) and isinstance(t.elementType, T.FloatType)
                 for t in (store.schema[store_vec].dataType, queries.schema[query_vec].dataType))
    numbers = "array<float>" if single else "array<double>"
    s = fit(store, store_vec).where(F.size(store_vec) == dim).select(
        F.col(store_id).alias("sid"), F.col(store_vec).cast(numbers).alias("v"), *kept)
    q = fit(queries, query_vec).where(F.size(query_vec) == dim).select(
        F.col(query_id).alias("qid"), F.col(query_vec).cast(numbers).alias("v"))
    best = cell_search(s, q, n, dim, k, metric, BLOCK_ROWS, cells, evaluated)
    dist = F.col("d") if round_digits is None else F.round("d", round_digits)
    return best.select("qid", F.col("sid").alias(store_id), *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)],
                       (dist + F.lit(0.0)).alias("dist"), "rank")  # -0.0 → 0.0


def retrieval_compare(a: DataFrame, b: DataFrame, store_id: str = "id") -> DataFrame:
    """Per query: how many of the k results two searches share (overlap@k)
    and the size of each result list."""
    ka = a.select("qid", F.col(store_id).alias("_sid"), F.lit(1).alias("_a"))
    kb = b.select("qid", F.col(store_id).alias("_sid"), F.lit(1).alias("_b"))
    j = ka.join(kb, ["qid", "_sid"], "full_outer")
    return j.groupBy("qid").agg(F.count("_a").cast("bigint").alias("n_a"), F.count("_b").cast("bigint").alias("n_b"),
                                F.sum(F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), 1)
                                      .otherwise(0)).cast("bigint").alias("overlap"))


# ---- prompts and training rows --------------------------------------------

#: What a Python repr escapes beyond quotes and backslash: separators other
#: than the space, control, format, private-use, surrogate and unassigned code points.
_UNPRINTED = r"[\p{Z}\p{C}&&[^ ]]"


def py_str_repr(c: Column) -> Column:
    """Python repr of a string: double quotes when the text has a single
    quote and no double quote, else single quotes with \\' escaped;
    backslashes, control characters and other unprinted characters (such
    as U+3000) escaped."""
    esc = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for a, b in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        esc = F.replace(esc, F.lit(a), F.lit(b))

    def one(ch: Column) -> Column:
        code = F.ascii(ch)
        h = F.lower(F.hex(code))
        return F.when(F.rlike(ch, F.lit(_UNPRINTED)), F.when(code < 256, F.concat(F.lit("\\x"), F.lpad(h, 2, "0")))
                      .when(code < 65536, F.concat(F.lit("\\u"), F.lpad(h, 4, "0")))
                      .otherwise(F.concat(F.lit("\\U"), F.lpad(h, 8, "0")))).otherwise(ch)

    # characters one by one only where there is something to escape
    esc = F.when(F.rlike(esc, F.lit(_UNPRINTED)), F.array_join(F.transform(F.split(esc, ""), one), "")).otherwise(esc)
    dq = F.contains(c, F.lit("'")) & ~F.contains(c, F.lit('"'))
    return F.when(dq, F.concat(F.lit('"'), esc, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(esc, F.lit("'"), F.lit("\\'")), F.lit("'")))


def py_list_repr(texts: Column) -> Column:
    """"['a', 'b']" for an array of strings."""
    return F.concat(F.lit("["), F.array_join(F.transform(texts, py_str_repr), ", "), F.lit("]"))


def fill_template(template: str, **parts: Column) -> Column:
    """The template with each {name} replaced by the given column.  The
    template is cut once, so braces inside the values stay as they are."""
    pieces = re.split(r"\{(" + "|".join(map(re.escape, parts)) + r")\}", template)
    return F.concat(*[parts[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces)])


def prompt_build(hits: DataFrame, questions: DataFrame, qid: str = "qid", question: str = "question",
                 text: str = "chunk", template: str = PROMPT_TEMPLATE_TEXT, out: str = "prompt") -> DataFrame:
    """One prompt per question: its retrieved texts in rank order (a list
    bounded by k) rendered as a Python-style list into ``{context}``."""
    ctx = (hits.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", F.col(text).alias("t"))))
                                   .alias("_ctx"))
           .select(F.col("qid").alias(qid), F.transform("_ctx", lambda s: s["t"]).alias("context")))
    q = questions.join(ctx, qid, "left").withColumn("context", F.coalesce("context", F.array().cast("array<string>")))
    return q.withColumn(out, fill_template(template, context=py_list_repr(F.col("context")),
                                           question=F.col(question)))


def qa_pairs(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text", ask: str = "user", answer: str = "assistant") -> DataFrame:
    """Question/answer rows: each ``ask`` turn with the next turn when it
    is an ``answer`` turn.  Joins on (conversation, turn) keys, so one long
    conversation is spread like any others."""
    t = turns.select(F.col(conv).alias("_c"), F.col(turn).alias("_t"), F.col(role).alias("_r"),
                     F.col(text).alias("_x"))
    q = t.where(F.col("_r") == ask)
    a = t.where(F.col("_r") == answer).select("_c", (F.col("_t") - 1).alias("_t"), F.col("_x").alias("answer"))
    return q.join(a, ["_c", "_t"]).select(F.col("_c").alias(conv), F.col("_t").alias(turn), F.col("_x").alias("question"), "answer")


def with_context(pairs: DataFrame, store: DataFrame, keys: list[str], k: int = DEFAULT_K, store_id: str = "id",
                 store_text: str = "text", vec: str = "embedding", metric: str = "l2") -> DataFrame:
    """Adds ``context``: the k store texts nearest to each question, nearest
    first (a list bounded by k).  Both sides carry their vector (see
    ``embed_text``); ``keys`` identify a question."""
    qid = F.to_json(F.struct(*keys))
    held = store.select(store_id, F.col(store_text).alias("_text"), F.col(vec).alias("_v"))
    hits = similarity_search(held, pairs.select(qid.alias("qid"), F.col(vec).alias("_v")), k, metric, store_id=store_id,
                             store_vec="_v", query_vec="_v", keep=("_text",))
    ctx = hits.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "_text"))).alias("_hits"))
    none = F.array().cast("array<string>")
    return (pairs.withColumn("qid", qid).join(ctx, "qid", "left")
            .withColumn("context", F.coalesce(F.transform("_hits", lambda s: s["_text"]), none)).drop("qid", "_hits"))


def sft_examples(pairs: DataFrame, template: str = PROMPT_TEMPLATE_DIALOGUE) -> DataFrame:
    """(inputs, labels): the filled prompt and the answer."""
    return pairs.select("*", fill_template(template, context=py_list_repr(F.col("context")),
                                           question=F.col("question")).alias("inputs"),
                        F.col("answer").alias("labels"))


def codepoint_ids(text: Column) -> Column:
    """Default tokenizer: one id per Unicode code point."""
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c))


def sft_tokenize(df: DataFrame, inputs: str = "inputs", labels: str = "labels", eos: str = "</s>",
                 max_length: int = MAX_TOKENS, tokenizer: Callable[[Column], Column] | None = None) -> DataFrame:
    """inputs + labels + end token → ``input_ids`` cut at ``max_length``
    (no padding) and an all-ones ``attention_mask``."""
    tok = tokenizer or codepoint_ids
    ids = F.slice(tok(F.concat(F.col(inputs), F.col(labels), F.lit(eos))), 1, max_length)
    return (df.withColumn("input_ids", ids)
            .withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids"))))


def collate_batches(df: DataFrame, order: list[str], batch_rows: int = BATCH_ROWS, pad_id: int = 0,
                    label_pad: int = LABEL_PAD) -> DataFrame:
    """Rows in groups of ``batch_rows`` (by the dense index over
    ``order``) padded to the longest row of the group: padded
    ``input_ids`` (pad_id), ``attention_mask`` (0) and ``labels``
    (input ids, ``label_pad`` on padding)."""
    from kestrel.operators.windows import dense_row_index
    idx = dense_row_index(df, order, "_i").withColumn("batch", F.floor(F.col("_i") / batch_rows).cast("bigint"))
    longest = idx.groupBy("batch").agg(F.max(F.size("input_ids")).alias("_len"))
    j = idx.join(longest, "batch")
    pad = F.col("_len") - F.size("input_ids")
    return (j.withColumn("labels_ids", F.concat("input_ids", F.array_repeat(F.lit(label_pad), pad)))
            .withColumn("input_ids", F.concat("input_ids", F.array_repeat(F.lit(pad_id), pad)))
            .withColumn("attention_mask", F.concat("attention_mask", F.array_repeat(F.lit(0), pad)))
            .withColumnRenamed("_len", "padded_len").drop("_i"))


def strip_prompt_echo(df: DataFrame, generated: str, prompt: str, out: str = "answer") -> DataFrame:
    """Drop the first len(prompt)-1 characters of the generated text."""
    return df.withColumn(out, F.expr(f"substring(`{generated}`, length(`{prompt}`))"))
