"""Review-text preparation: cleaning, tokenising, splitting, TF-IDF.

Built-in expressions do the work; Python runs only inside the optional
tokenizer plug-in (an iterator pandas UDF that builds the tokenizer once
per worker) and the NFKC step.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions import text as tx
from kestrel.operators import lsa
from kestrel.operators import relational as rl
from kestrel.operators.skew import hot_key_join
from kestrel.session import keep

# Default word pattern when no tokenizer plug-in is given: runs of
# letters, combining marks, digits and underscore (same meaning in the JVM
# and in RE2).
WORD_PATTERN = r"[\p{L}\p{M}\p{N}_]+"


def train_test_split(df: DataFrame, key: str, test_frac: float = 0.25, seed: int = 42,
                     out: str = "split", subset: str = "all") -> DataFrame:
    """Repeatable split of exact sizes: of n rows the ceil(test_frac * n)
    with the smallest hash of '<key>:<seed>' (then key) are 'test', the
    rest 'train'.  Rows that share a key share a part, so with repeated
    keys the border group may add rows to 'test'.  ``subset`` keeps 'train', 'test' or 'all' rows.

    The border is found by counting: a histogram over 4096 ranges of the
    hash, refined inside the range that holds it until that has few rows;
    no sort and no shuffle of rows."""
    if subset not in ("train", "test", "all"):
        raise ValueError(f"subset is train, test or all, not {subset!r}")
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    h = F.conv(F.substring(F.md5(F.concat(name, F.lit(f":{seed}"))), 1, 15), 16, 10).cast("bigint")
    keys = df.select(h.alias("h"), name.alias("k"))
    lo, width, want = 0, 1 << 60, None
    while True:
        step = max(1, width >> 12)
        hist = keys.where((F.col("h") >= lo) & (F.col("h") < lo + width)).groupBy(
            F.floor((F.col("h") - lo) / step).cast("bigint").alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()
        cells = sorted((r["c"], r["n"]) for r in hist)  # at most 4096
        if want is None:
            want = math.ceil(sum(n for _, n in cells) * test_frac)
        for c, n in cells:
            if n >= want:
                break
            want -= n
        else:
            break
        lo, width = lo + c * step, step
        if n <= 10_000 or step == 1:
            break
    if want <= 0 or not cells:
        edge = None
    else:
        near = keys.where((F.col("h") >= lo) & (F.col("h") < lo + width)).groupBy("h", "k").agg(
            F.count(F.lit(1)).alias("n")).orderBy("h", "k").limit(want).collect()  # the border's range only
        for r in near:
            edge = r["h"], r["k"]
            want -= r["n"]
            if want <= 0:
                break
    test = F.lit(False) if edge is None else (h < edge[0]) | ((h == edge[0]) & (name <= edge[1]))
    parts = df.withColumn(out, F.when(test, F.lit("test")).otherwise(F.lit("train")))
    return parts if subset == "all" else parts.where(F.col(out) == subset)


def shuffle_key(keys: list[str], seed: int = 0) -> Column:
    """A hash of the keys and the seed to order by."""
    return F.md5(F.concat(F.concat_ws("/", *[F.col(k).cast("string") for k in keys]), F.lit(f":{seed}")))


def shuffle_rows(df: DataFrame, keys: list[str], seed: int = 0) -> DataFrame:
    """Random but repeatable row order: sort by a seeded hash of the keys."""
    return df.orderBy(shuffle_key(keys, seed), *keys)


#: Fixed numbers of the round function (a prime and two multipliers).
_PRIME, _BY_VALUE, _BY_ROUND = 2_147_483_647, 48_271, 69_621
_ROUNDS, _WALK = 4, 64


def permuted(index: Column, n: int, seed: int = 0) -> Column:
    """The place of row ``index`` (0..n-1) in a random order of n rows, as a
    column expression: a bijection for every n, so any slice of the order can
    be found without sorting the rest.

    The index is a cell of a grid of a x b >= n cells; Feistel rounds add a hash
    of the column to the row and of the row to the column.  A place beyond n
    walks on until it is inside: fewer than a cells are outside, so a step
    leaves one with probability below 1 / b; more than _WALK steps raise."""
    a = math.isqrt(max(n - 1, 0)) + 1
    b = max(1, -(-n // a))
    whole = lambda x: x.cast("bigint")

    def mix(x: Column, k: Column | int) -> Column:
        m = (x * _BY_VALUE + k * _BY_ROUND + seed) % _PRIME
        return F.element_at(F.transform(F.array(m), lambda v: (v * v + v) % _PRIME), 1)

    def turn(s: Column, k: Column) -> Column:
        down = (s["l"] + mix(s["r"], 2 * k)) % a
        return F.struct(whole(down).alias("l"), whole((s["r"] + mix(down, 2 * k + 1)) % b).alias("r"))

    def once(x: Column) -> Column:
        start = F.struct(whole(F.floor(x / b)).alias("l"), whole(x % b).alias("r"))
        return F.aggregate(F.sequence(F.lit(0).cast("bigint"), F.lit(_ROUNDS - 1).cast("bigint")), start, turn, lambda s: s["l"] * b + s["r"])

    first = once(whole(index))
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(_WALK)), first, lambda x, _: F.when(x < n, x).otherwise(once(x)))
    return F.when(walk < n, walk).otherwise(F.raise_error(F.lit("no place found within the walk")).cast("bigint"))


def shuffle_positions(df: DataFrame, keys: list[str], seed: int = 0, out: str = "position", index: str | None = None) -> DataFrame:
    """Adds each row's place 0..n-1 in a random, repeatable order: its dense
    index over ``keys`` (or the column ``index``, if there is one) permuted."""
    from kestrel.operators.windows import dense_row_index
    rows = dense_row_index(df, keys, "_shuffle_index") if index is None else df.withColumn("_shuffle_index", F.col(index))
    return rows.withColumn(out, permuted(F.col("_shuffle_index"), rows.count(), seed)).drop("_shuffle_index")


def _builtin_tokens(text: Column, normalize: bool) -> Column:
    t = tx.presplit_text(F.lower(text))
    if normalize:
        t = tx.nfkc_normalize(t)
    return F.regexp_extract_all(t, F.lit(WORD_PATTERN), 0)


def tokenize_content_words(df: DataFrame, col: str, out: str, result_type: str = "list",
                           tokenizer_factory: Callable[[], object] | None = None,
                           normalize: bool = True, stoplist=tx.STOPLIST,
                           keep_pos=tx.CONTENT_POS) -> DataFrame:
    """lower → ordered pre-split replacements → tokenise → NFKC → stoplist
    → keep content words → list or space-joined text.

    ``tokenizer_factory()`` must return an object whose ``tokenize(text)``
    yields ``(base_form, part_of_speech)`` pairs (a morphological analyser
    with a user dictionary fits here); it is built once per Python worker.
    Without it, words are runs of letters/digits (built-in regex, JVM side)
    and no part-of-speech filter applies."""
    from kestrel.operators.partitioning import spread
    df = spread(df)
    if tokenizer_factory is None:
        toks = tx.stoplist_filter(_builtin_tokens(F.col(col), normalize), stoplist)
        return df.withColumn(out, tx.join_tokens(toks, result_type))

    from kestrel.session import ensure_shipped
    ensure_shipped(df.sparkSession)
    stop = set(stoplist)
    keep = set(keep_pos) if keep_pos else None

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def _tok(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import unicodedata
        tk = tokenizer_factory()  # once per worker
        for s in batches:
            res = []
            for text in s:
                if text is None:
                    res.append(None)
                    continue
                words = []
                for base, pos in tk.tokenize(text):
                    b = unicodedata.normalize("NFKC", base) if normalize else base
                    if b in stop:
                        continue
                    if keep is None or pos is None or pos.split(",")[0] in keep:
                        words.append(b)
                res.append(words)
            yield pd.Series(res)

    pre = tx.presplit_text(F.lower(F.col(col)))
    return df.withColumn(out, tx.join_tokens(_tok(pre), result_type))


def clean_reviews(df: DataFrame, tokenizer_factory=None, normalize: bool = True) -> DataFrame:
    """The review table: ID/CUSTOMER as text, CUSTOMER NULL → 'UNKNOWN',
    VOC/SUPPLEMENT/FOLLOWUP NULL → '' with markers stripped, VOC_CAT =
    SUBJECT + VOC + SUPPLEMENT + FOLLOWUP (space separated), token texts of
    VOC_CAT and SUBJECT, SUBMITDATE parsed, LV bucketed, CORRECT recoded."""
    from kestrel.functions.format import text_to_date
    d = df.select(
        F.col("ID").cast("string").alias("ID"), "PRODUCT",
        F.coalesce(F.col("CUSTOMER").cast("string"), F.lit("UNKNOWN")).alias("CUSTOMER"),
        "SUBJECT", "SUBMITDATE",
        F.coalesce(F.col("VOC"), F.lit("")).alias("VOC"),
        tx.strip_markers(F.coalesce(F.col("SUPPLEMENT"), F.lit("")), tx.SUPPLEMENT_MARKERS).alias("SUPPLEMENT"),
        tx.strip_markers(F.coalesce(F.col("FOLLOWUP").cast("string"), F.lit("")),
                         tx.FOLLOWUP_MARKERS).alias("FOLLOWUP"),
        "CLASS", "LV", "CORRECT")
    d = d.withColumn("VOC_CAT", tx.concat_fields("SUBJECT", "VOC", "SUPPLEMENT", "FOLLOWUP"))
    d = tokenize_content_words(d, "VOC_CAT", "VOC_MORPHEME_S", "str", tokenizer_factory, normalize)
    d = tokenize_content_words(d, "SUBJECT", "SUBJECT_MORPHEME_S", "str", tokenizer_factory, normalize)
    sub = F.col("SUBMITDATE")
    if not isinstance(df.schema["SUBMITDATE"].dataType, (T.TimestampType, T.TimestampNTZType)):
        sub = text_to_date(F.col("SUBMITDATE").cast("string"))
    return d.select("ID", "PRODUCT", "CUSTOMER", "SUBJECT", sub.alias("SUBMITDATE"), "VOC", "SUPPLEMENT",
                    "FOLLOWUP", "CLASS", rl.bucket_level("LV").alias("LV"),
                    rl.recode_correct("CORRECT").alias("CORRECT"), "VOC_CAT", "VOC_MORPHEME_S",
                    "SUBJECT_MORPHEME_S")


def tfidf_weights(docs: DataFrame, key: str, tokens: str, smooth_idf_plus_one: bool = True) -> DataFrame:
    """Relational TF-IDF: one row (key, term, weight) per distinct term of
    a document (a row; keys are unique).  idf = ln((1+N)/(1+df)) (+1 with
    ``smooth_idf_plus_one``), weight = tf·idf scaled to unit L2 norm.

    Scale: terms are counted inside the row, so tokens are never shuffled;
    document frequencies group by term with partial aggregation; a term
    found in a large share of the documents is joined by broadcast (few
    such can exist), the others by a shuffle on the term; the norm is a
    window per document, bounded by its distinct terms."""
    n_docs = docs.select(key).count()
    pairs = F.explode_outer(lsa.term_counts(F.col(tokens)))
    # explode_outer + explicit filter: an inner explode lets the optimizer
    # infer a size>0 filter and evaluate the token expression twice
    tf = docs.select(key, pairs.alias("e")).where(F.col("e").isNotNull()).select(key, "e.term", "e.tf")
    tf = keep(tf)
    plus = 1.0 if smooth_idf_plus_one else 0.0
    idf = keep(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))).withColumn(
        "idf", F.ln(F.lit(float(n_docs + 1)) / (F.col("df") + 1)) + F.lit(plus))
    w = hot_key_join(tf, idf, ["term"], "df").select(key, "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return w.select(key, "term", (F.col("w") / norm).alias("weight"))


def rank_terms(weights: DataFrame, key: str, k: int = 10) -> DataFrame:
    """Top-k terms per document by weight (term breaks ties)."""
    w = Window.partitionBy(key).orderBy(F.desc("weight"), "term")
    return weights.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")
