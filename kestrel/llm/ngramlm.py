"""Quality classifier: perplexity under an interpolated modified Kneser-Ney
n-gram model of trusted text, against quantiles of each language.

Units are characters (any script, no tokenizer), n-grams of order ``ORDER``
packed exactly into 64 bits: four 16-bit symbols, so context and suffix of a
key are bit operations.  (Characters beyond U+EFFC share symbols.)

1. Trusted texts (rows whose key is in the trusted table, found by
   fixed-size bit filters without a shuffle of the texts) give n-gram
   counts, one row per n-gram and task.
2. The model is built by grouped aggregation: counts of the highest order,
   continuation counts below, modified discounts from counts of counts; it
   is one table: key, discounted probability, back-off weight of the key as
   a context.
3. Documents are cut into blocks by their place in the input files.  A block
   asks for its distinct n-grams; these requests are joined with the model,
   sharded by key, and the answers meet the block's texts (compressed) in a
   co-group, which scores whole texts.  Requests grow with the input, the
   n-grams a block asks for do not exceed its distinct ones, and no hot
   n-gram has more rows than there are blocks.
4. A text's bits per character, drawn to its language's usual value by
   ``DRAW`` characters (short texts say little), is compared with quantiles
   of the trusted texts of its language, once scored by a model that did not
   count them and once by the whole one; the wider limits hold, for unseen
   texts and seen ones (or their copies).  The models without a fold of the
   trusted texts (by a hash of the text, so exact copies are in one fold)
   come from the same counts.  The spread around a language's median is drawn
   to that of all languages by its number of trusted texts, and doubt about
   the median widens it; a language without trusted texts stays undecided.

Cases: null and empty texts consist of the end symbol alone and so score near
the usual value; null languages are a language of their own; repeated rows
score alike; null keys are never trusted; an empty trusted table rejects
nothing (perplexity null); extra columns pass through, columns named like
the outputs are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm import workercache
from kestrel.llm.bitfilter import semi_join
from kestrel.session import ensure_shipped, scratch_path

ORDER = 4
BOS, EOS, FIRST, SHARED = 1, 2, 3, 0xF000
DRAW = 200
BLOCK_ROWS = 8192
CHARS_AT_ONCE = 3 << 19
DENSE_CELLS = 1 << 23
FOLDS = 5  # models 1 to FOLDS lack a fold of the trusted texts, model 0 none
MODEL_BITS = 3
OUTS = ("n_chars", "perplexity", "low", "high", "kept")


def symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts, each after ORDER - 1 begin marks and before an
    end mark; their number by text)."""
    texts = pc.fill_null(texts, "")
    sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = "".join(texts.to_pylist())
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sym = code + np.uint32(FIRST)
    big = sym >= SHARED
    if big.any():
        sym = np.where(big, SHARED + code % 0xFF0, sym)
    full = sizes + ORDER
    out = np.full(int(full.sum()), BOS, np.int32)
    ends = np.cumsum(full)
    out[ends - 1] = EOS
    starts = np.cumsum(sizes) - sizes
    out[np.arange(len(code)) + np.repeat(ends - full + ORDER - 1 - starts, sizes)] = sym
    return out, full


def _rank(values: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values ascending, place of each value among them)."""
    if cells > DENSE_CELLS:
        found, place = np.unique(values, return_inverse=True)
        return found, place.astype(np.int32)
    flag = np.zeros(cells, bool)
    flag[values] = True
    found = np.flatnonzero(flag)
    rank = np.empty(cells, np.int32)
    rank[found] = np.arange(len(found), dtype=np.int32)
    return found, rank[values]


def coded(sym: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(ascending distinct keys of orders 1 to ORDER, place of each
    position's highest-order gram); positions count from ORDER - 1."""
    letters, one = _rank(sym, 1 << 16)
    keys, at = [letters.astype(np.uint64)], one
    for _ in range(ORDER - 1):
        comb = at[:-1].astype(np.int64) * len(letters) + one[len(one) - len(at) + 1:]
        found, at = _rank(comb, len(keys[-1]) * len(letters))
        keys.append((keys[-1][found // len(letters)] << np.uint64(16)) | letters[found % len(letters)].astype(np.uint64))
    return keys, at


def _real(keys: np.ndarray) -> np.ndarray:
    """Not grams that end in a begin mark."""
    return keys[(keys & np.uint64(0xFFFF)) != BOS]


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of a bounded number of characters (one text at least)."""
    size = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CHARS_AT_ONCE, side="right")))
        yield texts.slice(a, b - a)
        a = b


def _sum_by_key(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(at, np.concatenate(counts), len(found)).astype(np.int64)


def count_grams(texts: DataFrame) -> DataFrame:
    """(m, key, n) of the highest order over (text, fold): counts of each model."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workercache.drop()
        keys: list[list[np.ndarray]] = [[] for _ in range(FOLDS)]
        counts: list[list[np.ndarray]] = [[] for _ in range(FOLDS)]
        for b in batches:
            fold = b.column(1).to_numpy()
            for f in np.unique(fold):
                for part in _slices(b.column(0).filter(pa.array(fold == f))):
                    sym, _ = symbols(part)
                    found, at = coded(sym)
                    n = np.bincount(at, minlength=len(found[-1]))
                    real = (found[-1] & np.uint64(0xFFFF)) != BOS
                    keys[f].append(found[-1][real])
                    counts[f].append(n[real])
                    if len(keys[f]) == 16:
                        keys[f], counts[f] = [[x] for x in _sum_by_key(keys[f], counts[f])]
        for f in range(FOLDS):
            if keys[f]:
                k, n = _sum_by_key(keys[f], counts[f])
                for a in range(0, len(k), 1 << 16):
                    part = k[a:a + (1 << 16)].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), f, np.int32)), pa.array(part), pa.array(n[a:a + (1 << 16)])], names=["fold", "key", "n"])

    own = [F.sum(F.when(F.col("fold") == f, F.col("n")).otherwise(0)) for f in range(FOLDS)]
    by_key = texts.mapInArrow(count, "fold int, key long, n long").groupBy("key").agg(
        F.array(F.sum("n"), *[F.sum("n") - x for x in own]).alias("models"))
    return by_key.select("key", F.posexplode("models").alias("m", "n")).where("n > 0").select("m", "key", "n")


def build_model(grams: DataFrame, path: str) -> DataFrame:
    """(m, key, a, g): for each model m the discounted probability of each
    n-gram of every order and the back-off weight of each context, from the
    highest order's counts."""
    spark = grams.sparkSession
    grams.select(F.lit(ORDER).alias("k"), "m", "key", "n").write.parquet(f"{path}/order{ORDER}")
    for k in range(ORDER - 1, 0, -1):  # continuation counts: distinct left neighbours
        above = spark.read.parquet(f"{path}/order{k + 1}")
        mask = (1 << (16 * k)) - 1
        (above.groupBy("m", F.col("key").bitwiseAND(F.lit(mask)).alias("key")).agg(F.count("*").alias("n"))
         .select(F.lit(k).alias("k"), "m", "key", "n").write.parquet(f"{path}/order{k}"))
    rows = spark.read.parquet(*[f"{path}/order{k}" for k in range(1, ORDER + 1)])
    times = {(r["m"], r["k"]): r for r in rows.groupBy("m", "k").agg(
        *[F.sum((F.col("n") == i).cast("long")).alias(f"n{i}") for i in (1, 2, 3, 4)]).collect()}
    if not times:
        return spark.createDataFrame([], "m int, key long, a double, g double")
    discounts = []
    for (m, k), r in times.items():  # a row for each model and order
        n1, n2, n3, n4 = (r[f"n{i}"] for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        d = [i - (i + 1) * y * b / a if a and b else 0.5 * i for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        discounts.append((m, k, *[min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]))
    discount = spark.createDataFrame(discounts, "m int, k int, d1 double, d2 double, d3 double")
    rows = rows.join(F.broadcast(discount), ["m", "k"]).select(
        "m", "k", "key", "n", F.shiftrightunsigned("key", 16).alias("ctx"),
        F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")).alias("d"))
    # the context of order 1 is empty: key 0
    context = rows.groupBy("m", "ctx").agg(F.sum("n").alias("total"), F.sum("d").alias("mass"), F.count("*").alias("v"))
    with_ctx = rows.join(context, ["m", "ctx"]).select("m", "key", ((F.col("n") - F.col("d")) / F.col("total")).alias("a"))
    model = with_ctx.join(context.where("ctx <> 0").select("m", F.col("ctx").alias("key"), (F.col("mass") / F.col("total")).alias("g")), ["m", "key"], "full_outer")
    model = model.select("m", "key", F.coalesce("a", F.lit(0.0)).alias("a"), F.coalesce("g", F.lit(1.0)).alias("g"))
    # key 0, the empty context: what an unseen symbol gets, as order 1 backs off
    # to the uniform distribution over the symbols and one unknown
    unseen = context.where("ctx = 0").select("m", F.lit(0).cast("long").alias("key"), (F.col("mass") / F.col("total") / (F.col("v") + 1)).alias("a"), F.lit(1.0).alias("g"))
    model.unionByName(unseen).write.parquet(f"{path}/model")
    return spark.read.schema("m int, key long, a double, g double").parquet(f"{path}/model")


def probabilities(keys: list[np.ndarray], known: np.ndarray, a: np.ndarray, g: np.ndarray) -> np.ndarray:
    """P of each highest-order key; ``known`` (ascending) with a and g are the
    model's rows for the block."""
    def look(k: np.ndarray, values: np.ndarray, missing: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(known, k), len(known) - 1)
        return np.where(known[at] == k, values[at], missing)

    p = look(keys[0], a, 0.0) + look(np.zeros(1, np.uint64), a, 0.0)[0]
    for k in range(1, len(keys)):
        mask = np.uint64((1 << (16 * k)) - 1)
        # the suffix ends at the same place, so it is among the keys below
        below = p[np.minimum(np.searchsorted(keys[k - 1], keys[k] & mask), len(p) - 1)]
        p = look(keys[k], a, 0.0) + look(keys[k] >> np.uint64(16), g, 1.0) * below
    return p


def _in_files(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with block, by file and row number: the same in every reading.
    Its lowest bits, zero, are for the number of the model."""
    place = F.col("_metadata.file_path"), F.floor(F.col("_metadata.row_index") / BLOCK_ROWS)
    try:
        return docs.select(*docs.columns, F.shiftleft(F.xxhash64(*place), MODEL_BITS).alias("__block"))
    except AnalysisException:  # not read from Parquet files: put it there
        docs.write.parquet(f"{path}/docs")
        stored = docs.sparkSession.read.parquet(f"{path}/docs")
        return stored.select(*stored.columns, F.shiftleft(F.xxhash64(*place), MODEL_BITS).alias("__block"))


def score(placed: DataFrame, model: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """The ``carry`` columns with __n (characters, end mark included) and __bits,
    by the model that a row's block names."""
    out = T.StructType([*[placed.schema[c] for c in carry], T.StructField("__n", T.LongType()), T.StructField("__bits", T.DoubleType())])
    placed = placed.select("__block", placed[text].cast("string").alias("__text"), *carry)

    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct n-grams of every order, by block."""
        workercache.drop()
        have: dict[int, list[np.ndarray]] = {}

        def rows(block: int) -> pa.RecordBatch:
            k = np.unique(np.concatenate(have.pop(block))).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(k), block)), pa.array(k)], names=["block", "key"])

        for b in batches:
            for block, part in _runs(b.select(["__block", "__text"])):
                if block not in have:  # rows of a file come in order
                    for old in list(have):
                        yield rows(old)
                    have[block] = []
                for texts in _slices(part.column(1)):
                    sym, _ = symbols(texts)
                    have[block].append(np.concatenate([_real(k) for k in coded(sym)[0]]))
                    if len(have[block]) == 8:
                        have[block] = [np.unique(np.concatenate(have[block]))]
        for old in list(have):
            yield rows(old)

    begin = [sum(BOS << (16 * i) for i in range(k)) for k in range(1, ORDER)]
    asked = placed.select("__block", "__text").mapInArrow(requests, "block long, key long").distinct()
    blocks = placed.select(F.col("__block").alias("block")).distinct()
    always = blocks.select("block", F.explode(F.array(*[F.lit(x).cast("long") for x in [0, *begin]])).alias("key"))
    asked = asked.unionByName(always).withColumn("m", F.col("block").bitwiseAND(F.lit((1 << MODEL_BITS) - 1)).cast("int"))
    answers = asked.join(model, ["m", "key"]).select("block", "key", "a", "g")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Compressed pieces of blocks."""
        workercache.drop()
        for b in batches:
            for block, part in _runs(b):
                for piece in _pieces(part):
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, piece.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as w:
                        w.write_batch(piece)
                    yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "piece"])

    pieces = placed.mapInArrow(pack, "block long, piece binary")

    def judge(piece: pa.Table, answer: pa.Table) -> pa.Table:
        t = answer
        key = t.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        known, a, g = key[order], t.column("a").to_numpy()[order], t.column("g").to_numpy()[order]
        done = []
        for raw in piece.column("piece"):
            for b in pa.ipc.open_stream(raw.as_buffer()):
                bits, sizes = [], []
                for texts in _slices(b.column(b.schema.get_field_index("__text"))):
                    sym, full = symbols(texts)
                    if len(known):
                        keys, at = coded(sym)
                        cost = -np.log2(probabilities(keys, known, a, g))
                        real = np.concatenate([np.zeros(ORDER - 1), cost[at]])
                        starts = np.cumsum(full) - full
                        real[(starts[:, None] + np.arange(ORDER - 1)).ravel()] = 0  # the begin marks
                        bits.append(np.add.reduceat(real, starts))
                    else:
                        bits.append(np.full(len(full), np.nan))
                    sizes.append(full - (ORDER - 1))
                done.append(pa.table({**{c: b.column(b.schema.get_field_index(c)) for c in carry},
                                      "__n": pa.array(np.concatenate(sizes)), "__bits": pa.array(np.concatenate(bits))}))
        return pa.concat_tables(done)

    return pieces.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(judge, out)


def _runs(b: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Maximal runs of rows of one block (the first column); rows of mixed
    blocks are sorted first."""
    block = b.column(0).to_numpy()
    cuts = np.flatnonzero(np.diff(block)) + 1 if len(block) else []
    if len(cuts) >= len(np.unique(block)):
        order = np.argsort(block, kind="stable")
        b, block = b.take(pa.array(order)), block[order]
        cuts = np.flatnonzero(np.diff(block)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(block)]):
        if hi > lo:
            yield int(block[lo]), b.slice(lo, hi - lo)


def _pieces(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    at = 0
    for texts in _slices(b.column(b.schema.get_field_index("__text"))):
        yield b.slice(at, len(texts))
        at += len(texts)


def quality(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
            carry: list[str] | None = None, tail: float = 0.001, slack: float = 0.25, prior: float = 50.0, doubt: float = 2.0,
            path: str | None = None) -> DataFrame:
    """The ``carry`` columns (default all but the text) with n_chars,
    perplexity, the limits low and high (as perplexities) and kept.

    A language's limits lie around the median of its n trusted texts as unseen
    ones, at the ``tail`` and 1 - ``tail`` quantiles of their deviations from it,
    drawn to the quantiles over all languages with the weight of ``prior`` texts,
    widened by ``slack`` and, for what n texts say about a median, by
    ``doubt`` / sqrt(n).  Languages without trusted texts have no limits (null)
    and keep every row."""
    spark = docs.sparkSession
    ensure_shipped(spark)
    path = path or scratch_path(spark, "ngram-lm")
    carry = [c for c in (docs.columns if carry is None else carry) if c not in (*OUTS, text)]
    trusted = trusted.where(F.col(key).isNotNull()).select(F.col(key).alias("__key")).distinct()
    # the caller's columns travel as one struct: no name of theirs meets one of these
    rows = docs.select(docs[text].cast("string").alias("__doc"), docs[key].alias("__key"), docs[lang].cast("string").alias("__lang"),
                       F.struct(F.lit(0).alias("__0"), *[docs[c] for c in carry]).alias("__row"))
    placed = _in_files(rows, path)
    fold = F.pmod(F.xxhash64(F.coalesce("__doc", F.lit(""))), F.lit(FOLDS))
    texts = semi_join(placed.select("__key", "__lang", "__block", "__doc"), trusted, ["__key"])
    model = build_model(count_grams(texts.select("__doc", fold.cast("int").alias("fold"))), path)
    score(placed, model, ["__key", "__lang", "__row"], "__doc").write.parquet(f"{path}/scores")
    scores = spark.read.parquet(f"{path}/scores")
    unseen = texts.withColumn("__block", F.col("__block").bitwiseOR(fold + 1))
    score(unseen, model, ["__lang"], "__doc").where("not isnan(__bits)").write.parquet(f"{path}/unseen")
    unseen = spark.read.schema("__lang string, __n long, __bits double").parquet(f"{path}/unseen")

    rate = F.col("__bits") / F.col("__n")
    mids = unseen.groupBy("__lang").agg(F.percentile_approx(rate, 0.5, 10_000).alias("__mid"), F.count("*").alias("__texts"))
    mids.select(F.col("__lang").alias("__l"), "__mid", "__texts").write.parquet(f"{path}/mids")  # a row for each language
    mids = spark.read.schema("__l string, __mid double, __texts long").parquet(f"{path}/mids")
    # a text's rate drawn to the usual one, as a deviation from it
    off = (F.col("__bits") - F.col("__n") * F.col("__mid")) / (F.col("__n") + DRAW)
    seen = scores.join(trusted, "__key", "left_semi").where("not isnan(__bits)").select("__lang", "__n", "__bits", F.lit(True).alias("__seen"))
    both = unseen.withColumn("__seen", F.lit(False)).unionByName(seen)
    both = both.join(mids, both["__lang"].eqNullSafe(mids["__l"])).select("__l", "__mid", "__texts", "__seen", off.alias("__off"))
    ends = F.percentile_approx("__off", [tail, 1 - tail], 10_000)
    of_all = both.groupBy("__seen").agg(ends.alias("q")).agg(F.min(F.get("q", 0)).alias("__lo"), F.max(F.get("q", 1)).alias("__hi"))
    own = both.groupBy("__l", "__mid", "__texts", "__seen").agg(ends.alias("q")).groupBy("__l", "__mid", "__texts").agg(
        F.min(F.get("q", 0)).alias("__own_lo"), F.max(F.get("q", 1)).alias("__own_hi"))
    n = F.col("__texts")
    wide = 1 + slack + doubt / F.sqrt(n)

    def limit(a: str, b: str) -> Column:
        return wide * (n * F.col(a) + prior * F.col(b)) / (n + prior)

    limits = own.crossJoin(F.broadcast(of_all)).select("__l", "__mid", limit("__own_lo", "__lo").alias("__low"), limit("__own_hi", "__hi").alias("__high"))  # one row
    limits.write.parquet(f"{path}/limits")
    limits = spark.read.schema("__l string, __mid double, __low double, __high double").parquet(f"{path}/limits")
    judged = scores.join(limits, scores["__lang"].eqNullSafe(limits["__l"]), "left")
    inside: Column = F.coalesce((off >= F.col("__low")) & (off <= F.col("__high")), F.lit(True))
    return judged.select(*[F.col("__row").getField(c).alias(c) for c in carry], F.col("__n").alias("n_chars"),
                         F.when(~F.isnan("__bits"), F.pow(F.lit(2.0), rate)).alias("perplexity"),
                         F.pow(F.lit(2.0), F.col("__mid") + F.col("__low")).alias("low"), F.pow(F.lit(2.0), F.col("__mid") + F.col("__high")).alias("high"),
                         F.when(F.isnan("__bits"), True).otherwise(inside).alias("kept"))
