"""Toxicity: a factorization machine over hashed terms.

Terms of a text are its words (white-space separated, lower-cased, without
marks at their ends) and the first ``PREFIXES`` characters of longer words,
each hashed to ``2 ** HASH_BITS`` buckets; a term counts once per text.  The
machine's score is a logistic function of

    b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j,

so pairs of terms (an insult with a mention of a group) weigh beyond their
sum.  Training takes at most ``max_train`` labelled rows (a documented
bound; the rows with the smallest hashes of their keys): their buckets'
class counts are summed by Spark, the ``max_terms`` most telling buckets
(likelihood ratio) are kept, and the machine is fitted to the rows' kept
buckets by Adam from a fixed start.  Scoring reads whole texts in one pass
without a shuffle; what travels is the kept buckets' weights.

Cases: null and empty texts have no terms and get the score of the bias;
repeated rows score alike; labels of a key that contradict each other count
as toxic; rows without a label, null keys and held-out rows teach nothing;
without both classes to learn from every score is the share of toxic rows
(0 without any); extra columns pass through, columns named like the outputs
are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm import workercache
from kestrel.session import ensure_shipped

HASH_BITS = 26
PREFIXES = (4, 5)
WORDS_KEPT = 500_000
BYTES_AT_ONCE = 4 << 20
OUTS = ("score", "predicted")


def _bare(w: str) -> str:
    a, b = 0, len(w)
    mark = lambda c: unicodedata.category(c)[0] in "PSCZ"
    while a < b and mark(w[a]):
        a += 1
    while b > a and mark(w[b - 1]):
        b -= 1
    return w[a:b]


def buckets(word: str) -> list[int]:
    """Hashed terms of a lower-cased word: itself and its prefixes."""
    w = _bare(word)
    if not w:
        return []
    terms = ["=" + w, *("^" + w[:n] for n in PREFIXES if len(w) > n + 1)]
    return [xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) >> (64 - HASH_BITS) for t in terms]


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BYTES_AT_ONCE, side="right")))
        yield texts.slice(a, b - a)
        a = b


def words_of(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct lower-cased words, each occurrence's word, first occurrence of each text and the end)."""
    split = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    coded = split.flatten().dictionary_encode()
    offsets = split.offsets.to_numpy()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False), offsets - offsets[0]


class TermFinder:
    """Kept terms of texts: (text, term number) pairs, each once."""

    def __init__(self, numbers: dict[int, int]):
        self.numbers = numbers
        self.seen: dict[str, tuple[int, ...]] = {}

    def _of(self, w: str) -> tuple[int, ...]:
        got = self.seen.get(w)
        if got is None:
            if len(self.seen) >= WORDS_KEPT:
                self.seen.clear()
            got = self.seen[w] = tuple(self.numbers[b] for b in buckets(w) if b in self.numbers)
        return got

    def pairs(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words, at, offsets = words_of(texts)
        terms = [self._of(w) for w in words]
        has = np.fromiter(map(bool, terms), bool, len(terms))
        where = np.flatnonzero(has[at]) if len(words) else np.empty(0, np.int64)
        doc = np.searchsorted(offsets, where, side="right") - 1
        pairs = {(int(d), t) for d, w in zip(doc, at[where]) for t in terms[w]}
        if not pairs:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        d, t = np.array(sorted(pairs)).T
        return d, t


@dataclass
class Machine:
    bias: float
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))
    numbers: dict[int, int] = field(default_factory=dict)  # bucket -> term

    def scores(self, doc: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        x = np.full(n, self.bias)
        if len(doc):
            x += np.bincount(doc, self.weight[term], n)
            for k in range(self.factors.shape[1]):
                v = self.factors[term, k]
                x += (np.bincount(doc, v, n) ** 2 - np.bincount(doc, v * v, n)) / 2
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(patterns: list[tuple[int, ...]], rows: np.ndarray, toxic: np.ndarray, terms: int, factors: int = 8,
        steps: int = 300, rate: float = 0.05, l2: float = 2e-4, seed: int = 7) -> Machine:
    """Logistic loss with L2, whole-batch Adam.  Texts with the same terms are
    one pattern: its ``rows`` texts, of which ``toxic`` are toxic."""
    n = rows.sum()
    rng = np.random.default_rng(seed)
    share = np.clip(toxic.sum() / n, 1e-6, 1 - 1e-6)
    params = [np.array([np.log(share / (1 - share))]), np.zeros(terms), rng.normal(0, 0.05, (terms, factors))]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    size = np.fromiter(map(len, patterns), np.int64, len(patterns))
    some = np.flatnonzero(size)
    first = (np.cumsum(size) - size)[some]  # of each pattern with terms
    doc = np.repeat(np.arange(len(patterns)), size)
    term = np.fromiter((t for p in patterns for t in p), np.int64, int(size.sum()))
    by_term = np.argsort(term, kind="stable")
    used, at = np.unique(term[by_term], return_index=True)
    for step in range(1, steps + 1):
        bias, w, v = params
        x = np.full(len(patterns), bias[0])
        vt = v[term]
        total = np.zeros((len(patterns), factors))
        if len(term):
            total[some] = np.add.reduceat(vt, first)
            x[some] += np.add.reduceat(w[term] - (vt * vt).sum(1) / 2, first) + (total[some] ** 2).sum(1) / 2
        err = (rows / (1 + np.exp(-np.clip(x, -30, 30))) - toxic) / n
        grads = [np.array([err.sum()]), l2 * w, l2 * v]
        if len(term):
            slope = err[doc]
            grads[1][used] += np.add.reduceat(slope[by_term], at)
            grads[2][used] += np.add.reduceat((slope[:, None] * (total[doc] - vt))[by_term], at)
        for p, g, (a, b) in zip(params, grads, moments):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return Machine(float(params[0][0]), params[1], params[2])


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          max_train: int = 20_000, max_terms: int = 2048, min_ratio: float = 14.0) -> Machine:
    """Fits on the rows of ``docs`` that have a row (key, label 0/1) in ``labels``."""
    ensure_shipped(docs.sparkSession)
    known = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key)
             .agg(F.max(F.col(label).cast("int")).alias("__y")))
    sample = known.orderBy(F.xxhash64(F.lit(1), key), key).limit(max_train)
    rows = docs.select(key, F.col(text).cast("string").alias("__t")).join(
        F.broadcast(sample), key).select("__y", "__t")  # max_train rows at most

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts, and toxic texts, by bucket."""
        workercache.drop()
        for b in batches:
            y_all, a = b.column(0).to_numpy(), 0
            for texts in _slices(b.column(1)):
                y = y_all[a:a + len(texts)]
                a += len(texts)
                words, at, offsets = words_of(texts)
                by_word = [buckets(w) for w in words]
                size = np.fromiter(map(len, by_word), np.int64, len(words))
                flat = np.fromiter((x for w in by_word for x in w), np.int64, int(size.sum()))
                first = np.cumsum(size) - size
                reps = size[at] if len(words) else size[:0]
                doc = np.repeat(np.repeat(np.arange(len(texts)), np.diff(offsets)), reps)
                place = np.repeat(first[at] - (np.cumsum(reps) - reps), reps) + np.arange(len(doc)) if len(doc) else doc
                pair = np.unique((doc << HASH_BITS) | flat[place])
                found, inv = np.unique(pair & ((1 << HASH_BITS) - 1), return_inverse=True)
                n = np.bincount(inv, minlength=len(found))
                pos = np.bincount(inv, y[pair >> HASH_BITS], len(found)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(n), pa.array(pos)], names=["bucket", "n", "pos"])

    size = rows.agg(F.count("*").alias("texts"), F.coalesce(F.sum("__y"), F.lit(0)).alias("toxic")).first()
    texts, toxic = size["texts"], size["toxic"]
    if not 0 < toxic < texts:
        share = min(max(toxic / texts if texts else 0.0, 1e-9), 1 - 1e-9)
        return Machine(float(np.log(share / (1 - share))))
    x = F.col

    def cell(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)

    without, p0 = texts - x("n"), toxic - x("pos")
    p, q = toxic / texts, 1 - toxic / texts
    ratio = (cell(x("pos"), x("n") * p) + cell(x("n") - x("pos"), x("n") * q)
             + cell(p0, without * p) + cell(without - p0, without * q))
    top = (rows.mapInArrow(counts, "bucket long, n long, pos long").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
           .withColumn("ratio", ratio).where(x("ratio") >= min_ratio)
           .orderBy(F.desc("ratio"), "bucket").limit(max_terms).collect())
    numbers = {r["bucket"]: i for i, r in enumerate(top)}

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = TermFinder(numbers)
        for b in batches:
            y, a = b.column(0), 0
            for texts in _slices(b.column(1)):
                d, t = finder.pairs(texts)
                cuts = np.searchsorted(d, np.arange(len(texts) + 1))
                yield pa.RecordBatch.from_arrays(
                    [y.slice(a, len(texts)), pa.array([t[cuts[i]:cuts[i + 1]].tolist() for i in range(len(texts))], pa.list_(pa.int64()))],
                    names=["y", "terms"])
                a += len(texts)

    # the bounded sample as patterns of kept terms
    got = (rows.mapInArrow(terms, "y int, terms array<long>").groupBy("terms")
           .agg(F.count("*").alias("n"), F.sum("y").alias("toxic")).collect())
    got.sort(key=lambda r: r["terms"])
    m = fit([tuple(r["terms"]) for r in got], np.array([r["n"] for r in got], float), np.array([r["toxic"] for r in got], float), len(numbers))
    m.numbers = numbers
    return m


def score(docs: DataFrame, machine: Machine, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (default all but the text) with score and predicted."""
    ensure_shipped(docs.sparkSession)
    carry = [c for c in (docs.columns if carry is None else carry) if c not in (*OUTS, text)]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    out = ", ".join([*[f"`{c}` {kinds[c]}" for c in carry], "score double"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workercache.drop()
        finder = TermFinder(machine.numbers)
        for b in batches:
            got = [machine.scores(*finder.pairs(t), len(t)) for t in _slices(b.column(0))]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(np.concatenate(got) if got else np.zeros(0))], names=[*carry, "score"])

    return (docs.select(docs[text].cast("string"), *[docs[c] for c in carry]).mapInArrow(judge, out)
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
