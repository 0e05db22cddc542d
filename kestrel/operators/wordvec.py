"""Text vectors fitted to a corpus: co-occurrence counts, positive pointwise
mutual information, a truncated factorisation, and a weighted mean of words.

1. Words at most ``window`` apart in a text are counted as pairs: each task counts
   those of some million words, and cells of whole words add them up.  A cell is a
   part of the words by a hash; what is dealt to cells travels as bytes, some hundred
   thousand numbers a row.
2. A pair's weight is max(0, ln(n * total / (row sum * column sum))).  A cell knows the
   sums of its words and asks the others for those of their partners.
3. The symmetric table of weights stays in its cells and is factored by the block Krylov
   iteration of ``lsa`` (no vocabulary cap); a word's vector is its row of the singular
   vectors times the roots of the singular values.
4. A text's vector is the mean of its words' vectors, each weighted by
   a / (a + share of the word), scaled to unit length.

Cases: null and empty texts, and texts of unknown words, are zero vectors;
repeated keys are rows of their own; an empty corpus gives vectors of length 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.operators import lsa
from kestrel.session import discard, ensure_shipped, free_shuffles, scratch_path

WORD = r"[\p{L}\p{M}\p{N}_]+"
CHUNK_WORDS = 1_000_000  # whose pairs are counted at a time
CELL_PAIRS = 4_000_000  # of a cell at most, a pair for each time it was seen
CELL_BYTES = 64 << 20  # of vectors


def words(text: str) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD), 0)


def hashed_words(text: str) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _cell(ids: np.ndarray, cells: list[int]) -> np.ndarray:
    return (lsa._mixed(ids) % np.uint64(len(cells))).astype(np.int64)


def _joined(t: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.concatenate([np.empty(0, kind), *(lsa._read(t, name, i, kind) for i in range(t.num_rows))])


def _chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.Table]:
    """Rows of about CHUNK_WORDS words together."""
    held, n = [], 0
    for b in batches:
        a = 0
        ends = np.cumsum(b.column(column).value_lengths().to_numpy()) if b.num_rows else np.empty(0)
        while a < b.num_rows:
            done = ends[a - 1] if a else 0
            stop = max(a + 1, int(np.searchsorted(ends, done + CHUNK_WORDS - n, side="right")))
            held.append(b.slice(a, stop - a))
            n += int(ends[stop - 1] - done)
            a = stop
            if n >= CHUNK_WORDS:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


_COUNTS = "cell int, a binary, b binary, n binary"
_PAIRS = "cell int, ids binary, a binary, words binary, lens binary, n binary, sums binary, seen binary"


def pair_counts(tokens: DataFrame, window: int, cells: list[int]) -> DataFrame:
    """The distinct pairs of words (ids array<long>) at most ``window`` apart in one row,
    in both orders, and the words' own counts, in a row for each of ``cells``: the cell's
    words, the number of their partners, their sums of pairs and how often they were
    seen; the partners (numbered among ``ids``) and the pairs' counts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(cell: np.ndarray, *cols: np.ndarray | None) -> pa.RecordBatch:
            at = lsa._parts_of(cell)
            return pa.RecordBatch.from_arrays([pa.array([cells[c] for c, _ in at], pa.int32()), *(
                pa.array([None if x is None else x[k].tobytes() for _, k in at], pa.binary()) for x in cols)], names=["cell", "a", "b", "n"])

        for t in _chunks(batches, 0):
            lists = t.column(0).combine_chunks()
            ids, at, seen = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True, return_counts=True)
            if not len(ids):
                continue
            cell, doc = _cell(ids, cells), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            codes = []
            for d in range(1, window + 1):
                same = doc[:-d] == doc[d:]
                left, right = at[:-d][same], at[d:][same]
                codes.append(np.minimum(left, right) * len(ids) + np.maximum(left, right))
            pairs, n = np.unique(np.concatenate(codes), return_counts=True)
            low, high = pairs // len(ids), pairs % len(ids)
            two = low != high  # two words next to each other are a pair in both orders, a word next to itself is one twice
            n = np.where(two, n, 2 * n)
            a, b, n = np.concatenate([low, high[two]]), np.concatenate([high, low[two]]), np.concatenate([n, n[two]])
            yield rows(cell[b], ids[a], ids[b], n)
            yield rows(cell, None, ids, seen)

    def add(t: pa.Table) -> pa.Table:
        paired = pc.is_valid(t.column("a"))
        p, own = t.filter(paired), t.filter(pc.invert(paired))
        names, at = np.unique(_joined(own, "b", np.int64), return_inverse=True)
        seen = np.bincount(at, _joined(own, "n", np.int64), len(names)).astype(np.int64)
        ids, a = np.unique(_joined(p, "a", np.int64), return_inverse=True)
        code = np.searchsorted(names, _joined(p, "b", np.int64)) * max(len(ids), 1) + a
        order = np.argsort(code)
        code = code[order]
        first = np.flatnonzero(np.diff(code, prepend=-1))
        n = np.add.reduceat(_joined(p, "n", np.int64)[order], first) if len(first) else np.empty(0, np.int64)
        b, a = np.divmod(code[first], max(len(ids), 1))
        held = (ids, a.astype(np.int32), names, np.bincount(b, minlength=len(names)).astype(np.int32), n, np.bincount(b, n, len(names)).astype(np.int64), seen)
        return pa.table({"cell": t.column("cell")[:1], **{name: pa.array([x.tobytes()], pa.binary()) for name, x in zip(("ids", "a", "words", "lens", "n", "sums", "seen"), held)}})

    return tokens.mapInArrow(count, _COUNTS).groupBy("cell").applyInArrow(add, _PAIRS)


def partner_sums(pairs: DataFrame, cells: list[int]) -> DataFrame:
    """(cell, ids, sums): what each cell's partners sum to."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            for i in range(t.num_rows):
                ids = lsa._read(t, "ids", i, np.int64)
                at = lsa._parts_of(_cell(ids, cells))
                yield pa.RecordBatch.from_arrays([pa.array([cells[c] for c, _ in at], pa.int32()), pa.array([t.column("cell")[i].as_py()] * len(at), pa.int32()),
                                                  pa.array([ids[k].tobytes() for _, k in at], pa.binary())], names=["cell", "of", "ids"])

    def told(l: pa.Table, r: pa.Table) -> pa.Table:
        names, sums = _joined(r, "words", np.int64), _joined(r, "sums", np.int64)
        ids = [lsa._read(l, "ids", i, np.int64) for i in range(l.num_rows)]
        return pa.table({"cell": l.column("of"), "ids": l.column("ids"), "sums": pa.array([sums[np.searchsorted(names, x)].tobytes() for x in ids], pa.binary())})

    asked = pairs.select("cell", "ids").mapInArrow(ask, "cell int, of int, ids binary")
    known = pairs.select("cell", "words", "sums")
    return asked.groupBy("cell").cogroup(known.groupBy("cell")).applyInArrow(told, "cell int, ids binary, sums binary")


@dataclass
class WordVectors:
    """Fitted table under ``path``: vectors (cell, words, v), these times the words' weights, as bytes."""
    path: str
    width: int
    smooth: float
    cells: list

    def embed(self, df: DataFrame, text: str, out: str = "embedding") -> DataFrame:
        """The columns of ``df`` with a vector of ``width`` doubles."""
        spark = df.sparkSession
        ensure_shipped(spark)
        at, width, cells = scratch_path(spark, "embed-fitted"), self.width, self.cells
        cols = [c for c in df.columns if c != out]
        df.select(F.monotonically_increasing_id().alias("rid"), F.struct(*cols).alias("row"), hashed_words(text).alias("ids")).write.parquet(at)
        rows = spark.read.parquet(at)  # numbers are stable now
        if not width:
            return rows.select("row.*", F.array().cast("array<double>").alias(out))
        parts = lsa.labels(max(len(cells), spark.sparkContext.defaultParallelism), int(spark.conf.get("spark.sql.shuffle.partitions")))

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Each row's distinct words, by cell."""
            for t in _chunks(batches, 1):
                lists = t.column(1).combine_chunks()
                ids, word = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
                if not len(ids):
                    continue
                row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                pairs, n = np.unique(row * len(ids) + word, return_counts=True)
                row, word = np.divmod(pairs, len(ids))
                rid = t.column(0).to_numpy()
                at = lsa._parts_of(_cell(ids, cells)[word])
                yield pa.RecordBatch.from_arrays([pa.array([cells[c] for c, _ in at], pa.int32()), *(
                    pa.array([x[k].tobytes() for _, k in at], pa.binary()) for x in (rid[row], ids[word], n.astype(np.int32)))], names=["cell", "rid", "t", "n"])

        def sums(l: pa.Table, r: pa.Table) -> pa.Table:
            if not l.num_rows or not r.num_rows:
                return lsa._no_partial()
            known, v = _joined(r, "words", np.int64), _joined(r, "v", np.float64).reshape(-1, width)
            order = np.argsort(known)
            known, made = known[order], []
            for i in range(l.num_rows):  # a row's words are in one chunk
                rid, t, n = (lsa._read(l, name, i, kind) for name, kind in (("rid", np.int64), ("t", np.int64), ("n", np.int32)))
                place = np.minimum(np.searchsorted(known, t), len(known) - 1)
                hit = known[place] == t
                found, key = np.unique(rid[hit], return_inverse=True)
                total, by = np.zeros((len(found), width)), np.argsort(key, kind="stable")
                lsa._add(total, key[by], v, order[place[hit]][by], n[hit][by].astype(float))
                made.append(lsa._partial(found, l.column("cell")[0].as_py(), np.empty(len(found)), total, parts, np.float64))
            return pa.concat_tables(made)

        def unit(t: pa.Table) -> pa.Table:
            rid = np.unique(_joined(t, "rid", np.int64))
            total = np.zeros((len(rid), width))
            for _, ids, _, v in lsa._partials(t, width):
                total[np.searchsorted(rid, ids)] += v
            size = np.sqrt(np.einsum("ij,ij->i", total, total))[:, None]
            return pa.table({"rid": pa.array(rid), "v": lsa._lists(np.divide(total, size, out=np.zeros_like(total), where=size > 0))})

        vectors = spark.read.schema("cell int, words binary, v binary").parquet(f"{self.path}/vectors")
        dealt = rows.select("rid", "ids").mapInArrow(deal, "cell int, rid binary, t binary, n binary")
        v = dealt.groupBy("cell").cogroup(vectors.groupBy("cell")).applyInArrow(sums, lsa._PARTIAL).groupBy("bucket").applyInArrow(unit, "rid long, v array<double>")
        zero = F.array_repeat(F.lit(0.0), width)
        return rows.select("rid", "row").join(v, "rid", "left").select("row.*", F.coalesce("v", zero).alias(out))


def fit(df: DataFrame, text: str, dim: int = 64, window: int = 4, smooth: float = 1e-3, rounds: int = 5) -> WordVectors:
    """Vectors of the words of ``text`` in all rows of ``df``."""
    spark = df.sparkSession
    ensure_shipped(spark)
    path = scratch_path(spark, "word-vectors")
    df.select(hashed_words(text).alias("ids")).write.parquet(f"{path}/ids")
    ids = spark.read.schema("ids array<long>").parquet(f"{path}/ids")
    total = ids.agg(F.sum(F.size("ids").cast("long"))).first()[0] or 0
    least, cores = int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    most = 2 * window * total
    n_cells = max(1, math.ceil(most / CELL_PAIRS), min(2 * cores, math.ceil(most / 100_000)))
    cells, name = lsa.labels(n_cells, max(n_cells, least)), lsa._table_name()
    pairs = lsa._bucketed(pair_counts(ids, window, cells), f"{path}/pairs", "cell", max(n_cells, least), name)
    s = pairs.select(F.sum(F.octet_length("words") / 8).cast("long"), F.sum(F.octet_length("n") / 8).cast("long")).first()
    terms, nnz = s[0] or 0, s[1] or 0

    def whole_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int(np.frombuffer(x.as_buffer(), np.int64).sum()) for x in b.column(0)], pa.int64())], names=["n"])

    whole = pairs.select("sums").mapInArrow(whole_of, "n long").agg(F.sum("n")).first()[0] or 0
    discard(spark, f"{path}/ids")
    if not whole:
        lsa._drop(spark, name, f"{path}/pairs")
        return WordVectors(path, 0, smooth, [])
    places = {c: i for i, c in enumerate(cells)}

    def deal(blocks: list[int]) -> DataFrame:
        def weighted(l: pa.Table, r: pa.Table) -> pa.Table:
            if not l.num_rows or not r.num_rows:
                return lsa.sliced(0, 0, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
            told, sums = _joined(r, "ids", np.int64), _joined(r, "sums", np.int64)
            order = np.argsort(told)
            ids, a, names, lens, n, own = (_joined(l, c, k) for c, k in (("ids", np.int64), ("a", np.int32), ("words", np.int64), ("lens", np.int32), ("n", np.int64), ("sums", np.int64)))
            of = sums[order][np.searchsorted(told[order], ids)]
            b = np.repeat(np.arange(len(names)), lens)
            w = np.log(n * float(whole) / of[a] / own[b])
            some = w > 0
            place = places[l.column("cell")[0].as_py()]
            return lsa.sliced(blocks[place % len(blocks)], place // len(blocks), ids[a[some]], names[b[some]], w[some].astype(np.float32))

        return pairs.groupBy("cell").cogroup(partner_sums(pairs, cells).groupBy("cell")).applyInArrow(weighted, lsa.BUILT)

    f = lsa.hold(spark, deal, nnz, terms).factor(terms, dim, rounds, path=f"{path}/svd", rows_too=False)
    width = len(f.values)
    made = lsa.labels(max(1, min(cores, lsa.FEW_BLOCKS, math.ceil(terms / 1000)), math.ceil(terms * 8 * (width + 1) / CELL_BYTES)), least)
    if width:
        scale = np.sqrt(f.values)

        def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The words' weights in a text, by cell of the vectors."""
            for b in batches:
                t = pa.Table.from_batches([b])
                names, seen = _joined(t, "words", np.int64), _joined(t, "seen", np.int64)
                at = lsa._parts_of(_cell(names, made))
                yield pa.RecordBatch.from_arrays([pa.array([made[c] for c, _ in at], pa.int32()), *(
                    pa.array([x[k].tobytes() for _, k in at], pa.binary()) for x in (names, smooth / (smooth + seen / total)))], names=["cell", "words", "weight"])

        def together(l: pa.Table, r: pa.Table) -> pa.Table:
            names, weight = _joined(r, "words", np.int64), _joined(r, "weight", np.float64)
            order = np.argsort(names)
            t, v = _joined(l, "rid", np.int64), _joined(l, "v", np.float64).reshape(-1, width)
            v = v * scale * weight[order[np.searchsorted(names[order], t)]][:, None] if len(t) else v
            return pa.table({"cell": r.column("cell")[:1], "words": pa.array([t.tobytes()][:r.num_rows], pa.binary()), "v": pa.array([v.tobytes()][:r.num_rows], pa.binary())})

        held = pairs.select("words", "seen").mapInArrow(shares, "cell int, words binary, weight binary")
        f.right(made).groupBy("bucket").cogroup(held.groupBy("cell")).applyInArrow(together, "cell int, words binary, v binary").write.parquet(f"{path}/vectors")
    f.release()
    lsa._drop(spark, name, f"{path}/pairs")
    free_shuffles(spark)
    return WordVectors(path, width, smooth, made)
