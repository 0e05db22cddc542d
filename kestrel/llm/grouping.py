"""Packing into few sequences by linear grouping of lengths.

Documents longer than a sequence are cut into whole sequences and a rest.
All that packing needs to know of the rest is how many pieces there are of
each length: a table of at most ``capacity`` numbers, whatever the corpus.
From it the driver makes a plan of bounded size:

1. Pieces above ``capacity / small`` are large.  In order of length they form
   groups of equal cardinality; each is rounded up to its group's longest.
2. Few sizes leave few useful configurations (how many of each group share a
   sequence).  Column generation solves their linear programme; whole numbers
   of each configuration are taken.
3. Actual pieces take the places, by rank within their group.  Sequences with
   equal contents are one run of the plan, so what room they have left is known
   exactly.
4. The large pieces that whole numbers left over and all small ones go, longest
   first, into the least room that is enough; a new sequence opens where none is.

A plan row says: pieces of ``length`` with ranks ``low`` to ``high`` lie at
``offset`` of the sequences from ``first`` on, one in each.  Ranks come from
counts per (task, length), so every piece finds its place by itself and nothing
but counts is shuffled with the light rows of the pieces.

Cases: null and empty texts are the end id alone; repeated rows are packed
each; texts of any length are cut, nothing is dropped; equal lengths are ranked
by where they lie in the written table; other columns are ignored; null ids are
carried; an empty table gives no piece.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kestrel.llm.packing import word_ids
from kestrel.session import ensure_shipped, scratch_path

GROUPS, SMALL = 256, 3
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("ids", pa.binary()), ("part", pa.int64()), ("nth", pa.int64())])
_PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part long, nth long"


def _configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = 2000, slack: float = 1e-4) -> list[tuple[np.ndarray, float]]:
    """(number of each size, how many sequences) of a near-optimal fractional
    packing: the simplex method over columns found by a knapsack of the duals."""
    m = len(sizes)
    columns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1 / np.diag(columns))
    amount = inverse @ counts
    most = int(capacity // sizes.min())
    for _ in range(rounds):
        duals = inverse.sum(axis=0)  # each column costs one sequence
        value = np.zeros(capacity + 1)
        chosen = np.full((most, capacity + 1), -1)
        for t in range(most):  # the best value with one more piece
            more = value.copy()
            for g in range(m):
                w = int(sizes[g])
                gain = value[:capacity + 1 - w] + duals[g]
                better = gain > more[w:] + 1e-12
                more[w:][better] = gain[better]
                chosen[t, w:][better] = g
            value = more
        if value[capacity] <= 1 + slack:
            break  # no column can lower the total by more than this share
        column, room = np.zeros(m), capacity
        for t in range(most - 1, -1, -1):
            g = chosen[t, room]
            if g >= 0:
                column[g] += 1
                room -= int(sizes[g])
        step = inverse @ column
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        theta = ratio[out]
        amount = np.maximum(amount - theta * step, 0)
        amount[out] = theta
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        columns[:, out] = column
    return [(columns[:, k].astype(int), float(amount[k])) for k in range(m)]


class _Plan:
    """Plan rows, and open sequences as runs of equal room."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rows: list[tuple[int, int, int, int, int]] = []  # length, low, high, first, offset
        self.room: dict[int, list[tuple[int, int]]] = {}  # room left: runs of (first sequence, how many)
        self.rooms: list[int] = []
        self.sequences = 0

    def open(self, first: int, n: int, room: int) -> None:
        if room not in self.room:
            self.room[room] = []
            bisect.insort(self.rooms, room)
        runs = self.room[room]
        if runs and runs[-1][0] + runs[-1][1] == first:
            first, n = runs[-1][0], runs.pop()[1] + n
        runs.append((first, n))

    def put(self, length: int, low: int, n: int) -> None:
        """Pieces of equal length, best fit."""
        while n:
            at = bisect.bisect_left(self.rooms, length)
            if at == len(self.rooms):
                new = -(-n // (self.capacity // length))
                self.open(self.sequences, new, self.capacity)
                self.sequences += new
                continue
            room = self.rooms[at]
            runs = self.room[room]
            first, many = runs.pop()
            if many > n:
                runs.append((first + n, many - n))
            elif not runs:
                del self.room[room], self.rooms[at]
            t = min(many, n)
            self.rows.append((length, low, low + t, first, self.capacity - room))
            self.open(first, t, room - length)
            low, n = low + t, n - t


def plan(histogram: dict[int, int], capacity: int, groups: int = GROUPS, small: int = SMALL) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """((length, low, high, first, offset) rows, number of sequences) for so
    many pieces of each length."""
    p = _Plan(capacity)
    if histogram.get(capacity):
        p.rows.append((capacity, 0, histogram[capacity], 0, 0))
        p.sequences = histogram[capacity]
    lengths = sorted((x for x in histogram if histogram[x] and x < capacity), reverse=True)
    large = [x for x in lengths if x * small > capacity]
    total = sum(histogram[x] for x in large)
    used = dict.fromkeys(lengths, 0)  # ranks that have a place
    if total:
        # groups by rank in descending length: equal cardinality, whatever the ties
        ends = [total * (k + 1) // min(groups, total) for k in range(min(groups, total))]
        starts = np.cumsum([0] + [histogram[x] for x in large])

        def length_runs(a: int, b: int) -> Iterator[tuple[int, int, int]]:
            """(length, rank within it, how many) of the ranks a to b."""
            k = int(np.searchsorted(starts, a, side="right")) - 1
            while a < b:
                n = min(b, int(starts[k + 1])) - a
                if n:
                    yield large[k], a - int(starts[k]), n
                a, k = a + n, k + 1

        spans = list(zip([0, *ends], ends))
        merged: dict[int, list[list[int]]] = {}  # groups of one rounded length are one size
        for a, b in spans:
            size = large[int(np.searchsorted(starts, a, side="right")) - 1]
            spans_of = merged.setdefault(size, [])
            if spans_of and spans_of[-1][1] == a:
                spans_of[-1][1] = b
            else:
                spans_of.append([a, b])
        sizes = np.array(list(merged), np.int64)
        begin, end = np.array([v[0][0] for v in merged.values()]), np.array([v[-1][1] for v in merged.values()])
        nxt = begin.copy()
        for config, amount in _configurations(sizes, (end - begin).astype(float), capacity):
            n = int(amount + 1e-6)
            n = min([n, *((end - nxt)[config > 0] // config[config > 0])]) if config.any() else 0
            if not n:
                continue
            # places of the configuration: runs of sequences with equal contents so far
            runs = [(p.sequences, int(n), 0)]
            p.sequences += int(n)
            for g in np.flatnonzero(config):
                for _ in range(config[g]):
                    pieces = list(length_runs(int(nxt[g]), int(nxt[g] + n)))
                    nxt[g] += n
                    cut, k = [], 0
                    length, low, left = pieces[0]
                    for first, many, fill in runs:
                        while many:
                            if not left:
                                k += 1
                                length, low, left = pieces[k]
                            t = min(many, left)
                            p.rows.append((length, low, low + t, first, fill))
                            cut.append((first, t, fill + length))
                            first, many, low, left = first + t, many - t, low + t, left - t
                    runs = cut
            for first, many, fill in runs:
                p.open(first, many, capacity - fill)
        rest = [run for a, b in zip(nxt, end) for run in length_runs(int(a), int(b))]
        for length, low, n in sorted(rest, reverse=True):
            p.put(length, low, n)
    for length in lengths:
        if length * small <= capacity:
            p.put(length, 0, histogram[length])
    return p.rows, p.sequences


def group_pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, groups: int = GROUPS, small: int = SMALL,
               id_col: str = "doc_id", text: str = "text", keep_ids: bool = True, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset and, with ``keep_ids``, ids (little-endian uint32)."""
    spark = docs.sparkSession
    ensure_shipped(spark)
    path = path or scratch_path(spark, "group-packing")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        tok, nth = word_ids(tokenizer_path), np.zeros(capacity + 1, np.int64)
        end, rows = np.array([end_id], np.uint32), []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)

        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), tok.ids(b.column(1))):
                raw = np.concatenate([ids, end]).astype("<u4").tobytes()
                for k, a in enumerate(range(0, len(raw), 4 * capacity)):
                    piece = raw[a:a + 4 * capacity]
                    n = len(piece) // 4
                    rows.append((doc, k, a // 4, n, zlib.crc32(piece), piece if keep_ids else None, part, int(nth[n])))
                    nth[n] += 1
                if len(rows) >= 8192:
                    yield flush()
                    rows = []
        if rows:
            yield flush()

    docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        cut, _PIECES_DDL).write.parquet(f"{path}/pieces")
    pieces = spark.read.schema(_PIECES_DDL).parquet(f"{path}/pieces")

    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts.select("part", "length", "n", F.coalesce(before, F.lit(0)).alias("before")).write.parquet(f"{path}/counts")
    counts = spark.read.schema("part long, length long, n long, before long").parquet(f"{path}/counts")
    # at most ``capacity`` rows
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows, _ = plan(histogram, capacity, groups, small)
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    shipped = spark.sparkContext.broadcast(table)  # bounded by capacity and groups, not by the corpus

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shipped.value
        keys = (t[:, 0] << 48) + t[:, 1]
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            row = t[np.searchsorted(keys, (length << 48) + rank, side="right") - 1]
            keep = [b.column(b.schema.get_field_index(f.name)) for f in list(_PIECES)[:6]]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])],
                                             names=[*_PIECES.names[:6], "sequence_id", "offset"])

    ranked = pieces.join(counts.select("part", "length", "before"), ["part", "length"]).select(
        *_PIECES.names[:6], (F.col("before") + F.col("nth")).alias("rank"))
    out = ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long")
    return out if keep_ids else out.drop("ids")
