"""Alignment of two tokenizers' tokens over the same text.

Texts are shuffled by their full text, so each distinct text is tokenised and
aligned once; its number of rows weighs what it adds to the corpus counts, and
its measures are joined to the rows by the text's digest.

Alignment: both tokenizers' tokens cut the same bytes (a space, then the text).
Places where tokens of both end close a group; a link is a pair of tokens whose
bytes overlap, one for each stretch between neighbouring ends of either side.
Texts that one of them does not give back byte for byte have no tokens.

Where neither side has tokens across a space, a text is a row of pieces between
single spaces, aligned once per worker and looked up; other texts are one piece.

Counts of linked pairs need the whole corpus.  Blocks of texts (some megabytes)
are written with their distinct pairs; the blocks' counts are summed, and each
block asks for its own pairs' totals only, so nothing grows with the number of
pairs: not a broadcast, and no row for each link is ever shuffled.

Cases: null and empty texts and texts that do not round-trip have zeros and an
empty ``groups_sha256``; repeated rows are aligned once; null ids are carried;
other columns pass through unless named like a result; an empty table gives an
empty table.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import workercache
from kestrel.session import ensure_shipped, scratch_path

PIECES_KEPT, LONGEST_KEPT = 250_000, 200
BLOCK_BYTES, GROUP_BYTES = 4 << 20, 4 << 20
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
_UNSAFE = re.compile(r"\s | \s|^ | $")
_BLOCKS = pa.schema([("block", pa.int64()), ("digests", pa.list_(pa.binary())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())),
                     ("n_groups", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())), ("sha", pa.list_(pa.string())),
                     ("text_ends", pa.binary()), ("text_pieces", pa.binary()), ("piece_ends", pa.binary()), ("piece_pairs", pa.binary()),
                     ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
_BLOCKS_DDL = ("block long, digests array<binary>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, sha array<string>, "
               "text_ends binary, text_pieces binary, piece_ends binary, piece_pairs binary, pairs array<long>, counts array<long>")
_RESULT = pa.schema([("digest", pa.binary()), *[(m, pa.int64()) for m in MEASURES], ("groups_sha256", pa.string())])
_RESULT_DDL = "digest binary, " + ", ".join(f"{m} long" for m in MEASURES) + ", groups_sha256 string"


def _byte_level(vocab: dict[str, int]) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary: printable Latin-1
    characters stand for themselves, other bytes for characters from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in byte_of.values())}
    out = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        out[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    return out


def _spread(flat: np.ndarray, first: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The stretches ``at`` of ``flat``, one after another."""
    n = size[at]
    ends = np.cumsum(n)
    return flat[np.repeat(first[at] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)]


class _Strings:
    """Byte strings by number, in one flat array."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(b) for b in strings], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(strings), np.uint8)

    def joined(self, at: np.ndarray) -> np.ndarray:
        return _spread(self.flat, self.first, self.size, at)


class Side:
    """One tokenizer: ids of texts without special tokens, and ids' bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if path.endswith(".model"):
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            n = sp.get_piece_size()
            pieces = [sp.id_to_piece(i) for i in range(n)]
            self.bytes = _Strings([bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])
            self.encode: Callable[[list[str]], list[list[int]]] = lambda texts: sp.encode(texts, num_threads=1)  # adds the space
            self.by_piece = not any(re.search("[^▁]▁", p) for p in pieces)
        else:
            import json

            from tokenizers import Tokenizer
            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            t.encode_special_tokens = True
            run = getattr(t, "encode_batch_fast", t.encode_batch)
            self.encode = lambda texts: [x.ids for x in run([" " + x for x in texts], add_special_tokens=False)]
            self.bytes = _Strings(_byte_level(t.get_vocab(with_added_tokens=True)))
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            pre = spec.get("pre_tokenizer") or {}
            self.by_piece = (pre.get("type") == "ByteLevel" and bool(pre.get("use_regex", True)) and not pre.get("add_prefix_space")
                             and spec.get("normalizer") is None)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, the bytes each text's ids stand for)."""
        found = self.encode(texts)
        n = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for x in found for i in x), np.int64, int(n.sum()))
        ends = np.concatenate([[0], np.cumsum(self.bytes.size[flat])])
        cuts = np.concatenate([[0], np.cumsum(n)])
        return flat, np.diff(ends[cuts])


class Aligner:
    """Aligns texts; a linked pair is A's id << 32 | B's id."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Side(path_a), Side(path_b)
        self.by_piece = self.a.by_piece and self.b.by_piece
        self.decimals = _Strings([b"%d" % i for i in range(max(len(self.a.bytes.size), len(self.b.bytes.size)))])

    def align(self, texts: list[str], pieces: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows of n_a, n_b, number of pairs, bytes of groups; pairs; groups,
        each closed by ``;``), zeros for texts without tokens.  ``pieces``: the
        texts hold no space and no token reaches from one to the next, so all
        are encoded as one text."""
        raw = [b" " + x.encode() for x in texts]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        body = np.frombuffer(b"".join(raw), np.uint8)
        out = np.zeros((len(texts), 4), np.int64)
        valid = None
        if pieces and texts:
            ids = [side.ids([" ".join(texts)])[0] for side in (self.a, self.b)]
            if all(np.array_equal(side.bytes.joined(x), body) for side, x in zip((self.a, self.b), ids)):
                valid = np.ones(len(texts), bool)
        if valid is None:
            found = [side.ids(texts) for side in (self.a, self.b)]
            valid = (found[0][1] == size) & (found[1][1] == size) & (size > 1)
            ids = []
            starts = np.cumsum(size) - size
            for side, (flat, held) in zip((self.a, self.b), found):  # byte by byte, where the lengths agree
                ends = np.cumsum(side.bytes.size[flat])
                of = np.searchsorted(np.cumsum(held), ends, side="left")  # each id's text
                keep = np.flatnonzero(valid)
                mine = side.bytes.joined(flat[valid[of]])
                want = _spread(body, starts, size, keep)
                wrong = np.flatnonzero(mine != want)
                if len(wrong):
                    valid[keep[np.searchsorted(np.cumsum(size[keep]), wrong, side="right")]] = False
                ids.append((flat, of))
            ids = [flat[valid[of]] for flat, of in ids]
        if not valid.any():
            return out, np.empty(0, np.int64), np.empty(0, np.uint8)
        a, b = ids
        ends = np.cumsum(size[valid])
        ends_a, ends_b = np.cumsum(self.a.bytes.size[a]), np.cumsum(self.b.bytes.size[b])
        mark = np.zeros(int(ends[-1]) + 1, np.uint8)
        mark[ends_a] = 1
        mark[ends_b] += 2
        cut = np.flatnonzero(mark)  # every stretch between ends is one link
        kind = mark[cut].astype(np.int64)
        one, two = kind & 1, kind >> 1
        pairs = a[np.cumsum(one) - one] << 32 | b[np.cumsum(two) - two]
        both = cut[kind == 3]
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        last_a, last_b = np.diff(group_a, append=-1) != 0, np.diff(group_b, append=-1) != 0
        # a group's A ids come before its B ids
        number, mark_after = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.uint8)
        place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a, side="left")
        place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")
        number[place_a], number[place_b] = a, b
        mark_after[place_a] = np.where(last_a, ord("|"), ord(","))
        mark_after[place_b] = np.where(last_b, ord(";"), ord(","))
        written = np.cumsum(self.decimals.size[number] + 1)
        text = np.empty(int(written[-1]), np.uint8)
        digit = np.ones(len(text), bool)
        digit[written - 1] = False
        text[written - 1], text[digit] = mark_after, self.decimals.joined(number)
        per = [np.diff(np.searchsorted(e, ends, side="right"), prepend=0) for e in (ends_a, ends_b, cut)]
        out[valid, 0], out[valid, 1], out[valid, 2] = per
        out[valid, 3] = np.diff(written[np.cumsum(per[0] + per[1]) - 1], prepend=0)
        return out, pairs, text


class _Table:
    """Aligned pieces of a worker, in flat arrays."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.n = 0
        self.numbers = np.zeros((1 << 12, 4), np.int64)  # n_a, n_b, number of pairs (0: no tokens), bytes of groups
        self.first = np.zeros((1 << 12, 2), np.int64)  # of the pairs and of the groups
        self.pairs, self.used = np.zeros(1 << 14, np.int64), 0
        self.groups, self.written = np.zeros(1 << 16, np.uint8), 0

    def _store(self, numbers: np.ndarray, pairs: np.ndarray, groups: np.ndarray) -> None:
        n = len(numbers)
        while self.n + n > len(self.numbers):
            self.numbers, self.first = (np.resize(x, (2 * len(x), x.shape[1])) for x in (self.numbers, self.first))
        while self.used + len(pairs) > len(self.pairs):
            self.pairs = np.resize(self.pairs, 2 * len(self.pairs))
        while self.written + len(groups) > len(self.groups):
            self.groups = np.resize(self.groups, 2 * len(self.groups))
        self.numbers[self.n:self.n + n] = numbers
        self.first[self.n:self.n + n, 0] = self.used + np.cumsum(numbers[:, 2]) - numbers[:, 2]
        self.first[self.n:self.n + n, 1] = self.written + np.cumsum(numbers[:, 3]) - numbers[:, 3]
        self.pairs[self.used:self.used + len(pairs)] = pairs
        self.groups[self.written:self.written + len(groups)] = groups
        self.n, self.used, self.written = self.n + n, self.used + len(pairs), self.written + len(groups)

    def places(self, texts: list[str], pieces: bool) -> np.ndarray:
        """Where the alignments of distinct texts lie; the table only grows until ``fit``."""
        get = self.index.get
        at = np.fromiter((get(w, -1) for w in texts), np.int64, len(texts)) if pieces else np.full(len(texts), -1)
        new = np.flatnonzero(at < 0)
        at[new] = self.n + np.arange(len(new))
        need = [texts[k] for k in new]
        for k in range(0, len(need), 8192 if pieces else 16):
            self._store(*self.aligner.align(need[k:k + (8192 if pieces else 16)], pieces))
        if pieces:
            self.index.update((w, k) for w, k in zip(need, at[new].tolist()) if len(w) <= LONGEST_KEPT)
        return at

    def fit(self) -> None:
        """Between blocks: forget all when too much is held."""
        if self.n > PIECES_KEPT or self.used > 16 * PIECES_KEPT:
            self._clear()


def table(path_a: str, path_b: str) -> _Table:
    return workercache.kept(("alignment", path_a, path_b), lambda: _Table(Aligner(path_a, path_b)))


def _block(t: _Table, texts: list[str], rows: list[int], digests: list[bytes], number: int) -> dict:
    """One block: its texts' numbers, their pieces and the pieces' pairs."""
    t.fit()
    whole = np.array([not t.aligner.by_piece or bool(_UNSAFE.search(x)) for x in texts])
    cut = pc.split_pattern(pa.array([None if w else x for x, w in zip(texts, whole)], pa.string()), " ")
    coded = cut.flatten().dictionary_encode()
    at = t.places(coded.dictionary.to_pylist(), True)[coded.indices.to_numpy()]
    lone = t.places([x for x, w in zip(texts, whole) if w], False)
    per_text = np.where(whole, 1, pc.fill_null(pc.list_value_length(cut), 0).to_numpy(zero_copy_only=False)).astype(np.int64)
    ends = np.cumsum(per_text)
    places = np.empty(int(ends[-1]), np.int64)
    alone = np.zeros(len(places), bool)
    alone[(ends - 1)[whole]] = True
    places[alone], places[~alone] = lone, at
    used, local = np.unique(places, return_inverse=True)
    numbers = t.numbers[used]
    valid = np.logical_and.reduceat(numbers[local, 2] > 0, ends - per_text)  # each text has a piece
    # the pieces' pairs, as places among the block's distinct pairs
    size = numbers[:, 2]
    piece_ends = np.cumsum(size)
    pairs, of = np.unique(_spread(t.pairs, t.first[:, 0], t.numbers[:, 2], used), return_inverse=True)
    weight = np.zeros(len(used), np.int64)
    np.add.at(weight, local, np.repeat(np.where(valid, rows, 0), per_text))
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, of, np.repeat(weight, size))
    sums = {c: np.where(valid, np.add.reduceat(numbers[local, k], ends - per_text), 0) for c, k in (("n_a", 0), ("n_b", 1), ("n_links", 2))}
    # the texts' groups, some megabytes at a time
    written = np.add.reduceat(numbers[local, 3], ends - per_text)
    so_far = np.cumsum(written)
    sha, a = [], 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(so_far, (so_far[a - 1] if a else 0) + GROUP_BYTES, side="right")))
        groups = memoryview(_spread(t.groups, t.first[:, 1], t.numbers[:, 3], places[ends[a] - per_text[a]:ends[b - 1]]))
        at = 0
        for ok, n in zip(valid[a:b].tolist(), written[a:b].tolist()):
            sha.append(hashlib.sha256(groups[at:at + n - 1]).hexdigest() if ok else "")
            at += n
        a = b
    return {"block": number, "digests": digests, "n_a": sums["n_a"], "n_b": sums["n_b"], "n_links": sums["n_links"],
            # stretches between ends: every end of either side once
            "n_groups": sums["n_a"] + sums["n_b"] - sums["n_links"], "sha": sha,
            "text_ends": ends.astype("<i8").tobytes(), "text_pieces": local.astype("<i4").tobytes(),
            "piece_ends": piece_ends.astype("<i8").tobytes(), "piece_pairs": of.astype("<i4").tobytes(), "pairs": pairs, "counts": counts}


def _segment_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[np.concatenate([[0], ends[:-1]])] if len(ends) else ends


def align_texts(texts: DataFrame, path_a: str, path_b: str, path: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``digest`` and measures of each distinct text; ``texts`` has ``body``
    (not null) and ``rows``, its number of rows."""
    spark = texts.sparkSession
    ensure_shipped(spark)
    path = path or scratch_path(spark, "alignment")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        t = table(path_a, path_b)
        body: list[str] = []
        rows: list[int] = []
        size = 0

        def block() -> pa.RecordBatch:
            row = _block(t, body, rows, [hashlib.sha256(x.encode()).digest() for x in body], number)
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in _BLOCKS], schema=_BLOCKS)

        for b in batches:
            for x, n in zip(b.column(0), b.column(1).to_pylist()):
                body.append(x.as_py())
                rows.append(n)
                size += len(body[-1])
                if size >= block_bytes:
                    yield block()
                    body, rows, size, number = [], [], 0, number + 1
        if body:
            yield block()

    texts.select("body", "rows").mapInArrow(blocks, _BLOCKS_DDL).write.parquet(f"{path}/blocks")
    stored = spark.read.schema(_BLOCKS_DDL).parquet(f"{path}/blocks")
    asked = stored.select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "x")).select(
        "block", "place", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    totals = asked.groupBy("pair").agg(F.sum("n").alias("count"))
    totals.write.parquet(f"{path}/pairs")
    totals = spark.read.schema("pair long, count long").parquet(f"{path}/pairs")
    # a row per id of B: as many as its vocabulary has
    best = totals.groupBy(F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")).agg(F.max("count").alias("best"))
    known = totals.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)).join(F.broadcast(best), "b").select(
        "pair", "count", (F.col("count") == F.col("best")).alias("is_best"))
    answers = asked.drop("n").join(known, "pair").select(F.col("block").alias("asker"), "place", "count", "is_best")

    def measure(key: tuple, block: pa.Table, told: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        place = told.column("place").to_numpy()
        count, is_best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        count[place] = told.column("count").to_numpy()
        is_best[place] = told.column("is_best").to_numpy(zero_copy_only=False)
        of, piece_ends, local, ends = (np.frombuffer(row[c], d) for c, d in (
            ("piece_pairs", "<i4"), ("piece_ends", "<i8"), ("text_pieces", "<i4"), ("text_ends", "<i8")))
        tokens = np.array(row["n_a"]) > 0
        sums = [np.where(tokens, _segment_sums(_segment_sums(x[of], piece_ends)[local], ends), 0) for x in (is_best, count)]
        return pa.table([row["digests"], row["n_a"], row["n_b"], row["n_groups"], row["n_links"], *sums, row["sha"]], schema=_RESULT)

    heavy = stored.drop("pairs", "counts")
    return heavy.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(measure, _RESULT_DDL)


def align(df: DataFrame, path_a: str, path_b: str, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Adds n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    spark = df.sparkSession
    outs = (*MEASURES, "groups_sha256")
    body = F.coalesce(df[text].cast("string"), F.lit(""))
    texts = df.select(body.alias("body")).where("body <> ''").groupBy("body").agg(F.count("*").alias("rows"))
    path = scratch_path(spark, "aligned")
    align_texts(texts, path_a, path_b, block_bytes=block_bytes).write.parquet(path)
    found = spark.read.schema(_RESULT_DDL).parquet(path).withColumnRenamed("digest", "__digest")
    rows = df.select(*[df[c] for c in df.columns if c not in (*outs, text)], F.unhex(F.sha2(body, 256)).alias("__digest"))
    joined = rows.join(found, "__digest", "left").drop("__digest")
    return joined.fillna(0, list(MEASURES)).fillna("", ["groups_sha256"])
