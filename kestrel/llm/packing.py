"""Sequence packing with a bounded set of open windows.

Each partition tokenises its documents and packs them online into windows
of ``capacity`` tokens, at most ``windows`` of them open: a document's
remainder goes into the window it fits best; when it fits none, the fullest
window is topped up with the document's head, emitted, and the rest is
placed again.  Documents of ``capacity`` or more tokens fill whole windows
first.  What is open at the end of a partition (a bounded number of tokens)
is merged over groups of partitions, round by round, until one window at
most is part-filled.

Tokens: ids of a ``tokenizers`` file without special tokens, then ``end_id``.
Where the file drops white space and never joins across it, white-space
separated words are encoded once per worker and looked up (same ids).

Cases: null and empty texts are the end id alone; repeated rows are packed
each; texts of any length are cut, nothing is dropped; null ids are carried
(in a merge round they are ordered by their place, not their id); other
columns are ignored; an empty table gives no piece.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import workercache
from kestrel.session import ensure_shipped, scratch_path

WORDS_KEPT = 1_000_000
BYTES_AT_ONCE = 3 << 20
FIRST_FAN, FAN = 4, 16  # partitions, then groups, that merge their open windows
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "ids binary, open boolean, part long")
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                    ("ids", pa.binary()), ("open", pa.bool_()), ("part", pa.int64())])
_STOPS = tuple(".,;:!?")
_ODD_SPACE = "[\x1c-\x1f]"  # split by Arrow, not by the vocabulary's pattern


def _drops_white_space(spec: dict) -> bool:
    """True if ids are those of the white-space separated words in a row."""
    norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    norms = norm.get("normalizers", [norm] if norm else [])
    steps = pre.get("pretokenizers", [pre] if pre else [])
    if not steps or any(n["type"] not in ("NFC", "Lowercase", "Replace") for n in norms):
        return False
    if any(n["type"] == "Replace" and (n["pattern"], n["content"]) != ({"Regex": "\\s+"}, " ") for n in norms):
        return False
    s = steps[0]
    pattern = s.get("pattern", {}).get("Regex", " ").replace("[^\\s", "")
    return (s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"] and "\\s" not in pattern and " " not in pattern
            and all(x["type"] == "ByteLevel" and not x.get("use_regex") and not x.get("add_prefix_space") for x in steps[1:])
            and not any(re.search(r"\s", a["content"]) or a.get("lstrip") or a.get("rstrip") or a.get("single_word") for a in spec.get("added_tokens", [])))


class WordIds:
    """Token ids of texts by one vocabulary file, words looked up."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        run = getattr(t, "encode_batch_fast", t.encode_batch)
        self.encode = lambda texts: [x.ids for x in run(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_word = _drops_white_space(spec)
        special = [a for a in spec.get("added_tokens", []) if a.get("special")]
        self.fence = (special[-1]["content"], special[-1]["id"]) if special else None
        suffix = spec["model"].get("end_of_word_suffix")
        vocab = t.get_vocab(with_added_tokens=False)
        self.ends = None  # ids that end a pre-token
        if suffix and vocab:
            self.ends = np.zeros(max(t.get_vocab().values()) + 1, bool)
            self.ends[[i for w, i in vocab.items() if w.endswith(suffix)]] = True
        self.lowers = "Lowercase" in json.dumps(spec.get("normalizer"))
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.first, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.flat, self.used = np.zeros(1 << 14, np.uint32), 0

    def _encode_words(self, words: list[str], steps: list[int] | None) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, their number by word).  Words whose number
        of pre-tokens is known go in one string and are told apart by the ids
        that end a pre-token; others are fenced by special tokens, which split
        a text like its ends; both only where the numbers come out right."""
        if steps and self.ends is not None:
            ids = np.array(self.encode([" ".join(words)])[0], np.uint32)
            cuts, last = np.flatnonzero(self.ends[ids]) + 1, np.cumsum(steps)
            if len(cuts) == last[-1] and cuts[-1] == len(ids):
                return ids, np.diff(cuts[last - 1], prepend=0)
        if self.fence and not any(self.fence[0][0] in w for w in words):
            ids = np.array(self.encode([self.fence[0].join(words)])[0], np.uint32)
            cuts = np.flatnonzero(ids == self.fence[1])
            if len(cuts) == len(words) - 1:
                return np.delete(ids, cuts), np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
        ids = self.encode(words)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum())), sizes

    def _at(self, words: list[str]) -> np.ndarray:
        """Places of distinct words in the table, learnt where unknown."""
        if len(self.index) + len(words) > WORDS_KEPT:
            self._clear()
        get = self.index.get
        at = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = np.arange(len(self.index), len(self.index) + len(new))
            need = [words[k] for k in new]
            # letters alone are one pre-token, letters and one stop are two
            steps = [1 if w.isalpha() else 2 if w[-1:] in _STOPS and w[:-1].isalpha() else 0 for w in need]
            order = sorted(range(len(need)), key=lambda k: (steps[k] == 0, self.fence is not None and self.fence[0][0] in need[k]))
            at[new[order]] = at[new].copy()
            self._add([need[k] for k in order], [steps[k] for k in order])
        return at

    def _add(self, words: list[str], steps: list[int]) -> None:
        plain = sum(k > 0 for k in steps)
        odd = plain + sum(self.fence is None or self.fence[0][0] not in w for w in words[plain:])
        for lo, hi in ((0, plain), (plain, odd), (odd, len(words))):
            for a in range(lo, hi, 8192):
                self._store(words[a:min(a + 8192, hi)], steps[a:min(a + 8192, hi)] if hi == plain else None)

    def _store(self, words: list[str], steps: list[int] | None) -> None:
        ids, sizes = self._encode_words(words, steps)
        n = len(self.index)
        while n + len(words) > len(self.first):
            self.first, self.size = np.resize(self.first, 2 * len(self.first)), np.resize(self.size, 2 * len(self.size))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.size[n:n + len(words)] = sizes
        self.first[n:n + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.index.update(zip(words, range(n, n + len(words))))

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text (null: none), some megabytes at a time."""
        texts = pc.fill_null(texts, "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BYTES_AT_ONCE, side="right")))
            yield from self._ids(texts.slice(a, b - a))
            a = b

    def _ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        if not self.by_word or pc.any(pc.match_substring_regex(texts, _ODD_SPACE)).as_py():
            yield from (np.array(x, np.uint32) for x in self.encode(texts.to_pylist()))
            return
        if self.lowers and not (self.fence and pc.any(pc.match_substring(texts, self.fence[0][:2])).as_py()):
            texts = pc.ascii_lower(texts)  # the vocabulary does so too: fewer distinct words
        words = pc.utf8_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        at = self._at(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        size = self.size[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        shift = self.first[at] - ends[:-1]
        flat = self.flat[np.repeat(shift, size) + np.arange(ends[-1])]
        offsets = words.offsets.to_numpy()
        cuts = ends[offsets - offsets[0]]
        for i in range(len(texts)):
            yield flat[cuts[i]:cuts[i + 1]]


def word_ids(path: str) -> WordIds:
    return workercache.kept(("packing", path), lambda: WordIds(path))


class Windows:
    """At most ``limit`` open windows; ``done`` collects emitted ones, each a
    list of (key, start, ids): ids of document ``key`` from ``start``."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.free: list[tuple[int, int]] = []  # (tokens free, window number), ascending
        self.open: dict[int, list] = {}
        self.number = 0
        self.done: list[list] = []

    def _put(self, i: int, key, start: int, ids: np.ndarray) -> None:
        """Into the window at place i of ``free``."""
        free, w = self.free.pop(i)
        self.open[w].append((key, start, ids))
        if free == len(ids):
            self.done.append(self.open.pop(w))
        else:
            bisect.insort(self.free, (free - len(ids), w))

    def place(self, key, start: int, ids: np.ndarray) -> None:
        while len(ids) >= self.capacity:
            self.done.append([(key, start, ids[:self.capacity])])
            start, ids = start + self.capacity, ids[self.capacity:]
        while len(ids):
            i = bisect.bisect_left(self.free, (len(ids), -1))
            if i < len(self.free):  # best fit: the least room that is enough
                self._put(i, key, start, ids)
                return
            if len(self.open) < self.limit:
                self.open[self.number] = []
                bisect.insort(self.free, (self.capacity, self.number))
                self.number += 1
                continue
            room = self.free[0][0]  # the fullest leaves, topped up
            self._put(0, key, start, ids[:room])
            start, ids = start + room, ids[room:]

    def merge(self) -> None:
        """Join the open windows until one at most is part-filled."""
        left = [p for _, w in sorted(self.free) for p in self.open[w]]
        self.open, self.free, self.limit = {}, [], 1
        for key, start, ids in left:
            self.place(key, start, ids)


def _rows(windows: list[list], first_id: int, part: int, is_open: bool, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    for w, pieces in enumerate(windows):
        at = 0
        for (doc, total), start, ids in pieces:
            raw = ids.astype("<u4").tobytes()
            rows.append((doc, start, len(ids), zlib.crc32(raw), total, first_id + w, at,
                         raw if keep_ids or is_open else None, is_open, part))
            at += len(ids)
        if len(rows) >= 8192:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, windows: int = 16, end_id: int = 2,
                   id_col: str = "doc_id", text: str = "text", keep_ids: bool = True,
                   path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, with ``keep_ids``, ids (little-endian uint32)."""
    spark = docs.sparkSession
    ensure_shipped(spark)
    path = path or scratch_path(spark, "packing")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        tok, open_set, emitted = word_ids(tokenizer_path), Windows(capacity, windows), 0
        end = np.array([end_id], np.uint32)
        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), tok.ids(b.column(1))):
                ids = np.concatenate([ids, end])
                open_set.place((doc, len(ids)), 0, ids)
                if len(open_set.done) >= 256:
                    yield from _rows(open_set.done, (part << 24) + emitted, part, False, keep_ids)
                    emitted += len(open_set.done)
                    open_set.done = []
        yield from _rows(open_set.done, (part << 24) + emitted, part, False, keep_ids)
        yield from _rows([open_set.open[w] for _, w in open_set.free], 0, part, True, keep_ids)

    def merger(round_no: int, last: bool):
        def merge(t: pa.Table) -> pa.Table:
            group = int(t.column("part")[0].as_py())
            t = t.sort_by([(c, "ascending") for c in ("sequence_id", "offset", "doc_id", "start", "ids_crc32")])
            again = Windows(capacity, windows)
            for doc, total, start, raw in zip(*(t.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "start", "ids"))):
                again.place((doc, total), start, np.frombuffer(raw, "<u4"))
            again.merge()
            rest = [again.open[w] for _, w in again.free]
            first = (round_no << 56) + (group << 24)
            full = again.done + (rest if last else [])
            out = [*_rows(full, first, group, False, keep_ids), *_rows([] if last else rest, first + len(full), group, True, keep_ids)]
            return pa.Table.from_batches(out, schema=_ARROW)
        return merge

    docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        pack, PIECES).write.parquet(f"{path}/0")
    tables = [spark.read.schema(PIECES).parquet(f"{path}/0")]
    groups = (tables[0].agg(F.max("part")).first()[0] or 0) + 1
    fan, last = FIRST_FAN, False
    while not last:
        groups, last = -(-groups // fan), groups <= fan
        left = tables[-1].where("open").withColumn("part", F.floor(F.col("part") / fan).cast("long"))
        left.groupBy("part").applyInArrow(merger(len(tables), last), PIECES).write.parquet(f"{path}/{len(tables)}")
        tables.append(spark.read.schema(PIECES).parquet(f"{path}/{len(tables)}"))
        fan = FAN
    pieces = tables[0].where("not open")
    for t in tables[1:]:
        pieces = pieces.unionByName(t.where("not open"))
    return pieces.drop("open", "part", *([] if keep_ids else ["ids"]))
