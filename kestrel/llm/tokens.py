"""Token counts with a digest cache.

Every text is reduced to a content digest (SHA-256 of its UTF-8 bytes; null
counts as empty).  The cache is a table of (tokenizer digest, content
digest, n_tokens) in a shared folder; the tokenizer digest covers the
library and the bytes of the vocabulary file.  A run joins its digests with
the stored counts, encodes each distinct missing text once, appends the new
counts and joins every row with its count.

Normalisation is the identity on UTF-8: byte-level vocabularies see every
byte, so any other normal form would change counts.

Shape: one shuffle of the texts, of one row per digest and map task (copies
collapse before it), keyed on the digest; the rows themselves are joined by
their 32-byte digests only.

Cases: null and empty texts have 0 bytes and the library's count for "";
texts of any length are encoded whole; repeated rows are encoded once and
each gets its row back; concurrent appends at worst store a digest twice,
which the reader folds; extra columns pass through; an empty table gives an
empty table.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import workercache
from kestrel.session import ensure_shipped, scratch_path

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"
PIECES_KEPT = 800_000  # pieces whose counts a worker keeps
CHARS_AT_ONCE = 1 << 20
_UNSAFE = re.compile(r"\s | \s|^ | $")


class TokenCounter:
    """Counts of one vocabulary file: ``.json`` by tokenizers, ``.model`` by
    sentencepiece.

    For byte-level files that split words before a space (``piece_split``)
    a text is cut at single spaces between two visible characters.  No
    pre-token spans such a space except as its first character, so the
    pieces' counts add up to the text's, and a piece is encoded once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.pieces: dict[str, int] = {}
        if path.endswith(".model"):
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
            self.piece_split = False
        else:
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            run = getattr(t, "encode_batch_fast", t.encode_batch)
            self.encode = lambda texts: [len(x.ids) for x in run(texts, add_special_tokens=False)]
            import json
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            pre = spec.get("pre_tokenizer") or {}
            self.piece_split = (pre.get("type") == "ByteLevel" and bool(pre.get("use_regex", True))
                                and not pre.get("add_prefix_space") and spec.get("normalizer") is None
                                and not any(a.get("lstrip") or a.get("rstrip") or a.get("single_word") or " " in a["content"]
                                            for a in spec.get("added_tokens", [])))

    def _learn(self, words: set[str]) -> None:
        """Counts of all the given pieces (held without their space)."""
        if len(self.pieces) + len(words) > PIECES_KEPT:
            self.pieces.clear()
        need = [w for w in words if w not in self.pieces]
        for a in range(0, len(need), 4096):
            part = need[a:a + 4096]
            self.pieces.update(zip(part, self.encode([" " + w for w in part])))

    def count(self, texts: list[str]) -> list[int]:
        if not self.piece_split:
            return self.encode(texts) if texts else []
        out, a = [], 0
        while a < len(texts):
            b, chars = a, 0
            while b < len(texts) and (b == a or chars + len(texts[b]) <= CHARS_AT_ONCE):
                chars += len(texts[b])
                b += 1
            out += self._count(texts[a:b])
            a = b
        return out

    def _count(self, texts: list[str]) -> list[int]:
        cut: list[tuple[str, list[str]] | None] = []
        for t in texts:
            if _UNSAFE.search(t):
                cut.append(None)
                continue
            first, *rest = t.split(" ")
            cut.append((first, rest))
        whole = [t for t, c in zip(texts, cut) if c is None]
        whole_counts = iter(self.encode(whole) if whole else [])
        heads = [c[0] for c in cut if c is not None]
        head_counts = iter(self.encode(heads) if heads else [])
        inner: set[str] = set()
        for c in cut:
            if c is not None:
                inner.update(c[1])
        self._learn(inner)
        of = self.pieces.__getitem__
        return [next(whole_counts) if c is None else next(head_counts) + sum(map(of, c[1])) for c in cut]


def tokenizer_digest(path: str) -> str:
    """Library kind and vocabulary bytes."""
    with open(path, "rb") as f:
        return hashlib.sha256(path.rpartition(".")[2].encode() + b"\0" + f.read()).hexdigest()


def counter(path: str) -> TokenCounter:
    return workercache.kept(("tokens", path), lambda: TokenCounter(path))


def stored_counts(spark, cache: str, version: str) -> DataFrame:
    from pyspark.errors import AnalysisException
    try:
        table = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        table = spark.createDataFrame([], CACHE_SCHEMA)
    return table.where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(df: DataFrame, tokenizer_path: str, cache: str | None = None, text: str = "text",
                 limit: int = 512) -> DataFrame:
    """Adds n_bytes, n_tokens and over_limit (n_tokens > limit); new counts
    are appended to ``cache`` (default: a new table in the shared folder)."""
    spark = df.sparkSession
    ensure_shipped(spark)
    cache = cache or scratch_path(spark, "token-counts")
    version = tokenizer_digest(tokenizer_path)
    outs = ("n_bytes", "n_tokens", "over_limit")
    body = F.coalesce(df[text].cast("string"), F.lit(""))
    digest = F.unhex(F.sha2(body, 256))

    # one row per digest and map task reaches the shuffle
    distinct = df.select(digest.alias("digest"), body.alias("body")).groupBy("digest").agg(F.first("body").alias("body"))
    missing = distinct.join(stored_counts(spark, cache, version), "digest", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(tokenizer_path)
        for b in batches:
            n = c.count(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([version] * len(n), pa.string()), b.column(0), pa.array(n, pa.int64())],
                names=["tokenizer", "digest", "n_tokens"])

    missing.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)
    rows = df.select(*[df[c] for c in df.columns if c not in (*outs, text)], digest.alias("__digest"),
                     F.octet_length(body).cast("long").alias("n_bytes"))
    counts = stored_counts(spark, cache, version).withColumnRenamed("digest", "__digest")
    return (rows.join(counts, "__digest", "left").drop("__digest")
            .withColumn("over_limit", F.col("n_tokens") > limit))
