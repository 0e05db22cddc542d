"""N-gram Jaccard join: links between all texts whose sets of word n-grams
have a Jaccard similarity of at least a threshold.

Words are the white-space separated parts of the lower-cased text, without
the marks at their ends; a text of 1 to n-1 words has one n-gram of all of
them, a text without words has none and is linked to equal texts alone.

1. One pass over the texts gives each row its set's 128-bit digest and its
   band hashes: MinHash bands whose count and rows follow from the wanted
   recall at the threshold.
2. Rows with equal sets (copies) become one class member; only classes go on.
3. Classes are shuffled on their band hashes.  Of buckets with the same
   members the one of the first band stays.  Buckets are cut into tiles of
   bounded size (chunk x chunk), so no task holds an unbounded bucket.
4. The full n-gram sets of classes that share a bucket (and of no others)
   go to their tiles, where pairs are verified exactly.  A pair belongs to
   the first band in which it meets, so it counts once.  No pair rows are
   made: a tile gives each member's number of links and a spanning forest
   of its linked pairs.
5. Components of the forests are the classes of near copies.

Cases: null text counts as empty; rows that repeat (also with one doc_id)
are copies of each other; null doc_ids take part, a class's id is its
smallest non-null one; extra columns are ignored; an empty table gives an
empty table.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import workercache
from kestrel.llm.components import components
from kestrel.session import ensure_shipped, scratch_path

WORDS_KEPT = 200_000
BYTES_AT_ONCE = 2 << 20
CHUNK_ROWS, CHUNK_GRAMS = 512, 2_000_000


def bands_for(threshold: float, recall: float, rows: int = 4) -> int:
    """Bands of ``rows`` rows so that a pair at the threshold meets with
    probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


class Grams:
    """n-gram sets as sorted unique 64-bit hashes."""

    def __init__(self, n: int):
        self.n = n
        self.words: dict[str, int] = {}
        self.mult = np.random.default_rng(11).integers(1, 1 << 62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    @staticmethod
    def _bare(w: str) -> str:
        a, b = 0, len(w)
        mark = lambda c: unicodedata.category(c)[0] in "PSCZ"
        while a < b and mark(w[a]):
            a += 1
        while b > a and mark(w[b - 1]):
            b -= 1
        return w[a:b] or w

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        split = [t.lower().split() for t in texts]
        need = set().union(*split)
        if len(self.words) + len(need) > WORDS_KEPT:
            self.words.clear()
        for w in need:
            if w not in self.words:
                self.words[w] = xxhash.xxh3_64_intdigest(self._bare(w).encode("utf-8", "surrogatepass"))
        of = self.words.__getitem__
        out = []
        for s in split:
            h = np.fromiter(map(of, s), np.uint64, len(s))
            k = max(1, len(h) - self.n + 1) if len(h) else 0
            g = np.zeros(k, np.uint64)
            for j in range(min(self.n, len(h))):
                g += h[j:j + k] * self.mult[j]
            g ^= g >> np.uint64(29)
            g *= np.uint64(0x9E3779B97F4A7C15)  # a fixed odd mixing constant
            g ^= g >> np.uint64(32)
            out.append(np.unique(g))
        return out


def grams(n: int) -> Grams:
    return workercache.kept(("grams", n), lambda: Grams(n))


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """(len(sets), bands) hashes of non-empty sets."""
    rng = np.random.default_rng(23)
    mult = rng.integers(1, 1 << 62, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 62, bands * rows, dtype=np.uint64)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    first = np.cumsum(sizes) - sizes
    flat = np.concatenate(sets)
    out = np.zeros((len(sets), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(sets), b * 2 + 1, np.uint64)
        for r in range(rows):
            x = flat * mult[b * rows + r]
            x += add[b * rows + r]
            x ^= x >> np.uint64(31)
            low = np.minimum.reduceat(x, first)
            h = (h ^ low) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        out[:, b] = h
    return out


def linked_pairs(a: list[np.ndarray], b: list[np.ndarray] | None, mask: np.ndarray, threshold: float):
    """Index pairs (i of a, j of b) allowed by ``mask`` with Jaccard >= threshold."""
    other = a if b is None else b
    na = np.fromiter(map(len, a), np.int64, len(a))
    nb = np.fromiter(map(len, other), np.int64, len(other))
    mask = mask & (np.minimum(na[:, None], nb[None, :]) >= threshold * np.maximum(na[:, None], nb[None, :]) - 1e-9)
    i, j = np.nonzero(mask)
    if not len(i):
        return i, j
    if len(i) <= 64:
        both = np.fromiter((len(np.intersect1d(a[x], other[y], assume_unique=True)) for x, y in zip(i, j)), np.int64, len(i))
    else:  # 0/1 matrices, some thousand n-grams at a time
        rows = a if b is None else a + other
        flat = np.concatenate(rows)
        _, col, count = np.unique(flat, return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        use = count[col] > 1
        number = np.cumsum(count > 1) - 1
        row, col = row[use], number[col[use]]
        order = np.argsort(col, kind="stable")
        row, col = row[order], col[order]
        inter = np.zeros((len(a), len(other)), np.float32)
        width = 4096
        for c in range(0, int(col[-1]) + 1 if len(col) else 0, width):
            lo, hi = np.searchsorted(col, [c, c + width])
            m = np.zeros((len(rows), width), np.float32)
            m[row[lo:hi], col[lo:hi] - c] = 1
            inter += m[:len(a)] @ (m if b is None else m[len(a):]).T
        both = np.rint(inter[i, j]).astype(np.int64)
    ok = both >= threshold * (na[i] + nb[j] - both) - 1e-9
    return i[ok], j[ok]


def _forest(n: int, pairs) -> list[tuple[int, int]]:
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in pairs:
        rx, ry = find(x), find(y)
        if rx != ry:
            root[rx] = ry
            out.append((x, y))
    return out


def _tile(rows: dict[str, list], band: int, threshold: float) -> Iterator[tuple[bytes, int, bytes | None]]:
    """(key, links, other end of a forest edge) of one tile."""
    keys, copies = rows["key"], rows["copies"]
    sets = [np.frombuffer(x, np.uint64) for x in rows["grams"]]
    meet = np.array(rows["bands"], np.int64)
    left = [k for k, s in enumerate(rows["side"]) if s <= 0]
    right = left if rows["lo"] == rows["hi"] else [k for k, s in enumerate(rows["side"]) if s > 0]
    if not left or not right:
        return
    equal = meet[left][:, None, :] == meet[right][None, :, :]
    own = equal[:, :, band] & (equal.argmax(axis=2) == band)
    if right is left:
        own = np.triu(own, 1)
    i, j = linked_pairs([sets[k] for k in left], None if right is left else [sets[k] for k in right], own, threshold)
    if not len(i):
        return
    x, y = np.array(left)[i], np.array(right)[j]
    weight = np.array(copies)
    links = np.bincount(x, weight[y], len(keys)) + np.bincount(y, weight[x], len(keys))
    for k in np.nonzero(links)[0]:
        yield keys[k], int(links[k]), None
    for p, q in _forest(len(keys), zip(x.tolist(), y.tolist())):
        yield keys[p], 0, keys[q]


def ngram_join(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.99999, band_rows: int = 4,
               id_col: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per input row: doc_id, text_key (MD5 of the text), group
    (equal for near copies), class_id (the group's smallest doc_id) and
    n_links."""
    spark = docs.sparkSession
    ensure_shipped(spark)
    path = path or scratch_path(spark, "ngram-join")
    bands = bands_for(threshold, recall, band_rows)
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), F.unhex(F.md5(body)).alias("text_key"), body.alias("body"))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = grams(n)
        for batch in batches:
            for b in _parts(batch, 2):
                sets = g.sets(b.column(2).to_pylist())
                at = [k for k, s in enumerate(sets) if len(s)]
                got = band_hashes([sets[k] for k in at], bands, band_rows).view(np.int64) if at else np.zeros((0, bands), np.int64)
                # texts without words: equal texts are one class, without bands
                keys: list = [b"-" + x for x in b.column(1).to_pylist()]
                rows: list = [None] * len(sets)
                for k, r in zip(at, got):
                    keys[k], rows[k] = xxhash.xxh3_128_digest(sets[k].tobytes()), r
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(keys, pa.binary()), pa.array([len(s) for s in sets], pa.int32()),
                     pa.array(rows, pa.list_(pa.int64()))], names=["doc_id", "text_key", "key", "size", "bands"])

    texts.mapInArrow(hashes, "doc_id long, text_key binary, key binary, size int, bands array<long>").write.parquet(f"{path}/hashes")
    hashed = spark.read.parquet(f"{path}/hashes")
    (hashed.groupBy("key").agg(
        F.count("*").alias("copies"), F.min("text_key").alias("text_key"), F.min("doc_id").alias("first_id"),
        F.first("size").alias("size"), F.first("bands").alias("bands")).write.parquet(f"{path}/classes"))
    classes = spark.read.parquet(f"{path}/classes")

    # buckets with two or more members; of equal member sets the first band's
    met = classes.select("key", "size", F.posexplode("bands").alias("band", "bucket"))
    member = F.xxhash64("key")
    buckets = (met.groupBy("bucket", "band").agg(
        F.count("*").alias("members"), F.sum(F.col("size").cast("long")).alias("total"),
        F.bit_xor(member).alias("x"), F.sum((member % 1_000_003).cast("long")).alias("s")).where("members > 1")
        .groupBy("members", "total", "x", "s").agg(F.min(F.struct("band", "bucket")).alias("b"))
        .select("b.band", "b.bucket", F.greatest(F.ceil(F.col("members") / CHUNK_ROWS),
                                                 F.ceil(F.col("total") / CHUNK_GRAMS)).cast("int").alias("chunks")))
    chunk = F.pmod(F.xxhash64("key", F.lit(3)), F.col("chunks")).cast("int")
    placed = (met.join(buckets, ["bucket", "band"]).select("key", "bucket", "band", chunk.alias("chunk"),
                                                           F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")))
    placed.select("key", "bucket", "band", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"),
                  F.signum(F.col("chunk") - F.col("other")).cast("int").alias("side")).write.parquet(f"{path}/placed")
    placed = spark.read.schema("key binary, bucket long, band int, lo int, hi int, side int").parquet(f"{path}/placed")

    # the sets of classes that share a bucket: one text of each, copies folded before the shuffle
    wanted = placed.select("key").distinct().join(classes, "key").select("key", "text_key", "copies", "bands")
    one_text = texts.select("text_key", "body").groupBy("text_key").agg(F.first("body").alias("body"))

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = grams(n)
        for batch in batches:
            for b in _parts(batch, 3):
                found = [s.tobytes() for s in g.sets(b.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(found, pa.binary())],
                                                 names=["key", "copies", "bands", "grams"])

    sets = (one_text.join(wanted, "text_key").select("key", "copies", "bands", "body")
            .mapInArrow(full_sets, "key binary, copies long, bands array<long>, grams binary"))
    tile = ["bucket", "lo", "hi"]
    tiles = placed.join(sets, "key").repartition(*tile).sortWithinPartitions(*tile)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        workercache.drop()
        names = ("key", "side", "copies", "bands", "grams")
        now, rows, out = None, {}, []
        for b in batches:
            col = {name: b.column(b.schema.get_field_index(name)).to_pylist() for name in (*names, *tile, "band")}
            for k in range(b.num_rows):
                at = (col["bucket"][k], col["lo"][k], col["hi"][k])
                if at != now:
                    if now is not None:
                        out += _tile(rows, rows["band"], threshold)
                    now, rows = at, {name: [] for name in names} | {"lo": at[1], "hi": at[2], "band": col["band"][k]}
                for name in names:
                    rows[name].append(col[name][k])
            if len(out) > 20_000:
                yield _links(out)
                out = []
        if now is not None:
            out += _tile(rows, rows["band"], threshold)
        if out:
            yield _links(out)

    tiles.mapInArrow(verify, "key binary, links long, other binary").write.parquet(f"{path}/links")
    links = spark.read.schema("key binary, links long, other binary").parquet(f"{path}/links")
    edges = links.where("other is not null").select(F.col("key").alias("a"), F.col("other").alias("b"))
    labels = components(edges, f"{path}/components")
    counted = links.groupBy("key").agg(F.sum("links").alias("links"))
    found = (classes.select("key", "copies", "first_id").join(labels, "key", "left").join(counted, "key", "left")
             .select("key", "copies", "first_id", F.coalesce("label", "key").alias("group"), F.coalesce("links", F.lit(0)).alias("links")))
    # only linked classes share a group: the others are their own smallest id
    shared = found.join(labels.select("key"), "key", "left_semi").groupBy("group").agg(F.min("first_id").alias("class_id"))
    found.join(shared, "group", "left").select(
        "key", "group", F.coalesce("class_id", "first_id").alias("class_id"), (F.col("links") + F.col("copies") - 1).alias("n_links")
    ).write.parquet(f"{path}/found")
    found = spark.read.schema("key binary, group binary, class_id long, n_links long").parquet(f"{path}/found")
    return (hashed.select("doc_id", "text_key", "key").join(found, "key", "left")
            .select("doc_id", "text_key", "group", "class_id", "n_links"))


def _parts(batch: pa.RecordBatch, text_column: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with a bounded number of text bytes (one row at least)."""
    size = pc.binary_length(batch.column(text_column)).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    a = 0
    while a < batch.num_rows:
        start = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, start + BYTES_AT_ONCE, side="right")))
        yield batch.slice(a, b - a)
        a = b


def _links(rows: list[tuple]) -> pa.RecordBatch:
    k, n, o = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(k, pa.binary()), pa.array(n, pa.int64()), pa.array(o, pa.binary())],
                                      names=["key", "links", "other"])
