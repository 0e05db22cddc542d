"""Mixing sources to target weights by a hypergeometric splitting tree.

Sizes are words.  Sources share ``budget`` x all words by weight; a target
stops at ``most`` x its source's size and the excess is shared again by
weight until none is above.  A source's documents form a random stream
(hash order) that is cut into blocks of whole documents; a target is so many
full passes over the blocks and a part of one more, of which the document at
the border is kept if that comes nearer, and a few single documents are
swapped in or out where that closes the rest of the gap.

The exact block quotas of all sources are split among the output shards by a
binary tree: a node with n shards gives its left half a multivariate
hypergeometric draw of its blocks, the right half keeps the rest.  Every
node's draw is seeded by its place, so each shard walks its own root-to-leaf
path in parallel and knows which disjoint run of (per pass permuted) blocks
of each source is its own.  Documents meet their shard by (source, slot),
are ordered locally by a hash, and nothing but one row per source reaches
the driver.

Cases: null source is a source of its own, last in order; null text has size
0; documents of size 0 ride along with full passes and take 0 words; rows
that repeat are drawn each on its own; sources whose size is 0 have target
0; input columns named like the outputs are replaced; an empty table gives
an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kestrel.llm.bitfilter import with_flag
from kestrel.session import ensure_shipped, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
OUTS = ("size", "source_size", "target", "pass", "shard", "position")


def targets(sizes: list[int], weights: list[float], budget: float, most: float) -> list[float]:
    """Weighted shares of budget * sum(sizes), none above most * size."""
    out = [0.0] * len(sizes)
    rest, free = budget * sum(sizes), set(range(len(sizes)))
    while free:
        unit = rest / sum(weights[i] for i in free)
        over = {i for i in free if unit * weights[i] > most * sizes[i]}
        if not over:
            for i in free:
                out[i] = unit * weights[i]
            break
        for i in over:
            out[i] = most * sizes[i]
            rest -= out[i]
        free -= over
    return out


def shard_quotas(totals: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(offset, quota) by source of one shard: its path down the tree."""
    offset, have = np.zeros_like(totals), totals.copy()
    lo, hi = 0, shards
    while hi - lo > 1:
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        total = int(have.sum())
        want = total * (mid - lo) // (hi - lo)
        left, after = np.zeros_like(have), total
        for s in range(len(have)):  # conditional hypergeometric draws
            after -= int(have[s])
            left[s] = rng.hypergeometric(int(have[s]), after, want) if want and have[s] else 0
            want -= int(left[s])
        if shard < mid:
            have, hi = left, mid
        else:
            offset, have, lo = offset + left, have - left, mid
    return offset, have


def permuted(x: Column, m: Column, key: Column) -> Column:
    """A keyed bijection of 0..m-1, another one for each key: Feistel rounds on
    a grid of a x b >= m cells, walking on from cells beyond m (fewer than a
    of them; a walk of over 40 steps raises)."""
    a = F.floor(F.sqrt(m.cast("double"))).cast("long") + 1
    b = F.floor((m + a - 1) / a).cast("long")

    def mixed(v: Column, k: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(v, k, key), 1)

    def turn(s: Column, k: Column) -> Column:
        low = F.pmod(s["l"] + F.pmod(mixed(s["r"], 2 * k), a), a)
        return F.struct(low.alias("l"), F.pmod(s["r"] + F.pmod(mixed(low, 2 * k + 1), b), b).alias("r"))

    def once(v: Column) -> Column:
        start = F.struct(F.floor(v / b).cast("long").alias("l"), F.pmod(v, b).alias("r"))
        return F.aggregate(F.array(*[F.lit(k) for k in range(3)]), start, turn, lambda s: s["l"] * b + s["r"])

    walk = F.aggregate(F.sequence(F.lit(1), F.lit(40)), once(x.cast("long")), lambda v, _: F.when(v < m, v).otherwise(once(v)))
    return F.when(walk < m, walk).otherwise(F.raise_error(F.lit("no place found within the walk")).cast("long"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), budget: float = 1.5, most: float = 2.0,
        source: str = "source", text: str = "text", id_col: str = "doc_id", block_words: int = 1024,
        shard_words: int = 1 << 18, seed: int = 17) -> DataFrame:
    """One row per placement of a document: its columns, size, source_size,
    target, pass (from 0), shard and position in the shard; a document that
    is not drawn has one row with null pass, shard and position.  Sources
    take ``weights`` in turn, by code point, null last.  ``__row`` (a struct)
    is unique per input row.

    Everything is decided on light rows (two hashes of id, source and text,
    and the number of a repeated row); the documents' columns meet the
    placements in one join."""
    spark = docs.sparkSession
    ensure_shipped(spark)
    keep = [c for c in docs.columns if c not in OUTS]
    body, src = F.col(text).cast("string"), F.col(source).cast("string")
    item = [F.xxhash64(F.lit(seed + i), F.col(id_col), src, body).alias(f"__h{i}") for i in (0, 1)]
    numbered = F.row_number().over(Window.partitionBy("__h0", "__h1").orderBy(F.lit(0)))

    path = scratch_path(spark, "mixing")
    (docs.select(src.alias("src"), F.regexp_count(F.coalesce(body, F.lit("")), F.lit(WORD)).cast("long").alias("size"), *item)
     .write.parquet(f"{path}/sizes"))
    sizes = spark.read.parquet(f"{path}/sizes")
    by_source = sizes.groupBy("src").agg(F.sum("size").alias("words"), F.count("*").alias("docs")).collect()
    by_source.sort(key=lambda r: (r["src"] is None, r["src"] or ""))  # str order is code-point order
    if not by_source:
        nothing = [F.lit(None).cast(t).alias(c) for c, t in zip(OUTS, ("long", "long", "double", "int", "int", "long"))]
        return docs.select(*keep, *nothing, F.struct(*item).alias("__row"))
    words = [int(r["words"]) for r in by_source]
    goal = targets(words, [weights[i % len(weights)] for i in range(len(words))], budget, most)
    block = max(block_words, math.ceil(sum(goal) / 100_000_000))
    params = []  # a row for each source
    for i, (r, w, t) in enumerate(zip(by_source, words, goal)):
        per = max(1, min(block, w // 512))  # small sources get finer blocks
        n = max(1, math.ceil(w / per))
        full = int(t // w) if w else 0
        rest = t - full * w
        last = max(1, math.ceil(rest / per)) if rest > 0 else 0
        params.append((r["src"], i, w, t, max(1, math.ceil(r["docs"] / 4096)), per, n, full, float(rest), last))
    p = spark.createDataFrame(params, "src string, sid int, source_size long, target double, buckets long, per long, "
                                      "blocks long, full int, rest double, last long")

    # the random stream of each source: hash order, in buckets
    u = F.shiftrightunsigned("__h0", 1).cast("double") / F.lit(2.0 ** 63)
    light = (sizes.select("*", numbered.alias("__j")).join(p.select("src", "sid", "buckets", "per", "blocks", "rest"), sizes["src"].eqNullSafe(p["src"])).drop("src")
             .withColumn("bucket", F.least(F.floor(u * F.col("buckets")), F.col("buckets") - 1).cast("long")))
    sums = light.groupBy("sid", "bucket").agg(F.sum("size").alias("w"))
    up_to = Window.partitionBy("sid").orderBy("bucket")  # a row for every 4096 documents
    starts = sums.select("sid", "bucket", (F.sum("w").over(up_to) - F.col("w")).alias("before"))
    inside = Window.partitionBy("sid", "bucket").orderBy(F.shiftrightunsigned("__h0", 1), "__h0", "__h1", "__j").rowsBetween(Window.unboundedPreceding, 0)
    stream = light.join(starts, ["sid", "bucket"]).withColumn("start", F.col("before") + F.sum("size").over(inside) - F.col("size"))
    stream.select("sid", "__h0", "__h1", "__j", "size",
                  F.least(F.floor(F.col("start") / F.col("per")).cast("long"), F.col("blocks") - 1).alias("block"),
                  ((F.col("rest") > 0) & (F.col("start") + F.col("size") / 2 <= F.col("rest"))).alias("inside")).write.parquet(f"{path}/stream")
    stream = spark.read.schema("sid int, __h0 long, __h1 long, __j int, size long, block long, inside boolean").parquet(f"{path}/stream")

    # what whole documents leave open, and single documents that close it
    rests = {q[1]: q[8] for q in params if q[8] > 0}
    took = stream.where("inside").groupBy("sid").agg(F.sum("size").alias("w")).collect()
    gaps = rests | {r["sid"]: rests[r["sid"]] - r["w"] for r in took}
    row_id = F.struct("__h0", "__h1", "__j")  # a swap moves one row, not its repeats
    kind_of_id = "struct<__h0:bigint,__h1:bigint,__j:int>"
    flips: dict[int, list[tuple[int, int, int]]] = {}
    for _ in range(4):
        still = [(s, float(g)) for s, g in gaps.items() if abs(g) >= 1]
        if not still:
            break
        done = F.array(*[F.struct(*map(F.lit, x)) for xs in flips.values() for x in xs]).cast(f"array<{kind_of_id}>")
        left = F.abs(F.abs("gap") - F.col("size"))
        best = (stream.join(spark.createDataFrame(still, "sid int, gap double"), "sid")
                .where((F.col("inside") == (F.col("gap") < 0)) & (F.col("size") > 0) & (left < F.abs("gap")))
                .where(~F.array_contains(done, row_id))
                .groupBy("sid").agg(F.min(F.struct(left.alias("left"), "__h0", "__h1", "__j", "size")).alias("b")).collect())
        if not best:
            break
        for r in best:
            flips.setdefault(r["sid"], []).append((r["b"]["__h0"], r["b"]["__h1"], r["b"]["__j"]))
            gaps[r["sid"]] += r["b"]["size"] if gaps[r["sid"]] < 0 else -r["b"]["size"]

    # block quotas, and which run of slots each shard draws
    slots_by = np.array([q[7] * q[6] + q[9] for q in params], np.int64)
    shards = max(1, math.ceil(sum(goal) / shard_words))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard in b.column(0).to_pylist():
                offset, quota = shard_quotas(slots_by, shards, shard, seed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(quota), pa.int32()), pa.array(range(len(quota)), pa.int32()),
                     pa.array(offset, pa.int64()), pa.array(quota, pa.int64())], names=["shard", "sid", "offset", "quota"])

    quotas = spark.range(shards).mapInArrow(leaves, "shard int, sid int, offset long, quota long").where("quota > 0")
    slots = quotas.select("shard", "sid", F.explode(F.sequence("offset", F.col("offset") + F.col("quota") - 1)).alias("slot"))

    # pass k < full: block b sits in slot k * blocks + permuted b; the partial
    # pass runs along the (already random) stream
    # a row for each source; four swaps at most
    more = spark.createDataFrame([(q[1], q[2], q[3], q[6], q[7], q[9], flips.get(q[1], [])) for q in params],
                                 f"sid int, source_size long, target double, blocks long, full int, last long, swaps array<{kind_of_id}>")
    rows = stream.join(more, "sid")
    drawn = F.col("inside") != F.array_contains("swaps", row_id)
    slot_of = lambda k: k * F.col("blocks") + permuted(F.col("block"), F.col("blocks"), F.xxhash64(F.lit(seed), "sid", k))
    kind = "array<struct<pass:int,slot:bigint>>"
    full_passes = F.when(F.col("full") > 0, F.transform(F.sequence(F.lit(0), F.col("full") - 1), lambda k: F.struct(
        k.cast("int").alias("pass"), slot_of(k.cast("long")).alias("slot")))).otherwise(F.array().cast(kind))
    partial = F.when(drawn, F.array(F.struct(F.col("full").cast("int").alias("pass"), (
        F.col("full") * F.col("blocks") + F.least("block", F.col("last") - 1)).cast("long").alias("slot")))).otherwise(F.array().cast(kind))
    rows = rows.withColumn("draw", F.explode_outer(F.concat(full_passes.cast(kind), partial.cast(kind))))
    rows = rows.select("sid", "__h0", "__h1", "__j", "size", "source_size", "target", "draw.pass", "draw.slot")
    # merge: the planner knows nothing of the exploded slots' size
    placed = rows.join(slots.hint("merge"), ["sid", "slot"], "left").drop("sid", "slot")
    # rows that are not drawn have no shard and need no order: anywhere will do
    spread = F.when(F.col("shard").isNull(), F.pmod("__h0", F.lit(4096)))
    local = Window.partitionBy("shard", spread).orderBy(F.xxhash64(F.lit(seed), "shard", "pass", "__h0"), "__h0", "__h1", "__j", "pass")
    placed = placed.withColumn("position", F.when(F.col("shard").isNotNull(), F.row_number().over(local)).cast("long"))

    placed = placed.select("__h0", "__h1", "__j", *OUTS)
    placed.write.parquet(f"{path}/placed")
    placed = spark.read.schema("__h0 long, __h1 long, __j int, size long, source_size long, target double, pass int, shard int, position long").parquet(f"{path}/placed")
    # rows that repeat need their number; the others (no bit set) are the only one of their hashes
    sizes.groupBy("__h0", "__h1").agg(F.count("*").alias("n")).where("n > 1").select("__h0", "__h1").write.parquet(f"{path}/repeats")
    repeats = spark.read.schema("__h0 long, __h1 long").parquet(f"{path}/repeats")
    key, maybe = ["__h0", "__h1"], "__maybe"
    wide = with_flag(docs.select(F.struct(F.lit(0).alias("__0"), *[docs[c] for c in keep]).alias("__in"), *item), repeats, key, maybe)
    placed = with_flag(placed, repeats, key, maybe)
    once = wide.where(~F.col(maybe)).drop(maybe).join(placed.where(~F.col(maybe)).drop(maybe).hint("merge"), key)
    several = wide.where(maybe).drop(maybe).withColumn("__j", numbered).join(placed.where(maybe).drop(maybe), [*key, "__j"])
    out = once.unionByName(several)
    return out.select(*[F.col("__in").getField(c).alias(c) for c in keep], *OUTS, F.struct("__h0", "__h1", "__j").alias("__row"))
