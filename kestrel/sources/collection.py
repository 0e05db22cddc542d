"""Vector collections: versions of segments, each with a hash directory.

``<root>/collection=<name>/`` holds segments and a manifest.  An append writes
one segment of new rows, then a manifest that names it next to the earlier ones;
the manifest appears by one rename that fails if another version took its place
(the append then starts again).  So a reader sees a whole version, and an append
that dies leaves files no manifest names.

A segment's rows lie in shards by a hash of their id.  The number of shards
follows the rows (linear hashing: any number, not only powers of two), so a shard
has a bounded size and a small append is one file.  Each shard has a bit filter
of its ids; a later append probes the filters and reads the ids of those shards
only where a new id hits.  When segments are many, the smaller half of them
becomes one, so the number of filters to probe stays bounded.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import keep

SHARD_ROWS = 250_000
BITS_PER_ROW, PROBES = 16, 3
MOST_SEGMENTS = 16
_RESERVED = ("collection", "shard")


class _Folder:
    """The manifest versions of one collection, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.path = f"{root.rstrip('/')}/collection={name}"
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path(self.path).getFileSystem(self.conf)

    def _path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def version(self) -> int:
        """The latest version; 0: none."""
        folder = self._path(f"{self.path}/_manifest")
        if not self.fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)]
        return max((int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json")), default=0)

    def segments(self, version: int) -> list[dict]:
        """Path, number of rows and of shards of each segment."""
        if not version:
            return []
        stream = self.fs.open(self._path(f"{self.path}/_manifest/v{version:08d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def commit(self, version: int, segments: list[dict]) -> bool:
        """Makes ``version``, whole or not at all; False if it exists."""
        to, draft = self._path(f"{self.path}/_manifest/v{version:08d}.json"), self._path(f"{self.path}/_manifest/.draft-{uuid.uuid4().hex}")
        out = self.fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(segments).encode()))
        finally:
            out.close()
        fc = self.jvm.org.apache.hadoop.fs
        none = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            fc.FileContext.getFileContext(draft.toUri(), self.conf).rename(self.fs.makeQualified(draft), self.fs.makeQualified(to), none)
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            self.fs.delete(draft, False)
            return False
        return True


def _hash(id_col: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string")), 1)


def linear_shard(h: Column, shards: Column | int) -> Column:
    """Address of a hash among ``shards`` shards: its lowest bits, one more
    where that shard exists already."""
    n = F.lit(shards).cast("long") if isinstance(shards, int) else shards
    power = F.pow(F.lit(2.0), F.ceil(F.log2(n.cast("double")))).cast("long")
    wide = F.pmod(h, power)
    return F.when(wide < n, wide).otherwise(F.pmod(h, F.greatest(F.shiftright(power, 1), F.lit(1).cast("long")))).cast("int")


def _probes(h: Column) -> Column:
    """array<struct<word, mask>>: the bits of an id in its shard's filter."""
    bits = 1 << (SHARD_ROWS * BITS_PER_ROW - 1).bit_length()

    def probe(k: int) -> Column:
        b = F.pmod(F.xxhash64(h, F.lit(k)), F.lit(bits))
        return F.struct(F.shiftright(b, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(b, F.lit(64)).cast("int")).alias("mask"))

    return F.array(*[probe(k) for k in range(PROBES)])


def collection_scan(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Open the latest version of one collection."""
    folder = _Folder(spark, root, name)
    segments = folder.segments(folder.version())
    paths = [f"{folder.path}/{s['path']}/rows" for s in segments] or [folder.path]  # nothing stored: Spark's own error
    return _read(spark, paths, len({s["columns"] for s in segments}) > 1).withColumn("collection", F.lit(name))


def _read(spark: SparkSession, paths: list[str], merge: bool = False) -> DataFrame:
    """Rows of segments or shards (their folders are no partition columns)."""
    return spark.read.option("recursiveFileLookup", True).option("mergeSchema", merge).parquet(*paths)


def _write_segment(rows: DataFrame, folder: _Folder, id_col: str, most: int, dedupe: bool = False,
                   finish: Callable[[DataFrame], DataFrame] | None = None) -> dict:
    """At most ``most`` rows in shards, and the filters of the shards.  Rows are
    dealt once: equal ids (``dedupe``) meet in their shard, and what ``finish``
    makes of a row, its id with it, is made there."""
    spark = rows.sparkSession
    path, shards = f"segment-{uuid.uuid4().hex[:16]}", max(1, -(-most // SHARD_ROWS))
    placed = rows.withColumn("shard", linear_shard(_hash(id_col), shards))
    placed = placed.drop(id_col) if finish else placed
    # a shard is at most one task's file; few rows are one file
    placed = placed.repartition(shards, "shard")
    placed = finish(placed) if finish else placed
    if dedupe:
        placed = placed.dropDuplicates(["shard", id_col])  # lie in one partition already
    placed.write.partitionBy("shard").parquet(f"{folder.path}/{path}/rows")
    columns = [c for c in placed.columns if c != "shard"]
    ids = spark.read.schema(placed.select(id_col, "shard").schema).parquet(f"{folder.path}/{path}/rows")
    n = ids.count()
    bits = ids.select("shard", F.explode(_probes(_hash(id_col))).alias("b"))
    bits = bits.groupBy("shard", F.col("b.word").alias("word")).agg(F.bit_or("b.mask").alias("mask"))
    bits.coalesce(max(1, shards)).write.parquet(f"{folder.path}/{path}/filters")
    return {"path": path, "rows": n, "shards": shards, "columns": ",".join(sorted(columns))}


def _stored_ids(spark: SparkSession, folder: _Folder, segments: list[dict], new: DataFrame, id_col: str) -> DataFrame | None:
    """Ids of ``new`` that may be stored: those of the shards whose filters hit."""
    if not segments:
        return None
    table = F.array(*[F.struct(F.lit(i).alias("segment"), F.lit(s["shards"]).cast("long").alias("shards")) for i, s in enumerate(segments)])  # MOST_SEGMENTS + 1
    asked = new.select(id_col, _hash(id_col).alias("_h")).select(id_col, "_h", F.explode(table).alias("_s"))
    asked = asked.select(id_col, F.col("_s.segment").alias("_segment"), linear_shard(F.col("_h"), F.col("_s.shards")).alias("_shard"), F.posexplode(_probes(F.col("_h"))).alias("_p", "_b"))
    asked = asked.select(id_col, "_segment", "_shard", "_p", F.col("_b.word").alias("_word"), F.col("_b.mask").alias("_mask"))
    filters = None
    for i, s in enumerate(segments):
        one = spark.read.schema("shard int, word long, mask long").parquet(f"{folder.path}/{s['path']}/filters").select(
            F.lit(i).alias("_segment"), F.col("shard").alias("_shard"), F.col("word").alias("_word"), F.col("mask").alias("_bits"))
        filters = one if filters is None else filters.unionByName(one)
    hits = asked.join(filters, ["_segment", "_shard", "_word"]).where(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"))
    # an id may come more than once: which of its probes hit, not how many rows
    hits = hits.groupBy(id_col, "_segment", "_shard").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("_p"))).alias("n"))
    hits = hits.where(F.col("n") == (1 << PROBES) - 1)
    touched = hits.groupBy("_segment", "_shard").agg(F.count("*").alias("n")).collect()  # at most a row a shard
    paths = sorted(f"{folder.path}/{segments[r['_segment']]['path']}/rows/shard={r['_shard']}" for r in touched)
    return _read(spark, paths).select(id_col) if paths else None


def collection_append(rows: DataFrame, root: str, name: str, id_col: str = "id", dedupe: bool = True,
                      finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Create-if-missing and append.  With ``dedupe`` rows whose id is
    already stored are skipped, so re-running an insert is idempotent.
    ``finish`` gives dealt rows (without their id) the same id again and
    further columns, as vectors, that need not travel."""
    spark = rows.sparkSession
    folder = _Folder(spark, root, name)
    held = keep(rows.drop(*_RESERVED))  # probed, then written
    try:
        while True:
            version = folder.version()
            segments = folder.segments(version)
            out = held
            if dedupe:
                old = _stored_ids(spark, folder, segments, held, id_col)
                if old is not None:
                    out = out.join(old, id_col, "left_anti")
            most = out.count()  # equal ids counted each
            if not most and segments:
                return
            segments = [*segments, _write_segment(out, folder, id_col, most, dedupe, finish)]
            if folder.commit(version + 1, segments):
                break
        if len(segments) > MOST_SEGMENTS:
            _merge(spark, folder, version + 1, segments, id_col)
    finally:
        held.unpersist()


def _merge(spark: SparkSession, folder: _Folder, version: int, segments: list[dict], id_col: str) -> None:
    """The smaller half of the segments becomes one, as the next version; if
    another append comes first, it will do so."""
    small = sorted(segments, key=lambda s: s["rows"])[:len(segments) // 2 + 1]
    paths = [f"{folder.path}/{s['path']}/rows" for s in small]
    rows = _read(spark, paths, len({s["columns"] for s in small}) > 1)
    merged = _write_segment(rows, folder, id_col, sum(s["rows"] for s in small))
    folder.commit(version + 1, [*[s for s in segments if s not in small], merged])


def collection_overwrite(rows: DataFrame, root: str, name: str, id_col: str = "id") -> None:
    """Rebuild one collection (e.g. after an embedding-model change): the next
    version names the new rows only; readers of an older version keep it."""
    folder = _Folder(rows.sparkSession, root, name)
    held = keep(rows.drop(*_RESERVED))
    try:
        segment = _write_segment(held, folder, id_col, held.count())
        while not folder.commit(folder.version() + 1, [segment]):
            pass
    finally:
        held.unpersist()
