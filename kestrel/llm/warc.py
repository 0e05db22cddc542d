"""WARC archives and an external merge of their capture index.

``write_archives`` writes one record per page through Spark's text sink (a
record is one value, the record separator ``\\r\\n\\r\\n`` is the line
separator), gzip-compressed, into a shared folder: a ``response`` with its
HTTP block, or, where an equal payload of at least ``min_revisit`` bytes is
stored under the largest page id, a ``revisit`` that holds the HTTP headers
only and refers to it.  ``read_archives`` parses the files by their lengths
(never by searching for separators inside payloads), recomputes size and
SHA-1 of every stored payload and fails on a mismatch.

Files are bounded by records and by bytes, and read as a stream, a record at a
time.  Which payloads are shared is decided on digests; only pages whose digest
passes a bit filter of fixed size are shuffled with their bodies.

``merge_index``: every reading task emits its captures as locally sorted
runs, written to the shared folder; the runs are range-partitioned by (URL key,
timestamp, page id, place), and each range is merged k-way by a loser tree.
The number of ranges follows from the number of captures, so a task holds about
``RANGE_ROWS`` of them (no payloads) whatever the size of the whole.  Ranges
come from Spark's own sampled range partitioner on the whole composite key, so
one hot URL is split too, and so are repeated rows.  (range, position) is the global order; ``capture_rank`` numbers
it from 1.

Cases: null html is an empty payload; payloads under ``min_revisit`` bytes
are always responses; rows that repeat the largest page id of their payload
are all responses; null page ids revisit an equal payload that has an id,
else are responses; a null URL leaves out the target URI and has the key
``)``; control characters and spaces are dropped from URLs (header
injection); extra input columns are ignored; an empty table writes no record.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.bitfilter import with_flag
from kestrel.session import ensure_shipped, scratch_path

EPOCH = 1_704_067_200  # 2024-01-01, the capture time of page 0 where no time is given
RUN_ROWS = 50_000
RANGE_ROWS = 200_000  # captures of a range, about: what a merging task holds
CAPTURES = ("page_id long, url string, url_key string, captured string, record_type string, refers_to long, "
            "payload_bytes long, payload_digest string, file string, offset long, length long")
_ORDER = ("url_key", "captured", "page_id", "file", "offset")
_ARROW = pa.schema([(n, pa.int64() if t == "long" else pa.string())
                    for n, t in (c.split() for c in CAPTURES.split(", "))])


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", captured: str | None = None, min_revisit: int = 1000,
                   records_per_file: int = 20_000, bytes_per_file: int = 64 << 20) -> None:
    """Writes the archive files under ``path`` (a shared folder), of at most
    ``records_per_file`` records and about ``bytes_per_file`` bytes."""
    seconds = F.lit(EPOCH) + F.coalesce(F.pmod(F.col("id"), F.lit(1_000_000_000)), F.lit(0))
    when = F.col("at") if captured else F.timestamp_seconds(seconds)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("body"),
                        *([F.col(captured).cast("timestamp").alias("at")] if captured else []))
    rows = rows.withColumns({"n": F.octet_length("body"), "digest": F.sha1("body")})
    # pages with a shared payload are found by their digests; other bodies stay where they are
    spark = pages.sparkSession
    digests = scratch_path(spark, "shared-payloads")
    sizes = rows.groupBy("digest").agg(F.count("*").alias("copies"), F.max("id").alias("first_id"), F.max("n").alias("n"))
    sizes.write.parquet(digests)
    sizes = spark.read.schema("digest string, copies long, first_id long, n long").parquet(digests)
    shared = sizes.where((F.col("copies") > 1) & (F.col("n") >= min_revisit)).select("digest", "first_id")
    flagged = with_flag(rows, shared, ["digest"], "__maybe")
    rows = flagged.where(~F.col("__maybe")).withColumn("first_id", F.lit(None).cast("long")).unionByName(
        flagged.where("__maybe").join(shared, "digest", "left").select(*flagged.columns, "first_id"))
    mean = sizes.agg(F.sum(F.col("n") * F.col("copies")) / F.sum("copies")).first()[0] or 0
    records_per_file = max(1, min(records_per_file, int(bytes_per_file / (mean + 500))))
    rows = rows.withColumn(
        "revisit", F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id")) & (F.col("n") >= min_revisit))
    nl = F.lit("\r\n")
    uri = F.regexp_replace("url", r"[\x00-\x20\x7f]", "")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n").cast("string"), F.lit("\r\n\r\n"))
    ident = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    utc = F.date_format(F.to_utc_timestamp(when, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), ident("id"), F.lit("\r\nWARC-Date: "), F.coalesce(utc, F.lit("")),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), uri), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(F.col("revisit"), F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
            ident("first_id"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length("http") + F.octet_length("stored")).cast("string"), nl, nl)
    rows = rows.withColumns({"http": http, "stored": F.when(F.col("revisit"), "").otherwise(F.col("body"))})
    (rows.select(F.concat(head, "http", "stored").alias("value")).write
     .option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


def url_key(url: str | None) -> str:
    """Reversed host labels, then ``)`` and the rest without its fragment."""
    _, found, rest = (url or "").partition("://")
    rest = rest.partition("#")[0] if found else ""
    end = min((i for i in (rest.find(c) for c in "/?") if i >= 0), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    return ",".join(reversed(host.split("."))) + ")" + rest[end:]


def inflated(data: pa.Buffer | bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """A gzip file (of any number of members) piece by piece."""
    view, at, d = memoryview(data), 0, zlib.decompressobj(wbits=31)
    while True:
        raw = d.unconsumed_tail or bytes(view[at:at + step])
        if raw is not d.unconsumed_tail:
            at += len(raw)
        if not raw:
            break
        while raw:
            yield d.decompress(raw, step)
            raw = d.unconsumed_tail
            if d.eof:
                raw, d = d.unused_data, zlib.decompressobj(wbits=31)
    yield d.flush()


def parse_records(data: bytes | Iterable[bytes]) -> Iterator[tuple[dict, bytes, int, int]]:
    """(headers, block, offset, length) of each record of an archive, which
    comes whole or in pieces; one record and one piece are held at a time."""
    pieces = iter([data] if isinstance(data, bytes) else data)
    held, at = bytearray(), 0  # ``held`` starts at byte ``at`` of the archive

    def more() -> bool:
        piece = next(pieces, None)
        if piece is not None:
            held.extend(piece)
        return piece is not None

    while held or more():
        if not held:
            continue
        searched = 0
        while (end := held.find(b"\r\n\r\n", searched)) < 0:
            searched = max(0, len(held) - 3)
            if not more():
                raise ValueError(f"record at byte {at} has no end of its headers")
        first, *lines = held[:end].decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}: {first[:40]!r}")
        head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
        after = end + 4 + int(head["Content-Length"])
        while len(held) < after + 4 and more():
            pass
        if held[after:after + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut or has a wrong length")
        yield head, bytes(held[end + 4:after]), at, after + 4
        del held[:after + 4]
        at += after + 4


def _page(urn: str | None) -> int | None:
    digits = urn[len("<urn:page:"):-1] if urn else ""
    return int(digits) if digits else None


def _capture(head: dict, block: bytes, file: str, offset: int, length: int) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.decode("utf-8").rpartition("Content-Length: ")[2])
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = head["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of record at byte {offset} of {file} differs from its headers")
    url = head.get("WARC-Target-URI")
    return (_page(head["WARC-Record-ID"]), url, url_key(url), head["WARC-Date"], kind,
            _page(head.get("WARC-Refers-To")), size, digest, file, offset, length)


def _key(row: tuple):
    return row[2], row[3], -1 if row[0] is None else 0, row[0] or 0


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record (``CAPTURES``), each task's rows in sorted runs."""
    ensure_shipped(spark)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[tuple] = []
        for b in batches:
            for i in range(b.num_rows):
                file = b.column(0)[i].as_py().rpartition("/")[2]
                for head, block, offset, length in parse_records(inflated(b.column(1)[i].as_buffer())):
                    run.append(_capture(head, block, file, offset, length))
                    if len(run) == RUN_ROWS:
                        yield _table(sorted(run, key=_key))
                        run = []
        if run:
            yield _table(sorted(run, key=_key))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")
    return files.select("path", "content").mapInArrow(parse, CAPTURES)


def loser_tree_merge(runs: list[list], key) -> Iterator:
    """Merges sorted runs: inner nodes hold the losers, so the next winner
    replays one leaf-to-root path."""
    k = len(runs)
    if k <= 1:
        yield from (runs[0] if runs else ())
        return
    end = (1,)
    at = [0] * k
    keys = [(0, key(r[0]), i) if r else end for i, r in enumerate(runs)]
    tree = [-1] * k  # tree[0]: winner
    for leaf in range(k):
        node, w = (leaf + k) // 2, leaf
        while node > 0:
            if tree[node] < 0:
                tree[node], w = w, -1
                break
            if keys[tree[node]] < keys[w]:
                tree[node], w = w, tree[node]
            node //= 2
        if w >= 0:
            tree[0] = w
    while keys[tree[0]] != end:
        w = tree[0]
        yield runs[w][at[w]]
        at[w] += 1
        keys[w] = (0, key(runs[w][at[w]]), w) if at[w] < len(runs[w]) else end
        node = (w + k) // 2
        while node > 0:
            if keys[tree[node]] < keys[w]:
                tree[node], w = w, tree[node]
            node //= 2
        tree[0] = w


def natural_runs(rows: list, key) -> list[list]:
    """Cuts rows into maximal ascending runs (the sorted runs as they came)."""
    runs: list[list] = []
    last = None
    for r in rows:
        k = key(r)
        if last is None or k < last:
            runs.append([])
        runs[-1].append(r)
        last = k
    return runs


def merge_index(captures: DataFrame, path: str) -> DataFrame:
    """Globally ordered index under ``path``: the captures with
    capture_rank (from 1) by URL key, timestamp and page id (null first)."""
    spark = captures.sparkSession
    ensure_shipped(spark)
    runs = f"{path}/runs"
    captures.write.parquet(runs)  # the range partitioner samples its input: read the parsed runs, don't parse twice

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        out: list[tuple] = []
        pos = 0
        for r in loser_tree_merge(natural_runs(rows, _key), _key):
            pos += 1
            out.append((*r, part, pos))
            if len(out) == RUN_ROWS:
                yield _placed(out)
                out = []
        if out:
            yield _placed(out)

    stored = spark.read.schema(CAPTURES).parquet(runs)
    ranges = stored.repartitionByRange(max(spark.sparkContext.defaultParallelism, -(-stored.count() // RANGE_ROWS)), *_ORDER)
    merged = ranges.mapInArrow(merge, CAPTURES + ", part int, pos long")
    merged.write.parquet(f"{path}/merged")
    index = spark.read.schema(CAPTURES + ", part int, pos long").parquet(f"{path}/merged")
    # one row per range; a running total over that many rows
    sizes = sorted((r["part"], r["n"]) for r in index.groupBy("part").agg(F.count("*").alias("n")).collect())
    before, starts = 0, []
    for part, n in sizes:
        starts.append((part, before))
        before += n
    offsets = spark.createDataFrame(starts, "part int, before long")
    return (index.join(F.broadcast(offsets), "part")  # as many rows as ranges
            .withColumn("capture_rank", F.col("before") + F.col("pos")).drop("part", "pos", "before"))


def _placed(rows: list[tuple]) -> pa.RecordBatch:
    schema = _ARROW.append(pa.field("part", pa.int32())).append(pa.field("pos", pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def archive_and_index(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write, read back, merge: the ordered capture index of ``pages``."""
    path = path or scratch_path(pages.sparkSession, "warc")
    write_archives(pages, f"{path}/archives", **options)
    return merge_index(read_archives(pages.sparkSession, f"{path}/archives"), f"{path}/index")
