"""Archives round trip and the merged index."""

import hashlib
import random

import pytest

from kestrel.llm import warc
from kestrel.session import scratch_path


def test_loser_tree_merges_runs():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.randint(0, 30) for _ in range(rng.randint(0, 20))) for _ in range(k)]
        assert list(warc.loser_tree_merge(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_natural_runs():
    assert warc.natural_runs([1, 2, 2, 1, 5, 0], lambda x: x) == [[1, 2, 2], [1, 5], [0]]
    assert warc.natural_runs([], lambda x: x) == []


def test_cut_record_fails():
    rec = b"WARC/1.1\r\nContent-Length: 10\r\n\r\n12345\r\n\r\n"
    with pytest.raises(ValueError):
        list(warc.parse_records(rec))


def test_records_from_pieces():
    import gzip
    recs = [(f"WARC/1.1\r\nWARC-Record-ID: {k}\r\nContent-Length: {n}\r\n\r\n".encode() + bytes([65 + k]) * n + b"\r\n\r\n") for k, n in enumerate([0, 5, 70_000, 1])]
    whole = list(warc.parse_records(b"".join(recs)))
    assert [len(b) for _, b, _, _ in whole] == [0, 5, 70_000, 1] and [o for *_, o, _ in whole] == [sum(map(len, recs[:k])) for k in range(4)]
    members = gzip.compress(recs[0] + recs[1]) + gzip.compress(recs[2]) + gzip.compress(recs[3])
    for step in (1, 7, 1000, 1 << 20):
        assert list(warc.parse_records(warc.inflated(members, step))) == whole
    with pytest.raises(ValueError):
        list(warc.parse_records([recs[0], recs[2][:500]]))


def test_files_are_bounded_by_bytes(spark):
    import os
    df = spark.createDataFrame([(k, f"http://h.org/{k}", "z" * 100_000 + str(k)) for k in range(60)], "page_id long, url string, html string").coalesce(1)
    path = scratch_path(spark, "t")
    warc.write_archives(df, f"{path}/a", bytes_per_file=1 << 20)
    files = [f for f in os.listdir(path.removeprefix("file:") + "/a") if f.startswith("part-")]
    assert len(files) >= 6 and warc.read_archives(spark, f"{path}/a").count() == 60


def test_round_trip(spark):
    big = "x\r\n\r\nWARC/1.1\r\n" * 100 + "é€"
    rows = [(1, "http://B.com/a", big), (2, "http://a.com/", None), (3, "http://a.com/", ""), (4, None, big), (5, "http://b.com/a\r\nX: y", big),
            (6, "http://a.com/z?q#f", "short"), (7, "http://a.com/z", "short"), (None, "http://n.org/", big), (None, "no scheme", "y" * 1000),
            (8, "http://l.org/", "long " * 200_000), (5, "http://b.com/a\r\nX: y", big)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, record_type int").repartition(3)
    path = scratch_path(spark, "t")
    got = warc.archive_and_index(df, path, records_per_file=3).collect()
    assert len(got) == len(rows)
    for r in got:
        body = next((h or "") for i, u, h in rows if i == r.page_id and (i is not None or (u == "no scheme") == (r.url == "noscheme"))).encode()
        assert r.payload_bytes == len(body) and r.payload_digest == hashlib.sha1(body).hexdigest()
        revisit = body == big.encode() and r.page_id != 5
        assert (r.record_type, r.refers_to) == (("revisit", 5) if revisit else ("response", None))
    got.sort(key=lambda r: r.capture_rank)
    assert [r.capture_rank for r in got] == list(range(1, len(rows) + 1))
    keys = [(r.url_key, r.captured, -1 if r.page_id is None else 0, r.page_id or 0) for r in got]
    assert keys == sorted(keys)
    assert {r.url_key for r in got if r.page_id == 6} == {"com,a)/z?q"} and [r.url_key for r in got if r.page_id == 4] == [")"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_and_index(df).count() == 0


def test_own_capture_times_order_histories(spark):
    df = spark.sql("select * from values (1L, 'http://a.b/', 'x', timestamp'2024-05-01'), (2L, 'http://a.b/', 'y', timestamp'2023-05-01') t(page_id, url, html, at)")
    got = warc.archive_and_index(df, captured="at").orderBy("capture_rank").collect()
    assert [r.page_id for r in got] == [2, 1] and got[0].captured == "2023-05-01T00:00:00Z"
