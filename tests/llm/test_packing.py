"""Packing: every id once, bounded windows, little padding."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from kestrel.llm import packing

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


def library(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def check(pieces, ids_by_doc, capacity):
    """Pieces tile the documents and fill the sequences without gaps."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    assert set(by_doc) == set(ids_by_doc)
    for doc, ids in ids_by_doc.items():
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            raw = np.array(ids[at:at + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(raw)
            at += p.length
        assert at == len(ids)
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    return [sum(p.length for p in ps) for ps in by_seq.values()]


def test_word_lookup_equals_library(monkeypatch):
    texts = ["", None, " a  b ", "İ ΑΣ ǅ é é", "<|endoftext|> x<|startoftext|>y <b", "d's 't can't", "　a\x85b", "a\x1cb c", "Some Words, some words!"]
    tok = packing.WordIds(PATH)
    assert tok.by_word
    assert [x.tolist() for x in tok.ids(pa.array(texts))] == library(texts)
    monkeypatch.setattr(packing, "WORDS_KEPT", 4)
    many = [f"w{k} v{k} u{k}" for k in range(50)]
    small = packing.WordIds(PATH)
    assert [x.tolist() for t in many for x in small.ids(pa.array([t]))] == library(many)


def test_windows_best_fit():
    w = packing.Windows(10, 2)
    for key, n in (("a", 6), ("b", 8), ("c", 2), ("d", 3)):
        w.place(key, 0, np.arange(n))
    # c fits b's window exactly; d fits a's best; nothing was cut
    assert [[(k, s, len(i)) for k, s, i in d] for d in w.done] == [[("b", 0, 8), ("c", 0, 2)]]
    assert [[k for k, *_ in w.open[n]] for _, n in w.free] == [["a", "d"]]
    w.place("e", 0, np.arange(9))
    w.place("f", 0, np.arange(25))  # two whole windows, then 5 tokens: tops up the fullest (1 left), emitted
    assert len(w.open) <= 2 and all(sum(len(i) for _, _, i in d) == 10 for d in w.done)


@pytest.mark.parametrize("parts,capacity,windows", [(1, 64, 4), (23, 64, 3), (70, 32, 2)])
def test_pieces(spark, parts, capacity, windows):
    rng = np.random.default_rng(parts)
    texts = [" ".join(f"word{int(w)}" for w in rng.integers(0, 50, int(rng.integers(0, 60)))) for _ in range(150)] + [None, "", "long " * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
    got = packing.pack_documents(df, PATH, capacity, windows).collect()
    ids = {i: [*x, 2] for i, x in enumerate(library(texts))}
    fill = check(got, ids, capacity)
    assert sum(f < capacity for f in fill) <= 1
    assert all(np.frombuffer(p.ids, "<u4").tolist() == ids[p.doc_id][p.start:p.start + p.length] for p in got)


def test_edges(spark):
    df = spark.createDataFrame([(None, "a b", 1), (7, "x", 2), (7, "x", 2)], "doc_id long, text string, start int")
    got = packing.pack_documents(df, PATH, 16, 2, keep_ids=False).collect()
    assert len(got) == 3 and "ids" not in got[0] and sorted(p.length for p in got) == [2, 2, 3]
    assert sorted((p.offset, p.length) for p in got)[0][0] == 0
    assert packing.pack_documents(df.limit(0), PATH).count() == 0
