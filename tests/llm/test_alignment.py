"""Token alignment against a plain pass over every pair of tokens."""

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from kestrel.llm import alignment
from kestrel.llm.inputs import tokenizer
from kestrel.llm.queries import op12_token_alignment
from tests.conftest import SF001

A, B = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")


def bytes_of_a():
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in seen}
    for b in range(256):
        if b not in seen:
            chars[chr(256 + len(chars) - len(seen))] = b
    return chars


def brute(docs):
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    chars, counts, kept = bytes_of_a(), Counter(), []
    for text in docs:
        if not text:
            kept.append(None)
            continue
        ids_a, ids_b = t.encode(" " + text, add_special_tokens=False), sp.encode(text)
        parts_a = [bytes(chars[c] for c in x) for x in ids_a.tokens]
        parts_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, sp.id_to_piece(i)) for i in ids_b)]
        if b"".join(parts_a) != (" " + text).encode() or b"".join(parts_b) != (" " + text).encode():
            kept.append(None)
            continue
        spans = []
        for ids, parts in ((ids_a.ids, parts_a), (ids_b, parts_b)):
            at, out = 0, []
            for i, p in zip(ids, parts):
                out.append((i, at, at + len(p)))
                at += len(p)
            spans.append(out)
        links, j0 = [], 0
        for a, s, e in spans[0]:
            while spans[1][j0][2] <= s:
                j0 += 1
            j = j0
            while j < len(spans[1]) and spans[1][j][1] < e:
                links.append((a, spans[1][j][0]))
                j += 1
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups = [[[], []] for _ in ends]
        for side in (0, 1):
            k = 0
            for i, _, e in spans[side]:
                while e > ends[k]:
                    k += 1
                groups[k][side].append(str(i))
        counts.update(links)
        text_groups = ";".join(",".join(a) + "|" + ",".join(b) for a, b in groups)
        kept.append((len(spans[0]), len(spans[1]), len(ends), links, hashlib.sha256(text_groups.encode()).hexdigest()))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(0, 0, 0, 0, 0, 0, "") if k is None else
            (k[0], k[1], k[2], len(k[3]), sum(counts[x] == best[x[1]] for x in k[3]), sum(counts[x] for x in k[3]), k[4]) for k in kept]


ODD = [None, "", " ", "  lead", "trail ", "two  spaces", "a\n b\n\nc", "tab\tx \t y", "low ▁ line", "▁", "<|endoftext|> <s> <unk> <0x41> </s>",
       "naïve 日本語 \U0001f600\U0001f468‍\U0001f469", "é combining", "\x00\x01", "it's we'll DON'T 1234567 x1y2", "...", " nbsp　wide",
       "a" * 5000, "ab cd " * 3000 + "end", "\r\nwin\r\n", "x" * 150 + " " + "y" * 300]


@pytest.mark.parametrize("block", [200, 4 << 20])
def test_against_every_pair(spark, block):
    r = random.Random(3)
    words = ["the", "Alpha", "antidisestablishment", "über", "x,", "<s>", "café", "42", "中文", "don't"]
    texts = ODD + [" ".join(r.choice(words) for _ in range(r.randrange(1, 60))) for _ in range(60)]
    texts += texts[:15] + ["repeated text"] * 9
    rows = [(None if k == 7 else k, x, 1, "clash") for k, x in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, count int, n_best string").repartition(5)
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in alignment.align(df, A, B, block_bytes=block).collect()}
    assert got == {row[0]: w for row, w in zip(rows, brute(texts))}


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in op12_token_alignment(spark, SF001).collect())
    assert got == sorted((d, *w) for (d, _), w in zip(docs, brute([x for _, x in docs])))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(df, A, B).count() == 0
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r)[1:] for r in alignment.align(df, A, B).collect()) == [(0, 0, 0, 0, 0, 0, "")] * 2
