"""Linear grouping: whole documents, exact places, few sequences."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations_with_replacement

import numpy as np
import pytest

from kestrel.llm import grouping
from kestrel.llm.inputs import tokenizer


def filled(rows, histogram, capacity):
    """Tokens by sequence, after checking that every piece has one gapless place."""
    at, ranks = defaultdict(list), defaultdict(list)
    for length, low, high, first, offset in rows:
        ranks[length].append((low, high))
        for k in range(high - low):
            at[first + k].append((offset, length))
    for length, n in histogram.items():
        spans = sorted(ranks.pop(length, []))
        assert [a for a, _ in spans] == [0, *[b for _, b in spans[:-1]]][:len(spans)] and (spans[-1][1] if spans else 0) == n
    assert not ranks
    out = {}
    for s, pieces in at.items():
        fill = 0
        for offset, length in sorted(pieces):
            assert offset == fill
            fill += length
        assert fill <= capacity
        out[s] = fill
    return out


def best_fit_decreasing(lengths, capacity):
    rooms, n = [], 0
    import bisect
    for x in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, x)
        if i < len(rooms):
            room = rooms.pop(i)
        else:
            room, n = capacity, n + 1
        bisect.insort(rooms, room - x)
    return n


@pytest.mark.parametrize("seed", range(12))
def test_plan_places_every_piece(seed):
    r = random.Random(seed)
    capacity = r.choice([16, 100, 2048])
    lengths = [min(capacity, max(1, int(r.lognormvariate(np.log(capacity / 5), 1)))) for _ in range(r.choice([1, 7, 300, 20_000]))]
    if seed % 3 == 0:  # a third of one length
        lengths += [max(1, capacity // 3)] * (len(lengths) // 2)
    histogram = Counter(lengths)
    rows, n = grouping.plan(histogram, capacity)
    fills = filled(rows, histogram, capacity)
    assert len(fills) == n and sum(fills.values()) == sum(lengths)
    least = -(-sum(lengths) // capacity)
    assert n <= max(1.02 * least, 1.02 * best_fit_decreasing(lengths, capacity)) + 1
    assert len(rows) < 40_000


def test_few_sizes_are_optimal():
    """Sizes that best-fit decreasing packs badly: pairs must be matched."""
    histogram = {51: 6000, 27: 6000, 26: 6000, 23: 12000}
    rows, n = grouping.plan(histogram, 100, small=20)
    filled(rows, histogram, 100)
    lengths = [x for x, k in histogram.items() for _ in range(k)]
    assert n <= -(-sum(lengths) // 100) * 1.01 + 3 < best_fit_decreasing(lengths, 100)


def test_configurations_reach_the_linear_programme():
    """Against all configurations, solved by enumeration of bases on three sizes."""
    sizes, counts, capacity = np.array([60, 45, 30]), np.array([40.0, 70.0, 90.0]), 100
    got = sum(x for _, x in grouping._configurations(sizes, counts, capacity))
    configs = {tuple(Counter(c).get(k, 0) for k in range(3)) for n in range(1, 4) for c in combinations_with_replacement(range(3), n)
               if sum(sizes[k] for k in c) <= capacity}
    best = min(np.linalg.solve(m, counts).sum() for a in configs for b in configs for c in configs
               if abs(np.linalg.det(m := np.array([a, b, c], float).T)) > 1e-9 and (np.linalg.solve(m, counts) >= -1e-9).all())
    assert got == pytest.approx(best, rel=1e-3)


def test_documents(spark):
    from tokenizers import Tokenizer
    r = random.Random(5)
    words = ["alpha", "Beta", "gamma,", "x1", "?!", "ünder"]
    docs = [(k, None if k == 3 else " ".join(r.choice(words) for _ in range(r.choice([0, 3, 40, 200])))) for k in range(200)]
    docs += [(500, "repeat me"), (500, "repeat me"), (None, "no id"), (501, "long text " * 30_000)]
    df = spark.createDataFrame([(*d, 9, "clash") for d in docs], "doc_id long, text string, rank int, sequence_id string").repartition(7)
    got = grouping.group_pack(df, tokenizer("word_bpe_49k.json"), capacity=256).collect()
    t = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    want = Counter()
    for d, x in docs:
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 256):
            want[d, k // 256, k, tuple(ids[k:k + 256])] += 1
    assert Counter((g.doc_id, g.piece, g.start, tuple(np.frombuffer(g.ids, "<u4"))) for g in got) == want
    fill = defaultdict(list)
    for g in got:
        assert g.length == len(g.ids) // 4 and g.ids_crc32 == zlib.crc32(g.ids)
        fill[g.sequence_id].append((g.offset, g.length))
    for pieces in fill.values():
        ends = 0
        for offset, length in sorted(pieces):
            assert offset == ends
            ends += length
        assert ends <= 256
    total = sum(g.length for g in got)
    assert len(fill) <= 1.01 * -(-total // 256) + 1


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert grouping.group_pack(df, tokenizer("word_bpe_49k.json")).count() == 0
