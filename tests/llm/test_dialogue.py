"""Conversation repair against exhaustive search over complete edit strings."""

import hashlib
import random
import re

import pytest

from kestrel.llm import dialogue

ORDER = ["conv_id long, turn long, role string, text string"]


def brute(rows):
    """(cost, edits, lines): every state keeps its least (cost, edits) whole."""
    nxt = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    name = {"u": "user", "a": "assistant"}

    def grow(best):
        best = dict(best)
        for _ in range(3):
            for q, (c, e, t) in list(best.items()):
                for r in "ua":
                    if (q, r) in nxt:
                        new = (c + 3, e + "I", t + [name[r] + ":"])
                        best[nxt[q, r]] = min(best.get(nxt[q, r], new), new)
        return best

    best, seen, counts = {"": (0, "", [])}, set(), {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        fault = None
        if not re.search(r"[^\x20\x09-\x0D]", text):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        new = {}

        def offer(q, way):
            new[q] = min(new.get(q, way), way)

        for q, (c, e, t) in grow(best).items():
            offer(q, (c + 4, e + "D", t))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if (q, role[:1]) in nxt:
                    offer(nxt[q, role[:1]], (c + more, e + "K", t + [f"{role}:{text}"]))
                for r in "ua":
                    if (q, r) in nxt:
                        offer(nxt[q, r], (c + more + 3, e + "R", t + [f"{name[r]}:{text}"]))
        best = new
    return counts, min(w for q, w in grow(best).items() if q in ("", "a"))


def expected(rows):
    """rows: (conv, turn, role, text, n)"""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x, n in rows if c == conv for _ in range(n)]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        counts, (cost, audit, lines) = brute(mine)
        turns = {t for t, _, _ in mine if t is not None}
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"],
                     sum((a[1][:1], b[1][:1]) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in zip(mine, mine[1:])),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def random_rows(seed, convs, most):
    r = random.Random(seed)
    texts = ["Fine.", "Yes!", "cut off", "", " \t\n", "Is it?", "Ünd. ", "x\n"]
    return [(None if c == 0 else c, None if r.random() < 0.05 else r.randrange(most + 2),
             r.choice(["system", "user", "user", "assistant", "assistant", "tool", None, ""]),
             None if r.random() < 0.03 else r.choice(texts) + (str(k) + "." if r.random() < 0.6 else ""), r.choice([0, 1, 1, 1, 1, 2, 5]))
            for c in range(convs) for k in range(r.randrange(1, most))]


SCHEMA = "conv_id long, turn long, role string, text string, n int"


@pytest.mark.parametrize("seed,convs,most,piece", [(1, 60, 12, 16384), (2, 40, 30, 4), (3, 3, 400, 7), (4, 1, 600, 16384)])
def test_against_exhaustive_search(spark, seed, convs, most, piece):
    rows = random_rows(seed, convs, most)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA + ", audit string, part int")
    pieces = dialogue.repair(df, piece_turns=piece, keep_turns=seed % 2 == 0).cache()
    got = {r[0]: tuple(r)[1:] for r in dialogue.report(pieces).collect()}
    assert got == expected(rows)
    assert pieces.where("not whole").count() > 0 or piece == 16384


def test_piece_costs_fold_to_the_whole():
    r = random.Random(7)
    for _ in range(200):
        rows = [(k, r.choice(["s", "u", "a", "t"]), "x", r.choice([0, 0, 0, 1, 2, 3]), r.choice([1, 1, 1, 3])) for k in range(r.randrange(1, 30))]
        whole = dialogue.repair_rows(rows)
        cuts = sorted(r.sample(range(len(rows) + 1), min(3, len(rows))))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        cost, states, tail = dialogue.borders([dialogue.summary(p) for p in parts])
        audits = [dialogue.repair_rows(p, a, b)[1] for p, a, b in zip(parts, states, states[1:])]
        assert (cost, "".join(audits) + tail) == whole


def test_survivors_coalesce():
    """Decided edits leave the tree: what is held stays small on a long, clean conversation."""
    s = dialogue.Survivors(dialogue.START)
    most = 0
    for k in range(5000):
        s.turn("ua"[k % 2], dialogue.OK if k % 11 else dialogue.TRUNCATED)
        held, level = 0, [s.root]
        while level:
            held += len(level)
            level = [kid for x in level for kid in x.kids]
        most = max(most, held)
    assert most < 60 and len(s.done) > 4900


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert dialogue.report(dialogue.repair(empty)).count() == 0
    long_text = "word " * 400_000 + "."
    rows = [(1, 0, "user", long_text, 1), (1, 1, "assistant", "Ok.", 1), (2, 0, "user", "gone.", 0), (3, 0, "user", "same.", 3000), (3, 1, "assistant", "b.", 1)]
    got = {r[0]: tuple(r)[1:] for r in dialogue.report(dialogue.repair(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got == expected(rows)
    assert got[2] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    turns = dialogue.repair(spark.createDataFrame(rows[3:], SCHEMA)).select("turns").first()[0]
    assert [tuple(t) for t in turns] == [(0, "user", "same."), (1, "assistant", "b.")]
