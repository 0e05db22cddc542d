"""Conversation structure repair by Viterbi with survivor coalescence.

The turns of a conversation become a role pattern ``(s?(ua)+)?`` (initials of
system, user, assistant) at the least cost: keep a turn (0), rerole it to
user or assistant (3), delete it (4; blank and repeated turns must go),
insert an empty turn (3); a truncated turn that stays costs 3 more.  Equal
costs are decided by the edits' initials, least in ASCII.

After each turn every pattern state has one survivor, a leaf of a tree of
back pointers.  Nodes count their children; a node without any is freed, and
once all survivors descend from one child of the root that child's edits are
emitted and it becomes the root.  Survivors that another can imitate for less
are dropped (the empty conversation would else never join).  Survivors of equal cost are compared by
their whole unresolved suffixes (down to where they part: edits of the same
number of turns are never prefixes of each other).

A long conversation is no single task's work.  Turns are range-partitioned on
(conversation, turn, ...), so a hot conversation spreads over partitions.  A
conversation inside one partition and one piece (``PIECE_TURNS`` turns,
``PIECE_BYTES`` bytes) is repaired at once.  Others leave a row per piece with
the costs between all pairs of states and the order of the survivors' edits;
folding these gives the states at the borders, and then each piece is repaired
on its own from its known states.  Only the digest of a text, a chain by its
nature, passes over a long conversation's pieces in order, as a stream.

Cases: turns are ordered by turn (nulls first), then role and text, so equal
rows are neighbours; null role and text count as one space; null conversation
ids are one conversation; other columns are ignored; a conversation whose turns
all go has empty results; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import bitfilter
from kestrel.session import ensure_shipped, scratch_path

PIECE_TURNS, PIECE_BYTES = 16_384, 8 << 20
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
_SPACE = "\\x20\\x09-\\x0D"
# pattern states: nothing yet, after s, after u, after a
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_NEXT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
_TURN = {START: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}  # an edit's role in a state
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

_TURNS = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
_RAW = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("fault", pa.int64()), ("n", pa.int64())]))
_COUNTS = ("turns_in", "blank", "duplicate", "truncated", "illegal", "n_turns", "first_turn", "last_turn")
_PIECE = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()), ("whole", pa.bool_()),
                    *[(c, pa.int64()) for c in _COUNTS], ("first_role", pa.string()), ("last_role", pa.string()),
                    ("raw", _RAW), ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int64())),
                    ("cost", pa.int64()), ("audit", pa.string()), ("turns", _TURNS), ("repaired_sha256", pa.string())])
_BORDERS = pa.schema([*[(c, pa.int64()) for c in ("part", "piece", "conv_id", "cost", "from", "to")], ("tail", pa.string()), ("whole", pa.bool_())])
_COUNT_DDL = ", ".join(f"{c} long" for c in _COUNTS)
_PIECE_DDL = (f"conv_id long, part long, piece long, whole boolean, {_COUNT_DDL}, first_role string, last_role string, "
              "raw array<struct<turn: long, role: string, text: string, fault: long, n: long>>, costs array<long>, ranks array<long>, "
              "cost long, audit string, turns array<struct<turn: long, role: string, text: string>>, repaired_sha256 string")


def _moves(initial: str, fault: int) -> list[list[tuple[int, int, str]]]:
    """For each state after a turn: (state before, cost, edits), the least of each pair."""
    best: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(p: int, q: int, cost: int, edits: str) -> None:
        best[p, q] = min(best.get((p, q), (cost, edits)), (cost, edits))

    stays = CUT if fault == TRUNCATED else 0
    for p in range(4):
        t, inserted = p, 0
        for _ in range(3):  # no, one or two turns inserted before it
            offer(p, t, DELETE + INSERT * inserted, "I" * inserted + "D")
            if fault in (OK, TRUNCATED):
                if (t, initial) in _NEXT:
                    offer(p, _NEXT[t, initial], KEEP + stays + INSERT * inserted, "I" * inserted + "K")
                offer(p, _NEXT[t, _TURN[t][0]], REROLE + stays + INSERT * inserted, "I" * inserted + "R")
            t, inserted = _NEXT[t, _TURN[t][0]], inserted + 1
    return [[(p, *best[p, q]) for p in range(4) if (p, q) in best] for q in range(4)]


_MOVES = {(i, f): _moves(i, f) for i in ("s", "u", "a", "") for f in (OK, BLANK, TRUNCATED)}
#: Cost and edits that end a conversation in each state.
_ENDS = {START: (0, ""), AFTER_S: (2 * INSERT, "II"), AFTER_U: (INSERT, "I"), AFTER_A: (0, "")}


def _steps(row: tuple) -> Iterator[tuple[str, int]]:
    """(initial, fault) of each of a row's equal turns; repeated ones must go."""
    _, role, _, fault, n = row
    initial = role[:1] if role[:1] in ("s", "u", "a") else ""
    if n:
        yield initial, BLANK if fault == DUPLICATE else fault
    for _ in range(n - 1):
        yield "", BLANK


#: What ending from the first state can cost more than from the second, at
#: most: the first imitates the second by inserted turns, by deleting the system
#: turn that only the start may keep, or by two turns after a lone system turn.
_AHEAD = {(AFTER_A, START): 4, (AFTER_U, START): 7, (AFTER_S, START): 6, (START, AFTER_S): 0, (AFTER_A, AFTER_S): 0, (AFTER_U, AFTER_S): 3,
          (START, AFTER_A): 0, (AFTER_S, AFTER_A): 6, (AFTER_U, AFTER_A): 3, (START, AFTER_U): 3, (AFTER_S, AFTER_U): 3, (AFTER_A, AFTER_U): 3}


class _Node:
    __slots__ = ("up", "edits", "kids")

    def __init__(self, up: _Node | None, edits: str):
        self.up, self.edits, self.kids = up, edits, []


class Survivors:
    """One survivor a state, in a tree of back pointers."""

    def __init__(self, state: int):
        self.root = _Node(None, "")
        self.leaf: list[_Node | None] = [None] * 4
        self.cost = [0] * 4
        self.leaf[state] = self.root
        self.done: list[str] = []  # edits no later turn can change

    def before(self, x: _Node, y: _Node) -> bool:
        """True if x's unresolved edits come before y's."""
        while x.up is not y.up:
            x, y = x.up, y.up
        return x.edits < y.edits

    def turn(self, initial: str, fault: int) -> None:
        leaf, cost = self.leaf, self.cost
        new: list[tuple[int, int, str] | None] = []
        for moves in _MOVES[initial, fault]:
            best = None
            for p, c, edits in moves:
                x = leaf[p]
                if x is None:
                    continue
                c += cost[p]
                if best is None or c < best[0] or (c == best[0] and self.before(x, leaf[best[1]])):
                    best = (c, p, edits)
            new.append(best)
        for (q, p), more in _AHEAD.items():  # survivors too dear to win are dropped, ties never
            if new[p] is not None and new[q] is not None and new[q][0] + more < new[p][0]:
                new[p] = None
        old = [x for x in leaf if x is not None]
        grown: list[_Node | None] = [None] * 4
        for q, best in enumerate(new):
            if best is not None:
                up = leaf[best[1]]
                grown[q] = _Node(up, best[2])
                up.kids.append(grown[q])
        self.cost = [0 if b is None else b[0] for b in new]
        self.leaf = grown
        for x in old:  # those without children are freed, and what only led to them
            while not x.kids and x.up is not None:
                up = x.up
                up.kids.remove(x)
                x.up, x = None, up
        while len(self.root.kids) == 1:  # all survivors share it
            self.root = self.root.kids[0]
            self.root.up = None
            self.done.append(self.root.edits)

    def end(self, state: int | None) -> tuple[int, int, str]:
        """(state, cost, edits) of the survivor in ``state``, or (None) of the
        cheapest conversation that ends here."""
        if state is None:
            for q, x in enumerate(self.leaf):
                if x is not None and (state is None or (k := self.cost[q] + _ENDS[q][0]) < low or (k == low and self.before(x, self.leaf[state]))):
                    state, low = q, self.cost[q] + _ENDS[q][0]
            tail = _ENDS[state]
        else:
            tail = (0, "")
        rest, x = [tail[1]], self.leaf[state]
        while x is not self.root:
            rest.append(x.edits)
            x = x.up
        return state, self.cost[state] + tail[0], "".join([*self.done, *reversed(rest)])


def repair_rows(rows: Iterable[tuple], start: int = START, end: int | None = None) -> tuple[int, str]:
    """(cost, edits) of (turn, role, text, fault, n) rows from one state to
    another (None: to the end of the conversation)."""
    s = Survivors(start)
    for row in rows:
        for step in _steps(row):
            s.turn(*step)
    _, cost, audit = s.end(end)
    return cost, audit


def apply_edits(rows: Iterable[tuple], audit: str, state: int = START) -> list[tuple]:
    """The (turn, role, text) rows that the edits leave."""
    out, edits = [], iter(audit)

    def insert(e: str) -> str:
        nonlocal state
        while e == "I":
            out.append((None, _TURN[state], ""))
            state = _NEXT[state, _TURN[state][0]]
            e = next(edits, "")
        return e

    for turn, role, text, _, n in rows:
        for _ in range(n):
            e = insert(next(edits))
            if e != "D":
                kept = _TURN[state] if e == "R" else role
                out.append((turn, kept, text))
                state = _NEXT[state, kept[0]]
    insert(next(edits, ""))
    return out


def summary(rows: Iterable[tuple]) -> tuple[list[int | None], list[int | None]]:
    """Costs between all pairs of states (null: no way), and by first state
    the order of the last states' edits."""
    costs: list[list[int | None]] = [[0 if p == q else None for q in range(4)] for p in range(4)]
    ranks: list[list[int]] = [[0] * 4 for _ in range(4)]
    for row in rows:
        for step in _steps(row):
            moves = _MOVES[step]
            for start in range(4):
                cost, rank = costs[start], ranks[start]
                best = [min(((cost[p] + c, rank[p], e) for p, c, e in m if cost[p] is not None), default=None) for m in moves]
                order = sorted((b[1:], q) for q, b in enumerate(best) if b is not None)
                costs[start] = [None if b is None else b[0] for b in best]
                ranks[start] = [0] * 4
                for k, (_, q) in enumerate(order):
                    ranks[start][q] = k
    return [c for row in costs for c in row], [r for row in ranks for r in row]


def borders(pieces: list[tuple[list[int | None], list[int]]]) -> tuple[int, list[int], str]:
    """(cost, states at the pieces' borders, edits after the last) of a
    conversation, from its pieces' summaries in order."""
    cost: list[int | None] = [0, None, None, None]
    rank = [0] * 4
    back = []
    for costs, ranks in pieces:
        best = []
        for q in range(4):
            ways = [(cost[p] + costs[4 * p + q], rank[p], p) for p in range(4) if cost[p] is not None and costs[4 * p + q] is not None]
            best.append(min(ways, default=None))
        order = sorted(((b[1], ranks[4 * b[2] + q]), q) for q, b in enumerate(best) if b is not None)
        cost, rank = [None if b is None else b[0] for b in best], [0] * 4
        for k, (_, q) in enumerate(order):
            rank[q] = k
        back.append([None if b is None else b[2] for b in best])
    low, _, q = min((cost[q] + _ENDS[q][0], rank[q], q) for q in range(4) if cost[q] is not None)
    states = [q]
    for b in reversed(back):
        states.append(b[states[-1]])
    return low, states[::-1], _ENDS[q][1]


def _counts(rows: list[tuple]) -> tuple[dict, str | None, str | None]:
    c = dict.fromkeys(_COUNTS, 0) | {"first_turn": None, "last_turn": None}
    first = last = None
    for turn, role, _, fault, n in rows:
        if not n:
            continue
        c["turns_in"] += n
        c["blank"] += n * (fault == BLANK)
        c["duplicate"] += (n - 1) * (fault != BLANK) + (fault == DUPLICATE)
        c["truncated"] += fault == TRUNCATED
        initial = role[:1]
        c["illegal"] += n - 1 + (last is not None and (last, initial) not in _LEGAL)
        first, last = initial if first is None else first, initial
        if turn is not None and turn != c["last_turn"]:
            c["n_turns"] += 1
            c["first_turn"] = turn if c["first_turn"] is None else c["first_turn"]
            c["last_turn"] = turn
    return c, first, last


def _lines(turns: list[tuple]) -> str:
    return "\n".join(f"{role}:{text}" for _, role, text in turns)


def _as_dicts(turns: list[tuple]) -> list[dict]:
    return [{"turn": t, "role": r, "text": x} for t, r, x in turns]


def _sorted_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, fault, n: equal rows once, in order, a range
    of (conversation, turn, role, text) a partition.  Rows with n = 0 stand for
    a conversation without turns."""
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
                     F.col("n").cast("long").alias("n") if "n" in turns.columns else F.lit(1).cast("long").alias("n"))
    blank = ~F.col("text").rlike(f"[^{_SPACE}]")
    fault = (F.when(blank, BLANK).when(F.col("first_turn").isNotNull() & ~F.struct("turn").eqNullSafe(F.col("first_turn")), DUPLICATE)
             .when(F.col("text").rlike(f"[.!?][{_SPACE}]*\\z"), OK).otherwise(TRUNCATED).cast("long"))
    # turns found more than once in a conversation: few, known by their digests; texts stay where they are
    t = t.withColumn("__key", F.sha2(F.to_json(F.struct("conv_id", "role", "text")), 256))
    first = F.min(F.struct(F.col("turn").isNotNull(), "turn"))  # nulls first
    again = (t.where("n > 0").groupBy("__key").agg(F.count("*").alias("rows"), first.alias("first"))
             .where("rows > 1").select("__key", F.struct(F.col("first.turn").alias("turn")).alias("first_turn")))
    path = scratch_path(turns.sparkSession, "repeated-turns")
    again.write.parquet(path)
    again = turns.sparkSession.read.schema("__key string, first_turn struct<turn: long>").parquet(path)
    flagged = bitfilter.with_flag(t, again, ["__key"], "__maybe")
    cols = ("conv_id", "turn", "role", "text")
    some = flagged.where((F.col("n") > 0) & F.col("__maybe")).join(again, "__key", "left")
    some = some.groupBy(*cols, "first_turn").agg(F.sum("n").alias("n"))
    rest = flagged.where((F.col("n") == 0) | ~F.col("__maybe")).withColumn("first_turn", F.lit(None).cast("struct<turn: long>"))
    t = rest.select(*cols, "first_turn", "n").unionByName(some).select(*cols, fault.alias("fault"), "n")
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.substring("role", 1, 64), F.substring("text", 1, 64)]
    return t.repartitionByRange(*order).sortWithinPartitions(*order, "role", "text")


def repair(turns: DataFrame, keep_turns: bool = True, path: str | None = None,
           piece_turns: int = PIECE_TURNS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row per piece of a conversation (``conv_id``; pieces in order of
    ``part``, ``piece``; ``whole``: its only one): counts, audit, the cost (of
    the whole conversation), and with ``keep_turns`` the repaired turns."""
    spark = turns.sparkSession
    ensure_shipped(spark)
    path = path or scratch_path(spark, "dialogue")

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        out: list[dict] = []
        held = 0
        conv, rows, size, piece, edge = None, None, 0, 0, True

        def close(whole: bool) -> None:
            nonlocal held
            counts, first, last = _counts(rows)
            row = {"conv_id": conv, "part": part, "piece": piece, "whole": whole, **counts, "first_role": first, "last_role": last}
            if whole:
                row["cost"], row["audit"] = repair_rows(rows)
                left = apply_edits(rows, row["audit"])
                row["repaired_sha256"] = hashlib.sha256(_lines(left).encode()).hexdigest()
                row["turns"] = _as_dicts(left) if keep_turns else None
            else:
                row["costs"], row["ranks"] = summary(rows)
                row["raw"] = [dict(zip(("turn", "role", "text", "fault", "n"), r)) for r in rows]
            out.append(row)
            held += size if keep_turns or not whole else 200

        for b in batches:
            for c, *row in zip(*(b.column(i).to_pylist() for i in range(6))):
                if rows is None or c != conv:
                    if rows is not None:
                        close(not edge)
                        edge = False
                    conv, rows, size, piece = c, [], 0, 0
                elif len(rows) >= piece_turns or size >= piece_bytes:
                    close(False)
                    rows, size, piece, edge = [], 0, piece + 1, True
                rows.append(tuple(row))
                size += len(row[1]) + len(row[2])
                if len(out) >= 1024 or held >= piece_bytes:
                    yield pa.RecordBatch.from_pylist(out, schema=_PIECE)
                    out, held = [], 0
        if rows is not None:
            close(False)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_PIECE)

    _sorted_turns(turns).mapInArrow(first_pass, _PIECE_DDL).write.parquet(f"{path}/0")
    pieces = spark.read.schema(_PIECE_DDL).parquet(f"{path}/0")

    def fold(t: pa.Table) -> pa.Table:
        """A row per piece of a conversation, without its texts."""
        rows = sorted(t.to_pylist(), key=lambda r: (r["part"], r["piece"]))
        cost, states, tail = borders([(r["costs"], r["ranks"]) for r in rows])
        return pa.Table.from_pydict({
            "part": [r["part"] for r in rows], "piece": [r["piece"] for r in rows], "conv_id": [r["conv_id"] for r in rows],
            "cost": [cost] * len(rows), "from": states[:-1], "to": states[1:],
            "tail": [""] * (len(rows) - 1) + [tail], "whole": [len(rows) == 1] * len(rows)}, schema=_BORDERS)

    cut = pieces.where("raw is not null")
    known = cut.select("conv_id", "part", "piece", "costs", "ranks").groupBy("conv_id").applyInArrow(
        fold, "part long, piece long, conv_id long, cost long, `from` long, `to` long, tail string, whole boolean")
    known = known.select(F.col("part").alias("__part"), F.col("piece").alias("__piece"), F.col("conv_id").alias("__conv"), F.col("cost").alias("__cost"),
                         "from", "to", "tail", F.col("whole").alias("__whole"))

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                rows = [tuple(r.values()) for r in row["raw"]]
                _, audit = repair_rows(rows, row["from"], row["to"])
                left = apply_edits(rows, audit + row["tail"], row["from"])
                row |= {"cost": row["__cost"], "audit": audit + row["tail"], "turns": _as_dicts(left), "whole": row["__whole"],
                        "raw": None, "costs": None, "ranks": None}
                if row["whole"]:
                    row["repaired_sha256"] = hashlib.sha256(_lines(left).encode()).hexdigest()
                    row["turns"] = row["turns"] if keep_turns else None
                yield pa.RecordBatch.from_pylist([{f.name: row[f.name] for f in _PIECE}], schema=_PIECE)

    cut = cut.join(known, (F.col("part") == F.col("__part")) & (F.col("piece") == F.col("__piece")) & F.col("conv_id").eqNullSafe(F.col("__conv")))
    cut.mapInArrow(second_pass, _PIECE_DDL).write.parquet(f"{path}/1")
    done = pieces.where("raw is null").unionByName(spark.read.schema(_PIECE_DDL).parquet(f"{path}/1"))
    return done.drop("raw", "costs", "ranks")


_REPORT = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                     ("audit", pa.string()), ("repaired_sha256", pa.string())])


def report(pieces: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit and the digest of the repaired ``role:text`` lines."""
    whole = pieces.where("whole").select(
        "conv_id", F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0)).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv: dict | None = None
        for b in batches:
            for i in range(b.num_rows):
                p = b.slice(i, 1).to_pylist()[0]
                if conv is not None and p["conv_id"] != conv["conv_id"]:
                    yield closed(conv)
                    conv = None
                if conv is None:
                    conv = {"conv_id": p["conv_id"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": p["cost"], "audit": [],
                            "n": 0, "first": None, "last": None, "role": None, "sha": hashlib.sha256(), "any": False}
                for c in ("blank", "duplicate", "truncated", "illegal"):
                    conv[c] += p[c]
                if p["turns_in"]:
                    conv["illegal"] += conv["role"] is not None and (conv["role"], p["first_role"]) not in _LEGAL
                    conv["role"] = p["last_role"]
                if p["first_turn"] is not None:
                    conv["n"] += p["n_turns"] - (p["first_turn"] == conv["last"])  # a turn may go on in the next piece
                    conv["first"] = p["first_turn"] if conv["first"] is None else conv["first"]
                    conv["last"] = p["last_turn"]
                conv["audit"].append(p["audit"])
                if p["turns"]:
                    text = "\n".join(f"{t['role']}:{t['text']}" for t in p["turns"])
                    conv["sha"].update((("\n" if conv["any"] else "") + text).encode())
                    conv["any"] = True
        if conv is not None:
            yield closed(conv)

    def closed(conv: dict) -> pa.RecordBatch:
        row = conv | {"gaps": 0 if conv["first"] is None else conv["last"] - conv["first"] + 1 - conv["n"],
                      "audit": "".join(conv["audit"]), "repaired_sha256": conv["sha"].hexdigest()}
        return pa.RecordBatch.from_pylist([{f.name: row[f.name] for f in _REPORT}], schema=_REPORT)

    order = ["conv_id", "part", "piece"]
    several = pieces.where("not whole").repartition("conv_id").sortWithinPartitions(*order)
    long = several.mapInArrow(join, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                                    "audit string, repaired_sha256 string")
    return whole.unionByName(long)


def damage(turns: DataFrame) -> DataFrame:
    """Turns with faults planted by crc32 of ``conv_id:turn``; n is the number
    of equal copies (0: dropped)."""
    def text(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    k = F.pmod(F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))), F.lit(20))
    return turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), k.alias("__k")).select(
        "conv_id", "turn", F.when(F.col("__k") == 0, "").when(F.col("__k") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("__k").isin(0, 1), "").when(F.col("__k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("__k") == 0, 0).when(F.col("__k") == 3, 2).otherwise(1).alias("n"))
