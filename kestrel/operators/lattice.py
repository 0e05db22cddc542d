"""Words of unspaced text by a dictionary lattice.

Every dictionary word that fits at a place of the text is an edge (found in a
trie), and so are an unknown run of characters of one kind and its first
character alone; the cheapest path is the cut.  A word's cost is the negative
logarithm of its probability, which expectation maximisation learns from the
corpus itself: a round counts each word by the share of all paths' weight that
passes through it (forward and backward sums over the lattice).

The dictionary is the caller's (surface, part of speech, base form) and goes to
every task, so ``MAX_WORDS`` bounds it.  A round is one job over the distinct
runs of the corpus: they are counted once, written, and each task returns a row
per dictionary word at most.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import ensure_shipped, scratch_path

MAX_WORDS = 2_000_000
LONGEST_RUN = 4096  # characters of a lattice at once; longer runs are cut where one kind of character ends
UNKNOWN, EACH = 12.0, 2.0  # cost of an unknown run and of each of its characters
NOUN, OTHER = "名詞", "記号"


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(surface, pos, base) of a user dictionary in CSV: three columns, or the
    analyser format with context numbers and costs (part of speech fifth, base
    form eleventh)."""
    rows = spark.read.text(path).where("trim(value) <> ''").select(F.split("value", ",").alias("c"))
    get = lambda i: F.get("c", i)
    long = F.size("c") >= 11
    return rows.select(get(0).alias("surface"), F.when(long, get(4)).otherwise(get(1)).alias("pos"),
                       F.coalesce(F.nullif(F.when(long, get(10)).otherwise(get(2)), F.lit("*")), get(0)).alias("base"))


def kind(c: str) -> str:
    """Kind of a character: runs of one kind can be unknown words."""
    if "ぁ" <= c <= "ゟ":
        return "hiragana"
    if "゠" <= c <= "ヿ" or "ｦ" <= c <= "ﾟ":
        return "katakana"
    if "㐀" <= c <= "鿿" or "豈" <= c <= "﫿" or c == "々":
        return "kanji"
    major = unicodedata.category(c)[0]
    if major == "N":
        return "digit"
    return "letter" if major in "LM" else "space" if c.isspace() else "mark"


@dataclass
class Lattice:
    """Dictionary words by number, with costs, in a trie."""
    words: list[tuple[str, str, str]]  # surface, part of speech, base form
    costs: list[float]
    trie: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        for i, (surface, _, _) in enumerate(self.words):
            at = self.trie
            for c in surface:
                at = at.setdefault(c, {})
            at.setdefault("", []).append(i)

    def edges(self, text: str) -> Iterator[list[tuple[int, int]]]:
        """For each place: (end, word number; -1: unknown) of what starts there."""
        kinds = [kind(c) for c in text]
        ends = [len(text)] * len(text)
        for a in range(len(text) - 2, -1, -1):
            if kinds[a] != kinds[a + 1]:
                ends[a] = a + 1
            else:
                ends[a] = ends[a + 1]
        for a in range(len(text)):
            out, at = [], self.trie
            for b in range(a, len(text)):
                at = at.get(text[b])
                if at is None:
                    break
                out += [(b + 1, i) for i in at.get("", ())]
            out.append((a + 1, -1))
            if ends[a] > a + 1:
                out.append((ends[a], -1))
            yield out

    def cost(self, a: int, b: int, i: int) -> float:
        return self.costs[i] if i >= 0 else UNKNOWN + EACH * (b - a)

    def cut(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, word number) of the cheapest path; ties to fewer words,
        then to the earlier edge."""
        best: list[tuple[float, int]] = [(0.0, 0)] + [(math.inf, 0)] * len(text)
        back: list[tuple[int, int]] = [(0, -1)] * (len(text) + 1)
        for a, edges in enumerate(self.edges(text)):
            for b, i in edges:
                way = (best[a][0] + self.cost(a, b, i), best[a][1] + 1)
                if way < best[b]:
                    best[b], back[b] = way, (a, i)
        out, b = [], len(text)
        while b:
            a, i = back[b]
            out.append((a, b, i))
            b = a
        return out[::-1]

    def expected(self, text: str) -> dict[int, float]:
        """Expected number of each dictionary word over all paths."""
        edges = list(self.edges(text))
        n = len(text)

        def plus(x: float | None, y: float) -> float:
            if x is None:
                return y
            return max(x, y) + math.log1p(math.exp(-abs(x - y)))

        # logarithms of the sums over paths from the start and to the end
        ahead: list[float | None] = [0.0] + [None] * n
        for a in range(n):
            for b, i in edges[a]:
                ahead[b] = plus(ahead[b], ahead[a] - self.cost(a, b, i))
        behind: list[float | None] = [None] * n + [0.0]
        for a in range(n - 1, -1, -1):
            for b, i in edges[a]:
                behind[a] = plus(behind[a], behind[b] - self.cost(a, b, i))
        out: dict[int, float] = {}
        for a in range(n):
            for b, i in edges[a]:
                if i >= 0:
                    out[i] = out.get(i, 0.0) + math.exp(ahead[a] - self.cost(a, b, i) + behind[b] - ahead[n])
        return out

    def tokenize(self, text: str) -> Iterator[tuple[str, str]]:
        """(base form, part of speech) of the words of a text."""
        for run in runs(text):
            for a, b, i in self.cut(run):
                if i >= 0:
                    yield self.words[i][2], self.words[i][1]
                else:
                    yield run[a:b], OTHER if kind(run[a]) in ("mark", "hiragana") else NOUN


def runs(text: str) -> Iterator[str]:
    """What lies between white space; longer runs than LONGEST_RUN end where
    the kind of character changes, or at that length."""
    for run in text.split():
        while len(run) > LONGEST_RUN:
            at = next((k for k in range(LONGEST_RUN, LONGEST_RUN // 2, -1) if kind(run[k - 1]) != kind(run[k])), LONGEST_RUN)
            yield run[:at]
            run = run[at:]
        yield run


def _lattice(words: list[tuple[str, str, str]], counts: list[float]) -> Lattice:
    total = sum(counts)
    return Lattice(words, [-math.log(c / total) for c in counts])


def fit(df: DataFrame, col: str, dictionary: DataFrame, rounds: int = 4, prior: float = 0.1) -> Lattice:
    """The lattice of ``dictionary`` (surface, pos, base) with costs learnt from
    the texts of ``col`` (lower case, as they will be cut).  Every word starts
    alike and keeps ``prior`` of a count.  Equal entries count once; empty
    surfaces are left out."""
    spark = df.sparkSession
    ensure_shipped(spark)
    entries = dictionary.select(*[F.col(c).cast("string").alias(c) for c in ("surface", "pos", "base")])
    entries = entries.where("surface <> ''").distinct().orderBy("surface", "pos", "base").limit(MAX_WORDS + 1).collect()
    if len(entries) > MAX_WORDS:
        raise ValueError(f"a dictionary of more than {MAX_WORDS} words")
    words = [(r["surface"], r["pos"], r["base"]) for r in entries]
    lattice = _lattice(words, [1.0] * len(words)) if words else Lattice([], [])
    if not words:
        return lattice
    path = scratch_path(spark, "lattice")

    @F.udf("array<string>")
    def cut_runs(text: str | None) -> list[str]:
        return list(runs(text or ""))

    # white space is cut in the JVM; only long runs are looked at in Python
    run = F.explode(F.split(F.col(col).cast("string"), r"\s+")).alias("run")
    texts = df.select(run).where("run <> ''")
    texts = texts.where(F.length("run") <= LONGEST_RUN).unionByName(
        texts.where(F.length("run") > LONGEST_RUN).select(F.explode(cut_runs("run")).alias("run")))
    texts.groupBy("run").agg(F.count("*").alias("n")).write.parquet(path)
    texts = spark.read.schema("run string, n long").parquet(path)
    for _ in range(rounds):
        shipped = spark.sparkContext.broadcast(lattice)

        def expect(batches: Iterable[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            counts: dict[int, float] = {}
            for b in batches:
                for text, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    for i, x in shipped.value.expected(text).items():
                        counts[i] = counts.get(i, 0.0) + n * x
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.float64())], names=["i", "x"])

        told = texts.mapInArrow(expect, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()  # a row a word
        counts = [prior] * len(words)
        for r in told:
            counts[r["i"]] += r["x"]
        lattice = _lattice(words, counts)
        shipped.unpersist()
    return lattice
