"""URL filter: a bit-parallel wildcard automaton over canonical URLs.

All rules are globs packed into one multiword Shift-And automaton: every
glob symbol owns one bit, a ``*`` is a self-loop on the bit before it, and
one step per character (shift, mask, self-loop) advances every rule at
once.  A batch of URLs is stepped together, longest first, so the work is
(characters x machine words) numpy operations and memory is bounded by a
fixed number of state words.

Canonical URL: ``"." + host + path``.  Host: what follows the first
``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from
there up to ``?``, ``#`` or the end.  No ``://`` or null: both empty.

Cases: null, empty or scheme-less URLs have empty host and path and fit
only rules whose glob accepts them (domain rules never do); repeated rows
are judged alike; ties between rules of equal length go to ``block``, then
to the rule listed first; extra columns pass through, columns named like
the outputs are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.session import ensure_shipped

STATE_WORDS = 1 << 21  # state words held at once (16 MB)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HOST_RE = r"(?s)^.*?://([^/?#]*)"
_PATH_RE = r"(?s)^.*?://[^/?#]*([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``rule`` is ``host/path`` for a domain rule (that host and its
    subdomains, paths that start with the given one) or, with
    ``glob=True``, a glob over ``.host/path``: ``*`` any run without ``/``,
    ``**`` any run, ``?`` one character.  Domain rules go before globs, the
    longest wins."""

    verdict: str
    rule: str
    glob: bool = False

    def pattern(self) -> str:
        return self.rule if self.glob else f"*.{self.rule}**"


class ShiftAnd:
    """Rules compiled to bit masks; ``best`` gives the winning rule of each
    canonical URL (its index, or -1)."""

    def __init__(self, rules: Iterable[Rule]):
        self.rules = list(rules)
        if any(r.verdict not in ("allow", "block") for r in self.rules):
            raise ValueError("a rule's verdict is allow or block")
        step: list[object] = []   # per bit: literal, "?" as None, or start marker
        loop: list[str | None] = []  # per bit: None, "*" or "**"
        self.final: list[int] = []
        start: list[int] = []
        for r in self.rules:
            start.append(len(step))
            step.append("start")
            loop.append(None)
            p, i = r.pattern(), 0
            while i < len(p):
                if p[i] == "*":
                    double = p[i:i + 2] == "**"
                    loop[-1] = "**" if double or loop[-1] == "**" else "*"
                    i += 2 if double else 1
                else:
                    step.append(("any",) if p[i] == "?" else p[i])
                    loop.append(None)
                    i += 1
            self.final.append(len(step) - 1)
        self.words = max(1, -(-len(step) // 64))
        letters = sorted({s for s in step if isinstance(s, str) and len(s) == 1} | {"/"})
        self.alphabet = np.array([ord(c) for c in letters], np.uint32)  # sorted
        other = len(letters)
        masks = np.zeros((other + 1, 2, self.words), np.uint64)
        for bit, (s, lp) in enumerate(zip(step, loop)):
            w, b = bit // 64, np.uint64(1) << np.uint64(bit % 64)
            for c in range(other + 1):
                ch = letters[c] if c < other else None
                if s == ("any",) and ch != "/" or isinstance(s, str) and s == ch:
                    masks[c, 0, w] |= b
                if lp == "**" or lp == "*" and ch != "/":
                    masks[c, 1, w] |= b
        self.masks = masks
        self.init = np.zeros(self.words, np.uint64)
        for s in start:
            self.init[s // 64] |= np.uint64(1) << np.uint64(s % 64)
        #: ascending: a later entry wins
        self.order = sorted(range(len(self.rules)), key=lambda k: (
            not self.rules[k].glob, len(self.rules[k].rule), self.rules[k].verdict == "block", -k))

    def best(self, subjects: list[str]) -> np.ndarray:
        out = np.full(len(subjects), -1, np.int64)
        rows = max(1, STATE_WORDS // self.words)
        for a in range(0, len(subjects), rows):
            out[a:a + rows] = self._best(subjects[a:a + rows])
        return out

    def _best(self, subjects: list[str]) -> np.ndarray:
        n = len(subjects)
        lens = np.fromiter((len(s) for s in subjects), np.int64, n)
        by_len = np.argsort(-lens, kind="stable")
        chars = np.frombuffer("".join(subjects).encode("utf-32-le", "surrogatepass"), np.uint32)
        pos = np.searchsorted(self.alphabet, chars)
        pos[pos == len(self.alphabet)] = 0
        cls = np.where(self.alphabet[pos] == chars, pos, len(self.alphabet))
        first = (np.cumsum(lens) - lens)[by_len]
        sorted_lens = lens[by_len]
        state = np.tile(self.init, (n, 1))
        for j in range(int(lens.max(initial=0))):
            live = int(np.searchsorted(-sorted_lens, -j, side="left"))  # lens > j
            c = cls[first[:live] + j]
            d = state[:live]
            shifted = d << np.uint64(1)
            if self.words > 1:
                shifted[:, 1:] |= d[:, :-1] >> np.uint64(63)
            state[:live] = (shifted & self.masks[c, 0]) | (d & self.masks[c, 1])
        best = np.full(n, -1, np.int64)
        for k in self.order:
            f = self.final[k]
            best[(state[:, f // 64] >> np.uint64(f % 64)) & np.uint64(1) == 1] = k
        out = np.empty(n, np.int64)
        out[by_len] = best
        return out


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _HOST_RE, 1), F.lit("")), _UPPER, _UPPER.lower())


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PATH_RE, 1), F.lit(""))


def filter_urls(df: DataFrame, rules: Iterable[Rule], url: str = "url") -> DataFrame:
    """Adds host, path, rule (the domain rule that decided, else null), glob
    (the glob rule that decided, else null) and verdict (``allow`` where
    nothing fits).  One pass, no shuffle; the automaton travels with the
    task and its size is that of the rule list."""
    ensure_shipped(df.sparkSession)
    automaton = ShiftAnd(rules)
    result = T.StructType([T.StructField(c, T.StringType()) for c in ("rule", "glob", "verdict")])

    @F.pandas_udf(result)
    def judge(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        best = automaton.best(("." + host + path).tolist())
        won = [automaton.rules[k] if k >= 0 else None for k in best]
        return pd.DataFrame({
            "rule": [r.rule if r and not r.glob else None for r in won],
            "glob": [r.rule if r and r.glob else None for r in won],
            "verdict": [r.verdict if r else "allow" for r in won]}, dtype=object)

    outs = ("host", "path", "rule", "glob", "verdict")
    rest = [df[c] for c in df.columns if c not in outs or c == url]
    found = df.select(*rest, url_host(df[url]).alias("__host"), url_path(df[url]).alias("__path"))
    judged = found.withColumn("__judged", judge("__host", "__path"))
    keep = [F.col(c) for c in df.columns if c not in outs]
    return judged.select(*keep, F.col("__host").alias("host"), F.col("__path").alias("path"),
                         *[F.col(f"__judged.{c}").alias(c) for c in outs[2:]])
