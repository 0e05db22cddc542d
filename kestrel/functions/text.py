"""Text scalar functions for review cleaning and token handling."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for equal results)
# markers removed from the SUPPLEMENT and FOLLOWUP fields
SUPPLEMENT_MARKERS = ("<HTML>", "<XML>", "<SGML>")
FOLLOWUP_MARKERS = ("HTML", "<XML>", "<SGML>")
# literal replacements applied in this order before tokenising
PRESPLIT_RULES = (
    ("。)", "。 )"),
    (">。", "> 。)"),
    ("。<", "。 <)"),
    ("。。", "。 。"),
    (">。。<", "\n"),
    ("<HTML>", "\n"),
    ("<XML>", "\n"),
    ("<SGML>", "\n"),
)
# tokens dropped after tokenising
STOPLIST = ("<", ">", "。", "の", "する", "-", "+", "/", "[", "]", ".", "(", ")", ",", ":", ";",
            "=", "~", "%", "、")
# parts of speech kept when the tokenizer reports them (noun, adjective, verb)
CONTENT_POS = ("名詞", "形容詞", "動詞")
# ---------------------------------------------------------------------------


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace_all(c: str | Column, rules) -> Column:
    """Ordered literal replacements (no regex), JVM side."""
    out = _c(c)
    for a, b in rules:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def strip_markers(c: str | Column, markers=SUPPLEMENT_MARKERS) -> Column:
    """Remove each listed literal marker."""
    return replace_all(c, [(m, "") for m in markers])


def presplit_text(c: str | Column, rules=PRESPLIT_RULES, newline_to: str = "。") -> Column:
    """The ordered replacements around 。 < > and markers, then newline → 。"""
    return F.replace(replace_all(c, rules), F.lit("\n"), F.lit(newline_to))


def lower_strip(c: str | Column) -> Column:
    """Lower-case and strip leading/trailing whitespace (any \\s)."""
    return F.regexp_replace(F.regexp_replace(F.lower(_c(c)), r"^\s+", ""), r"\s+$", "")


def concat_fields(*cols: str | Column, sep: str = " ") -> Column:
    """Fields joined by a fixed separator; NULL fields count as ''
    (keeps every separator, unlike concat_ws)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(F.coalesce(_c(c), F.lit("")))
    return F.concat(*parts)


def url_tail(c: str | Column) -> Column:
    """Text after the last '/' (query string kept)."""
    return F.substring_index(_c(c), "/", -1)


def first_field(c: str | Column, sep: str = ",") -> Column:
    """First ``sep``-separated field."""
    return F.substring_index(_c(c), sep, 1)


def path_stem(c: str | Column, suffix: str = "") -> Column:
    """File name without directory and extension, plus ``suffix``."""
    base = F.substring_index(_c(c), "/", -1)
    return F.concat(F.regexp_replace(base, r"\.[^.]*$", ""), F.lit(suffix))


def regex_strip(c: str | Column, pattern: str) -> Column:
    """Remove every match of a (multi-line) regex."""
    return F.regexp_replace(_c(c), pattern, "")


@F.arrow_udf(T.StringType())
def nfkc_normalize(s: pa.Array) -> pa.Array:
    """Unicode NFKC (no Spark built-in); Arrow-batched.  A few rows at a time
    are Python strings, the rest of a batch stays Arrow; Spark ends a batch at
    its number of rows or bytes."""
    import unicodedata
    parts = [pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in s.slice(i, 64).to_pylist()], pa.string())
             for i in range(0, len(s), 64)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def stoplist_filter(tokens: str | Column, stop=STOPLIST) -> Column:
    """Drop listed tokens, keeping order and repeats."""
    arr = F.array(*[F.lit(s) for s in stop])
    return F.filter(_c(tokens), lambda t: ~F.array_contains(arr, t))


def join_tokens(tokens: str | Column, result_type: str = "str") -> Column:
    """'str' → space-joined text, 'list' → the array itself."""
    if result_type == "list":
        return _c(tokens)
    if result_type == "str":
        return F.array_join(_c(tokens), " ")
    raise ValueError(f"result_type must be 'str' or 'list', got {result_type!r}")
