"""URL filter against regular expressions and on odd inputs."""

import random
import re

import pytest

from kestrel.llm.urlfilter import Rule, ShiftAnd, filter_urls

RULES = [Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("allow", "com/fr/"), Rule("block", "com/"),
         Rule("block", "*spam*/**", glob=True), Rule("allow", "*.a?c.net/**x", glob=True)]


def as_regex(pattern: str) -> re.Pattern:
    out, i = "", 0
    while i < len(pattern):
        if pattern[i:i + 2] == "**":
            out, i = out + "(?s:.*)", i + 2
        else:
            out, i = out + {"*": "[^/]*", "?": "[^/]"}.get(pattern[i], re.escape(pattern[i])), i + 1
    return re.compile(out)


def brute(rules, subject):
    fits = [(not r.glob, len(r.rule), r.verdict == "block", -k) for k, r in enumerate(rules) if as_regex(r.pattern()).fullmatch(subject)]
    return -max(fits)[-1] if fits else -1


def test_automaton_equals_regex():
    rng = random.Random(5)
    many = RULES + [Rule(rng.choice(["allow", "block"]), f"{rng.choice('abc')}{k}.{rng.choice(['net', 'org'])}/{'p' * (k % 4)}") for k in range(60)]
    subjects = ["." + "".join(rng.choice(["org", "com", ".", "/", "fr", "es", "a", "spam", "example", "x", "net", "b7", "p", "é"])
                              for _ in range(rng.randint(0, 9))) for _ in range(800)]
    got = ShiftAnd(many).best(subjects)
    assert ShiftAnd(many).words > 1
    assert got.tolist() == [brute(many, s) for s in subjects]


def test_unknown_verdict():
    with pytest.raises(ValueError):
        ShiftAnd([Rule("maybe", "org/")])


def test_edges(spark):
    long = "https://www.EXAMPLE.org/es/" + "a/" * 20_000 + "?q#f"
    rows = [(1, None), (2, ""), (3, "no scheme.org/"), (4, "http://"), (5, "http://org"), (6, "http://org?x=/"), (7, "http://ÀB.org/?a"),
            (8, long), (9, "http://evil.net/x.org/"), (10, "a://b://c.org/"), (11, "http://xorg/"), (5, "http://org"), (12, "http://my-spam.net")]
    df = spark.createDataFrame([(i, u, "old", 1) for i, u in rows], "page_id int, url string, rule string, extra int")
    got = {(r.page_id): r for r in filter_urls(df, RULES).collect()}
    assert filter_urls(df, RULES).columns == ["page_id", "url", "extra", "host", "path", "rule", "glob", "verdict"]
    assert filter_urls(df, RULES).count() == len(rows)
    for k in (1, 2, 3, 4):
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == ("", "", None, "allow")
    assert got[5].host == "org" and got[5].path == "" and got[5].rule is None
    assert got[6].path == ""
    assert got[7].host == "Àb.org" and got[7].rule == "org/"
    assert got[8].rule == "example.org/es/" and got[8].verdict == "block" and len(got[8].path) > 40_000
    assert got[9].rule is None and got[10].host == "b:" and got[11].rule is None
    assert got[12].verdict == "allow"  # the glob wants a path
    empty = filter_urls(df.limit(0), RULES)
    assert empty.count() == 0 and empty.columns[-1] == "verdict"
    assert [r.verdict for r in filter_urls(df, []).collect()] == ["allow"] * len(rows)
