"""The automaton against regular expressions, host rules against the definition."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm.url_filter import Automaton, GlobRule, HostRule, UrlJudge, canonical, filter_urls


def as_regex(glob):
    out, i = "", 0
    while i < len(glob):
        if glob.startswith("**", i):
            out, i = out + ".*", i + 2
        elif glob[i] == "*":
            out, i = out + "[^/]*", i + 1
        elif glob[i] == "?":
            out, i = out + "[^/]", i + 1
        else:
            out, i = out + re.escape(glob[i]), i + 1
    return re.compile(out, re.DOTALL)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab/*?.", max_size=14), min_size=1, max_size=12), st.lists(st.text("ab/.", max_size=12), max_size=12))
def test_automaton_matches_regex(globs, texts):
    hits = Automaton(globs).match([t.encode() for t in texts])
    for i, t in enumerate(texts):
        for g, glob in enumerate(globs):
            assert hits[i, g] == bool(as_regex(glob).fullmatch(t)), (glob, t)


def test_patterns_across_words():
    globs = ["a" * 150 + "*" + "b" * 90, "*" + "c" * 64, "c" * 63 + "?"]
    texts = [b"a" * 150 + b"xx" + b"b" * 90, b"c" * 64, b"c" * 70, b"a" * 150 + b"/" + b"b" * 90, b""]
    want = [[bool(as_regex(g).fullmatch(t.decode())) for g in globs] for t in texts]
    assert Automaton(globs).match(texts).tolist() == want


RULES = [HostRule("allow", "org", "/"), HostRule("block", "example.org", "/es/"), HostRule("block", "example.org", "/en/1"),
         HostRule("allow", "com", "/fr/"), HostRule("block", "com", "/de/")]
URLS = {
    None: ("", "", None, "allow"), "": ("", "", None, "allow"), "no scheme": ("", "", None, "allow"),
    "http://Example.ORG/ES/": ("example.org", "/ES/", "org/", "allow"),
    "http://Example.ORG/es/x?y#z": ("example.org", "/es/x", "example.org/es/", "block"),
    "http://a.example.org/en/12": ("a.example.org", "/en/12", "example.org/en/1", "block"),
    "http://badexample.org/en/12": ("badexample.org", "/en/12", "org/", "allow"),
    "http://x.org": ("x.org", "", None, "allow"), "http://x.org?/": ("x.org", "", None, "allow"),
    "http://x.net/a.org/b": ("x.net", "/a.org/b", None, "allow"),
    "http://x.com/de/q": ("x.com", "/de/q", "com/de/", "block"), "com://com/fr/": ("com", "/fr/", "com/fr/", "allow"),
    "a://b://c/d": ("b:", "//c/d", None, "allow"), "http:///path": ("", "/path", None, "allow"),
    "http://x.net/é/file.pdf": ("x.net", "/é/file.pdf", None, "block"),
    "http://x.net/" + "long/" * 20000: ("x.net", "/" + "long/" * 20000, None, "allow"),
}


def test_rules(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS)] + [(None, "http://x.com/de/q", "x"), (0, None, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = filter_urls(pages, RULES, [GlobRule("block", "*/**.pdf")]).collect()
    assert len(got) == len(rows)
    urls = list(URLS)
    for r in got:
        url = "http://x.com/de/q" if r.page_id is None else urls[r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == URLS[url]


def test_longest_rule_wins_and_blocks_on_a_tie():
    judge = UrlJudge([HostRule("allow", "b.net", "/x"), HostRule("block", "a.b.net", "/"), HostRule("allow", "b.net", "/x/y/z")])
    _, _, rules, verdicts = judge.judge(["http://a.b.net/x", "http://a.b.net/x/y/z", "http://b.net/x"])
    assert rules == ["a.b.net/", "b.net/x/y/z", "b.net/x"] and verdicts == ["block", "allow", "allow"]


def test_canonical_lowers_ascii_only():
    assert canonical("http://ÄB.Org/P") == ("Äb.org", "/P")


def test_empty_table(spark):
    assert filter_urls(spark.createDataFrame([], "page_id long, url string"), RULES).collect() == []
