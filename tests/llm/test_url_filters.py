from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from subledger.llm.url_filters import KINDS, RULES, Automaton, Rule, filter_urls


def slow_match(glob: str, text: str) -> bool:
    pattern, at = "", 0
    while at < len(glob):
        if glob[at : at + 2] == "**":
            pattern, at = pattern + "(?s:.*)", at + 2
        else:
            c = glob[at]
            pattern += "[^/]*" if c == "*" else "[^/]" if c == "?" else re.escape(c)
            at += 1
    return re.fullmatch(pattern, text) is not None


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab/*?", max_size=12), min_size=1, max_size=30), st.lists(st.text("ab/", max_size=12), min_size=1, max_size=8))
def test_all_globs_at_once(globs, texts):
    globs = [g.replace("***", "**") for g in globs]
    automaton = Automaton(globs)
    states = automaton.run([t.encode() for t in texts])
    for at, glob in enumerate(globs):
        assert automaton.accepts(states, at).tolist() == [slow_match(glob, t) for t in texts], glob


def judged(spark, *urls):
    df = spark.createDataFrame([(n, u, "clash") for n, u in enumerate(urls)], "page_id bigint, url string, host string")
    return [tuple(r)[1:] for r in filter_urls(df, [*RULES, *KINDS]).orderBy("page_id").collect()]


def test_hosts_paths_and_longest_rule(spark):
    assert judged(
        spark, "http://EXAMPLE.org/es/x?q#f", "https://a.example.org/en/12", "http://example.org", "http://b.org/x", "x://y.com/fr/",
        "http://y.com/FR/", "https://y.com/de/1", "nothing", None, "http://z.net/example.org/es/", "http://www.casino-x.net/", "://?a/b",
        "http://evil.com/x.org/", "http://org/", "http://examples-example.org/es/", "http://h.org/a://example.org/es/",
    ) == [
        ("example.org", "/es/x", "example.org/es/", "block"), ("a.example.org", "/en/12", "example.org/en/1", "block"),
        ("example.org", "", None, "allow"), ("b.org", "/x", "org/", "allow"), ("y.com", "/fr/", "com/fr/", "allow"),
        ("y.com", "/FR/", None, "allow"), ("y.com", "/de/1", "com/de/", "block"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("z.net", "/example.org/es/", None, "allow"), ("www.casino-x.net", "/", None, "block"), ("", "", None, "allow"),
        ("evil.com", "/x.org/", None, "allow"), ("org", "/", "org/", "allow"), ("examples-example.org", "/es/", "org/", "allow"),
        ("h.org", "/a://example.org/es/", "org/", "allow"),
    ]


def test_ties_repeats_long_and_empty(spark):
    long = "http://a.org/" + "x" * 200_000
    assert judged(spark, long, long) == [("a.org", "/" + "x" * 200_000, "org/", "allow")] * 2
    two = [Rule("block", "*.org/**", 4, "first"), Rule("allow", "*.org/**", 4, "second")]
    df = spark.createDataFrame([(None, "http://a.org/")], "page_id bigint, url string")
    assert [tuple(r) for r in filter_urls(df, two).collect()] == [(None, "a.org", "/", "first", "block")]
    assert filter_urls(df.limit(0), two).collect() == []


def test_many_rules_span_words(spark):
    rules = [Rule.below("block", f"host{n}.net/a/") for n in range(500)]
    urls = [(n, f"http://www.host{n}.net/a/b") for n in range(0, 600, 7)]
    found = filter_urls(spark.createDataFrame(urls, "page_id bigint, url string"), rules).collect()
    assert {r.page_id: r.rule for r in found} == {n: f"host{n}.net/a/" if n < 500 else None for n, _ in urls}
