from __future__ import annotations

import itertools
import random

import pytest

from millrace.llm.url_filter import build_trie, judge_urls, match

RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
    ("block", "a.example.com/de/x/y"),
    ("allow", "example.com/d"),
    # Longer than a rule of a longer host, and as long as one with the other verdict.
    ("block", "net/en/a-path-longer-than-any-host"),
    ("block", "com/de/x/yzabc"),
    ("allow", "example.com/de"),
    ("allow", "m/de/x/yzabcdef"),
)


def by_hand(host, path):
    best = None
    for verdict, rule in RULES:
        rule_host, slash, rest = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rest):
            rank = (len(rule), verdict == "block", len(rule_host))
            best = max(best or (rank, rule, verdict), (rank, rule, verdict))
    return best[1:] if best else None


def test_match_is_the_longest_rule():
    hosts = ["net", "example.net", "a.example.net", "ample.net", "example.com", "a.example.com",
             "b.a.example.com", "org", "x.org", "", "net.", ".net", "com"]
    paths = ["/en/a-path-longer-than-any-host/x", "/de/x/yzabcdef", "", "/", "/en", "/en/", "/en/1", "/de/", "/de/x/y", "/de/x/yz", "/de/x/", "/d", "/fr/",
             "//en/", "/fr"]
    trie = build_trie(RULES)
    for host, path in itertools.product(hosts, paths):
        assert match(trie, host, path) == by_hand(host, path), (host, path)


def test_urls(spark):
    rng = random.Random(5)
    parts = ["http", "://", "Example", ".NET", "/", "en", "?", "#", "net", "É", ".org", "/fr/", "\n", ":80"]
    urls = [None, "", "no url", "://", "a://b://c/d"]
    urls += ["".join(rng.choices(parts, k=rng.randrange(9))) for _ in range(500)]
    pages = spark.createDataFrame(
        [(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, host string"
    )
    for row in judge_urls(pages, RULES, ["page_id", "host"]).collect():
        url = urls[row.page_id] or ""
        host = path = ""
        if "://" in url:
            rest = url.split("://", 1)[1]
            stop = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, tail = rest[:stop], rest[stop:]
            path = tail.split("?")[0].split("#")[0]
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        rule, verdict = by_hand(host, path) or (None, "allow")
        assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict)
    assert judge_urls(pages.limit(0), RULES, ["page_id"]).count() == 0


def test_wrong_rules():
    for rule in (("allow", "net"), ("deny", "net/"), ("allow", "/x")):
        with pytest.raises(ValueError):
            build_trie([rule])
