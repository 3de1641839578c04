from __future__ import annotations

import re

import pytest

from boxoffice.llm.url_filter import HOST_RULES, PATTERN_RULES, RuleIndex, filter_urls, host_rule, pattern_rule, split_url

URLS = [
    "http://a.com/x",
    "http://a.com",
    "HTTP://WWW.Example.COM/en/1?x=//net/es/",
    "http://example.com/en/",
    "http://example.com/EN/",
    "http://xexample.com/en/1",
    "http://a.www.example.com/en/x#y",
    "http://b.example.com/en/9",
    "https://q.net/es/1",
    "https://q.net/es",
    "https://q.net/de/casino",
    "https://casino.net/de/",
    "http://free-bets.example.org/x",
    "http://free-betsy.example.org/x",
    "ftp://h.org/setup.EXE",
    "ftp://h.org/setup.exe?v=1",
    "ftp://h.org/setup.exec",
    "no scheme example.com/en/",
    "",
    None,
    "http://com/",
    "://net/fr/",
    "a://b://net/fr/x",
    "http://net:80/fr/",
    "http://u@net/fr/",
    "http://\u00e9.com/\n",
]


def plain(url):
    """Every rule is tried, hosts by comparing strings."""
    host, path = split_url(url)
    fits = [
        r
        for r in HOST_RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    if fits:
        best = max(fits, key=lambda r: len(r.name))
        return best.name, best.verdict, None
    hits = sorted(r.name for r in PATTERN_RULES if re.search(r.pattern, url or "", re.DOTALL))
    return (None, "block", hits[0]) if hits else (None, "allow", None)


@pytest.mark.parametrize("url", URLS)
def test_index_gives_what_trying_all_rules_gives(url):
    assert RuleIndex(HOST_RULES + PATTERN_RULES, {}).judge(url) == plain(url)


def test_split():
    assert split_url("HTTP://Ab.C/d/E?f#g") == ("ab.c", "/d/E")
    assert split_url("x://h#/p?q") == ("h", "")
    assert split_url("x") == split_url(None) == ("", "")


def test_only_candidates_run():
    rules = [pattern_rule("block", str(i), f"rare{i}", ("common", f"rare{i}")) for i in range(500)]
    index = RuleIndex(rules, {"common": 10**6})
    assert [r.name for r in index.fitting("http://common/rare7/common")] == ["7"]
    assert index.tried == 1


def test_rows(spark):
    rows = [(i // 2 if i else None, u, "x") for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string").repartition(3)
    got = sorted(filter_urls(pages).collect(), key=str)
    want = sorted(((i, *split_url(u), *plain(u)) for i, u, _ in rows), key=str)
    assert sorted(map(tuple, got), key=str) == want
    assert filter_urls(pages.where("false")).collect() == []
    assert {r.verdict for r in filter_urls(pages, [host_rule("block", "org/")]).collect()} == {"allow", "block"}
    assert {r.verdict for r in filter_urls(pages, []).collect()} == {"allow"}
