"""Rules against a plain scan; trie and join agree."""

import itertools

from llm import url_filter
from llm.url_filter import RULES, judge_urls

LIST = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("a.com", "block"), ("com/", "block"), ("com/", "allow")]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, "block"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut].lower(), rest[cut:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    best = None
    for rule, verdict in LIST:
        own, slash, start = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith(slash + start):
            rank = (own.count(".") + 1, len(slash + start), verdict == "block", rule, verdict)
            best = max(best or rank, rank)
    if best:
        return host, path, best[3], best[4]
    return host, path, None, "allow" if host else "block"


def test_rules(spark, monkeypatch):
    hosts = ["org", "Example.ORG", "x.example.org", "notexample.org", "a.com", "b.a.com", "com", "net", "", "a..com", "example.org:80"]
    tails = ["", "/", "/es", "/es/", "/en/1", "/en/12/x", "/en/2", "/fr/?a=/es/", "?x", "#/es/", "//es/"]
    urls = [None, "", "no scheme", *(f"http://{h}{t}" for h, t in itertools.product(hosts, tails)), "http://org/", "http://org/"]
    pages = spark.createDataFrame([(k, u, "old") for k, u in enumerate(urls)], "page_id long, url string, rule string")
    rules = spark.createDataFrame([*LIST, (None, "allow"), ("x/", None)], RULES)
    want = {k: plain(u) for k, u in enumerate(urls)}
    for bound in (url_filter.MAX_TRIE_RULES, 1):
        monkeypatch.setattr(url_filter, "MAX_TRIE_RULES", bound)
        rows = judge_urls(pages, rules).collect()
        assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows} == want
    assert judge_urls(pages.limit(0), rules).collect() == []
    assert {r["verdict"] for r in judge_urls(pages, rules.limit(0)).collect()} == {"allow", "block"}
