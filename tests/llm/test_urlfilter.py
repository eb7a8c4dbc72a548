import random

import pytest

from plumbline.llm import urlfilter

URLS = [
    None, "", "no scheme", "http://", "http:///x", "https://A.Example.COM/en/x?y#z", "ftp://example.com/en", "x://www.example.com/en/1",
    "x://w.www.example.com/en/1", "x://notexample.com/en/", "x://a.net/es/", "x://a.net/esx", "x://net/fr/?q", "x://a.net?/fr/",
    "x://a.net#/fr/", "x://com", "x://com/", "x://.com/", "x://example.com:80/en/", "a://b://c.com/x", "x://a.org/" + "p/" * 20_000,
    "x://é.com/ü", "x://example.com/en/\n/x",
]
RULES = [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
    ("net/fr/", "block"), ("org", "block"), ("both.org/a", "allow"), ("both.org/a", "block"),
]


def by_hand(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = ""
    while len(host) < len(rest) and rest[len(host)] not in "/?#":
        host = rest[: len(host) + 1]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for rule, verdict in rules:
        own, slash, tail = rule.partition("/")
        fits = host and (host == own or host.endswith("." + own)) and path.startswith(slash + tail)
        if fits and (best is None or (len(rule), len(own), verdict == "block") > best[0]):
            best = ((len(rule), len(own), verdict == "block"), rule, verdict)
    return host, path, best and best[1], best[2] if best else "allow"


@pytest.mark.parametrize("filter_keys", [5_000_000, 3])
def test_equals_rules_by_hand(spark, filter_keys):
    draw = random.Random(1)
    hosts = ["example.com", "www.example.com", "a.net", "net", "both.org", "q.both.org", "x.com"]
    urls = URLS + [f"s://{draw.choice(hosts)}{draw.choice(['', '/', '/a', '/en/', '/es/1', '/fr/x?y', '/En/'])}" for _ in range(300)]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id int, url string, URL string, rule string")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, rules, filter_keys=filter_keys).collect()}
    assert got == {i: by_hand(u, RULES) for i, u in enumerate(urls)}


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) AS key")
    universe = spark.range(40_000).selectExpr("concat('k', id * 2) AS key")
    levels = urlfilter.build_cascade(keys, universe)
    assert len(levels) > 2
    for i in range(3000):
        assert urlfilter.listed(f"k{i}", levels)
    assert not any(urlfilter.listed(f"k{i}", levels) for i in range(3000, 80_000, 2))


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id int, url string")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    assert urlfilter.judge(pages, rules).count() == 0
    some = spark.createDataFrame([(1, "x://a.com/")], "page_id int, url string")
    assert [tuple(r) for r in urlfilter.judge(some, rules.limit(0)).collect()] == [(1, "a.com", "/", None, "allow")]
