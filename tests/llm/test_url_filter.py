import time

from checks.compare import compare
from corpusloom.llm import url_filter
from corpusloom.llm.queries import llm_oracles, llm_queries
from corpusloom.llm.url_filter import ALLOW, BLOCK, UrlRule

RULES = (
    *url_filter.RULES,
    UrlRule(BLOCK, "net", "/"),
    UrlRule(ALLOW, "a.net", "/x"),
    UrlRule(ALLOW, "a.net", "/x/y/"),
    UrlRule(BLOCK, "a.net", "/x/y/z"),
    UrlRule(ALLOW, "b.net", "/"),
    UrlRule(BLOCK, "b.net", "/"),
    # The longest rule as a whole, though its host is shorter than that of another one.
    UrlRule(BLOCK, "net", "/a/very/long/path/"),
    UrlRule(ALLOW, "c.net", "/"),
    UrlRule(ALLOW, "d.net", "/ab"),
    UrlRule(BLOCK, "net", "/abcd"),
)

URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "http://org",
    "HTTP://WWW.Example.ORG/en/12?x=/es/#/es/",
    "https://example.org/es/1",
    "https://badexample.org/es/1",
    "https://x.org/es",
    "http://m.x.com/de/1",
    "http://com/fr/",
    "http://x.com/frog/",
    "http://x.com:80/fr/",
    "http://u@x.com/fr/#a",
    "http://x.com?a=/fr/",
    "a\nb://x.com/fr/\n?q",
    "http://a.net/xx",
    "http://a.net/x/y/",
    "http://a.net/x/y/zz/",
    "http://s.a.net/q",
    "http://b.net/q",
    "http://first://x.org/",
    "http://.org/",
    "http://x.org./a",
    "http://c.net/a/very/long/path/1",
    "http://c.net/a/very/long/pat",
    "http://d.net/abcdef",
    "http://net/" + "a/" * 5_000,
]


def by_hand(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [
        r for r in rules
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: (len(r.text), len(r.host), r.verdict), default=None)
    return host, path, best and best.text, best.verdict if best else ALLOW


def pages(spark, urls):
    rows = [(i, u, "x", "y", "z") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, rule string, host string")


def test_equals_sql(spark, small):
    ok, note = compare(spark, small, llm_queries()["op2_url_filter"], llm_oracles()["op2_url_filter"])
    assert ok, note


def test_trie_and_join_equal_brute_force(spark):
    urls = [*URLS, *URLS]
    wanted = [(i, *by_hand(u, RULES)) for i, u in enumerate(urls)]
    for limit in (url_filter.TRIE_CHARS, 0):
        got = url_filter.url_verdicts(pages(spark, urls), RULES, trie_chars=limit)
        assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == wanted


def test_no_rules_and_no_pages(spark):
    assert {r["verdict"] for r in url_filter.url_verdicts(pages(spark, URLS), ()).collect()} == {ALLOW}
    assert url_filter.url_verdicts(pages(spark, []), RULES).count() == 0


def test_many_rules_on_one_host_cost_little_a_url():
    rules = [UrlRule(BLOCK if i % 2 else ALLOW, "x.com", f"/p{i}") for i in range(200_000)]
    root = url_filter.build_trie(rules)
    paths = [f"/p{i * 37 % 300_000}/rest" for i in range(20_000)]
    started = time.process_time()
    found = [url_filter.find_rule(root, "www.x.com", path) for path in paths]
    assert time.process_time() - started < 2
    for path, rule in zip(paths[:300], found, strict=False):
        number = path.split("/")[1][1:]
        longest = max((n for n in range(1, len(number) + 1) if str(int(number[:n])) == number[:n] and int(number[:n]) < 200_000), default=0)
        assert rule.path == f"/p{number[:longest]}"
