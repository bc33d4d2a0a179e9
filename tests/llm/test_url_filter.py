import random

from kandela.llm import url_filter as U
from kandela.llm.queries import URL_RULES
from llm_cases import few_partitions  # noqa: F401

RULES = "host string, path string, verdict string"


def brute(url, rules, default="allow"):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else default


URLS = ["http://Example.COM/en/1?x=/fr/", "https://www.example.com/en/", "https://a.www.example.com/en/x#y", "https://net/es/", "https://notexample.com/en/",
        "ftp://b.net/fr", "https://b.net/fr/a", "no scheme/en/", None, "", "http://", "http:///en/", "https://com/", "https://x.com", "https://x.com?/", "://com/z",
        "http://ÄÖ.com/ü", "https://a.b.c.d.e.com/" + "p" * 5000, "http://com\n/x"]


def test_matches_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "<p>", "x") for i, u in enumerate(URLS * 2)], "page_id long, url string, html string, rule string")
    got = U.filter_urls(pages, spark.createDataFrame(URL_RULES, RULES)).collect()
    assert [r.asDict() for r in sorted(got)] == [dict(zip(["page_id", "host", "path", "rule", "verdict"], (i, *brute(u, URL_RULES)), strict=True)) for i, u in enumerate(URLS * 2)]


def test_long_lists_are_joined_with_the_same_result(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, RULES)
    assert sorted(U.filter_urls(pages, rules).collect()) == sorted(U.filter_urls(pages, rules, max_listed=0).collect())


def test_cascade_is_exact_over_its_universe(spark):
    random.seed(5)
    keys = [f"k{random.random()}" for _ in range(3000)]
    universe, listed = spark.createDataFrame([(k,) for k in keys], "key string"), set(keys[:200])
    levels = U.build_cascade(spark.createDataFrame([(k,) for k in listed], "key string"), universe)
    assert len(levels) > 1  # or nothing was tested
    assert {r.key for r in universe.where(U.in_cascade(levels, universe.key)).collect()} == listed


def test_empty_tables_and_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, RULES)
    assert U.filter_urls(pages.limit(0), rules).collect() == []
    assert [tuple(r) for r in U.filter_urls(pages, rules.limit(0)).collect()] == [(1, "a.com", "/", None, "allow")]
    assert [tuple(r) for r in U.filter_urls(pages, spark.createDataFrame([(None, "/", "block"), ("com", None, "block")], RULES)).collect()] == [(1, "a.com", "/", None, "allow")]


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    plan = U.filter_urls(pages, spark.createDataFrame(URL_RULES, RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan
