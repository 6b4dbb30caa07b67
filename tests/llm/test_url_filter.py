"""URL filter against brute force and its SQL."""

import random

from paymart.llm.url_filter import RULES, judge_urls, rule_table


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    ends = [i for i in (rest.find(c) for c in "/?#") if i >= 0]
    host = "".join(c.lower() if c.isascii() else c for c in rest[:min(ends)] if True) if ends else \
        "".join(c.lower() if c.isascii() else c for c in rest)
    tail = rest[min(ends):] if ends else ""
    path = "" if not tail.startswith("/") else tail[:min([i for i in (tail.find("?"), tail.find("#")) if i >= 0] or [len(tail)])]
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[3], max(fits)[2]) if fits else (host, path, None, "allow")


def check(spark, urls, rules):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(df, rule_table(spark, rules)).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_cases(spark):
    urls = [None, "", "no-scheme/en/", "http://", "http:///en/", "HTTP://A.Example.COM", "http://example.com",
            "http://example.com/", "https://example.com/en/1?x=/fr/", "https://www.example.com/en/#a/b",
            "http://blog.www.example.com/en/", "http://notexample.com/en/", "http://x.net/es", "http://x.net/es/",
            "http://net/fr/1", "http://a.b?c/net/fr/", "http://a://net/fr/", "http://x.NET/FR/", "http://É.com/",
            "http://x.com\n/en/", "http://..com/", "http://com./"]
    check(spark, urls, RULES)


def test_random_rules(spark):
    rnd = random.Random(3)
    labels, segments = ["a", "b", "c"], ["", "x", "y", "xy"]
    host = lambda: ".".join(rnd.choice(labels) for _ in range(rnd.randint(1, 4)))
    path = lambda: "/" + "/".join(rnd.choice(segments) for _ in range(rnd.randint(0, 4)))
    rules = list({(host(), path()[:rnd.randint(0, 6)]): 0 for _ in range(40)})
    rules = [(h, p, rnd.choice(["allow", "block"])) for h, p in rules]
    check(spark, [f"http://{host()}{path()}" for _ in range(300)], rules)


def test_no_rules_extra_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.com/", "x"), (1, "http://a.com/", "x")], "page_id long, url string, rule string")
    assert [tuple(r) for r in judge_urls(df, rule_table(spark, [])).collect()] == \
        [(1, "http://a.com/", "a.com", "/", None, "allow")] * 2
    assert judge_urls(df.limit(0), rule_table(spark)).collect() == []
    nulls = [(None, "/", "block"), ("a.com", None, "block"), ("a.com", None, "allow")]
    assert judge_urls(df, rule_table(spark, nulls)).first().verdict == "block"
