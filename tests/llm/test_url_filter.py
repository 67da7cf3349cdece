import re

from reachset.llm.url_filter import RULES, judge_urls, rules_table

URLS = [
    "http://a.example.net/en/1?x", "HTTP://Sub.EXAMPLE.net/en", "https://net/", "http://net", "ftp://x.net?y",
    "http://example.org/fr/1#t", "http://org/fr/", "http://example.com/de/x", "http://example.com/fr/de/",
    "http://notexample.com/de/", "example.net/en/", "", None, "http://", "http:///path", "://h.net/a",
    "http://a.net:80/", "http://u@a.net/", "http://a..net/", "http://é.NET/Ä", "http://x.net/a\nb", "http://h.org/fr",
    "http://" + "a." * 300 + "net/" + "p/" * 2000,
]


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), len(h), a == "block", h + p, a)
        for a, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, max(fits)[3], max(fits)[4]) if fits else (host, path, None, "allow")


def check(spark, rules):
    pages = spark.createDataFrame(
        [(i, u, "x", 1) for i, u in enumerate(URLS)] + [(None, URLS[0], "x", 1), (0, URLS[0], "x", 1)],
        "page_id long, url string, short string, host int",
    )
    got = judge_urls(pages, rules_table(spark, rules)).collect()
    want = [(i, *brute(u, rules)) for i, u in enumerate(URLS)]
    want += [(None, *brute(URLS[0], rules)), (0, *brute(URLS[0], rules))]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_the_rules(spark):
    check(spark, RULES)


def test_precedence_and_rules_that_end_inside_a_name(spark):
    check(spark, [*RULES, ("block", "example.net", "/en/"), ("block", "a.example.net", "/e"), ("allow", "org", "/f")])


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(pages, rules_table(spark)).count() == 0
