from tessera.llm import url_filter
from tessera.llm.queries import URL_RULES

URLS = [
    "http://a.example.net/en/1", "http://a.example.net/de/1", "HTTP://Example.NET/en/", "http://example.net", "x://net/", "x://net", "http://b.example.com/de/x?y#z",
    "http://example.com/de", "http://w.org/fr/1", "http://notexample.net/en/", "ftp://c.d.example.org/fr/?q", "no scheme", "", None, "://", "http:///path", "a://b://c.net/x", "http://net?/en/", "http://example.net/en/", "http://example.net/en/",
]


def judged(url):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        for k, c in enumerate(rest):
            if c in "/?#":
                break
        else:
            k = len(rest)
        host, path = rest[:k].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), rest[k:]
        for c in "?#":
            path = path.split(c)[0]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_against_rules_read_one_by_one(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)], "page_id long, url string, host string, verdict string")
    out = url_filter.judge_urls(pages, URL_RULES).collect()
    assert len(out) == len(URLS)
    for r in out:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judged(URLS[r["page_id"]])


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20000).selectExpr("concat('k', id) as key")
    listed = spark.createDataFrame([(f"k{i * 7}",) for i in range(300)] + [("absent",), (None,), ("k7",)], "key string")
    cascade = url_filter.build_cascade(universe, listed)
    got = {r["key"] for r in universe.where(cascade.contains(universe["key"])).collect()}
    assert got == {f"k{i * 7}" for i in range(300)}
    assert len(cascade.levels) > 1


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(pages, URL_RULES).collect() == []
    nothing = url_filter.build_cascade(spark.createDataFrame([("a",)], "key string"), spark.createDataFrame([], "key string"))
    assert nothing.levels == ()
