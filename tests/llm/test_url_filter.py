from pyspark.sql import functions as F

from phrasegrove.llm import url_filter as uf
from phrasegrove.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "https://NET/x", "https://a.net", "https://a.net/", "https://example.net/en/x?q#f",
    "https://www.EXAMPLE.net/en", "https://notexample.net/en/1", "https://b.example.com/de/7#top", "https://example.com/fr/7",
    "https://x.org/fr/", "https://x.org/fr", "https://xorg/fr/1", "https://y.com?x=/de/", "https://y.com#/a", "a://b://c/d",
    "https://listed.com/a/b", "http://LISTED.com/a/b?z=1", "https://listed.com/a/B", "https://..net//", "https://ü.net/é",
]
LISTED = [("listed.com", "/a/b"), ("example.net", "/en/x"), ("", "")]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.index(c) for c in "?#" if c in tail] + [len(tail)])]
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    return host, path, None, "block" if host + path and (host, path) in LISTED else "allow"


def frames(spark, urls):
    pages = spark.createDataFrame(list(enumerate(urls)) + [(None, "https://z.net/1")], "page_id bigint, url string")
    pages = pages.withColumns({c: F.lit(1) for c in ("host", "path", "key", "verdict", "block", "cut")})
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return pages, rules, spark.createDataFrame(LISTED, "host string, path string")


def test_against_brute_force(spark):
    urls = URLS + URLS[:7]
    got = {r.page_id: r[1:] for r in uf.judge(*frames(spark, urls)).collect()}
    assert len(got) == len(urls) + 1
    for i, url in enumerate(urls):
        assert got[i] == brute(url), url


def test_false_positives_are_removed(spark, monkeypatch):
    monkeypatch.setattr(uf, "BLOCKS", 1)
    pages, rules, _ = frames(spark, [f"https://h{i}.com/p{i}" for i in range(400)])
    listed = spark.createDataFrame([(f"h{i}.com", f"/p{i}") for i in range(0, 400, 2)], "host string, path string")
    got = {r.page_id: r.verdict for r in uf.judge(pages, rules, listed).collect()}
    assert all(got[i] == ("block" if i % 2 == 0 else "allow") for i in range(400))


def test_empty(spark):
    pages, rules, listed = frames(spark, URLS)
    assert uf.judge(pages.where("false"), rules, listed).collect() == []
    got = uf.judge(pages, rules.where("false"), listed.where("false")).collect()
    assert {r.verdict for r in got} == {"allow"}


def test_main_path_is_native_and_bounded(spark):
    plan = uf.judge(*frames(spark, URLS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
