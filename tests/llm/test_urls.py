"""URL filters against plain Python, and the cascade's exactness."""

import random
import re

import pytest

from keyfold.llm import urls
from keyfold.llm.queries import URL_RULES

URLS = [
    None,
    "",
    "no scheme/net",
    "http://a.NET",
    "http://a.NET/",
    "https://www.example.net/en/1?x=/de/#y",
    "https://example.net/EN/1",
    "https://notexample.net/en/1",
    "ftp://example.com/de/#t",
    "http://x.example.com/de",
    "http://org/fr/?q=://b.net/",
    "://net/",
    "http://casino.org/fr/1",
    "http://casino.org/1",
    "http://É.Casino.com/a b\nc",
    "http://a.net:80/x",
    "http://a.com/" + "x" * 100_000,
]


def brute(url, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    verdict = best.verdict if best else "block" if host in listed else "allow"
    return host, path, best and best.text, verdict


def test_rules_and_list(spark):
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate([*URLS, *URLS])], "page_id BIGINT, url STRING, host STRING")
    hosts = pages.select(urls.host_of(pages.url).alias("key"))
    listed = spark.createDataFrame([("casino.org",), ("é.casino.com",), (None,), ("casino.org",)], "key STRING")
    rows = urls.filter_urls(pages, URL_RULES, urls.build_cascade(hosts, listed)).collect()
    assert len(rows) == 2 * len(URLS)
    for row in rows:
        url = URLS[row.page_id % len(URLS)]
        assert (row.host, row.path, row.rule, row.verdict) == brute(url, {"casino.org"})


def test_no_pages_and_no_list(spark):
    pages = spark.createDataFrame([], "page_id BIGINT, url STRING")
    nothing = spark.createDataFrame([], "key STRING")
    cascade = urls.build_cascade(nothing, nothing)
    assert cascade.levels == []
    assert urls.filter_urls(pages, URL_RULES, cascade).count() == 0


@pytest.mark.parametrize("filter_bytes", [urls.FILTER_BYTES, 0])
def test_cascade_is_exact_in_many_shards(spark, monkeypatch, filter_bytes):
    monkeypatch.setattr(urls, "KEYS_PER_SHARD", 40)
    monkeypatch.setattr(urls, "FILTER_BYTES", filter_bytes)
    rng = random.Random(3)
    keys = [f"k{rng.randrange(10**9)}" for _ in range(3000)] + [""]
    listed = set(rng.sample(keys, 200))
    universe = spark.createDataFrame([(k,) for k in [*keys, None]], "key STRING")
    cascade = urls.build_cascade(universe, spark.createDataFrame([(k,) for k in sorted(listed)], "key STRING"))
    assert cascade.shards == 5 and len(cascade.levels) >= 2
    found = urls.with_listed(universe, "key", cascade).collect()
    assert len(found) == len(keys) + 1
    assert all(r.listed == (r.key in listed) for r in found)
    plan = urls.with_listed(universe, "key", cascade)._jdf.queryExecution().executedPlan().toString()
    assert ("Join" in plan) == (filter_bytes == 0)
