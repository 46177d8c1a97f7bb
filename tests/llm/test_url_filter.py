from __future__ import annotations

import random

import cases
import pytest
from pyspark.sql import functions as F

from tagloom.llm import url_filter

HOSTS = ("spam-farm.example.org", "cheap-pills.example.com", "free-bets.example.com")
URLS = [
    "http://www.example.com/en/1", "http://example.com/en/1", "http://a.example.com/EN/1",
    "https://WWW.Example.COM/en/?q#f", "http://b.net/es/", "http://b.net/es", "http://net/fr/x",
    "http://xnet/fr/x", "http://x.com", "http://x.com?a=/en/", "http://x.com#/en/", "http://x.com/",
    "ftp://x.org/a://b/c", "no scheme", "", None, "://", "http:///en/", "http://spam-farm.example.org/x",
    "http://" + "a." * 200_000 + "net/es/" + "x" * 200_000, "http://" + "." * 200_000,
    "http://a.spam-farm.example.org", "http://É.COM/é", "http://x.com:80/en/", "http://..com//", "a://b\n.com/x\ny",
]


def plain(url, rules, hosts):
    """Judges by trying every rule."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        stop = min((path.find(c) for c in "?#" if c in path), default=len(path))
        path = path[:stop]

    def under(parent):
        return host == parent or host.endswith("." + parent)

    fits = [(len(h + p), len(h), v, h + p) for v, h, p in rules if under(h) and path.startswith(p)]
    if fits:
        _, _, verdict, rule = max(fits)
        return host, path, rule, verdict
    return host, path, None, "block" if any(map(under, hosts)) else "allow"


def judged(spark, urls, **kw):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    rows = url_filter.judge_urls(df.repartition(3), **{"blocked_hosts": HOSTS, **kw}).collect()
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}


def test_urls_equal_a_plain_search(spark):
    got = judged(spark, URLS)
    for i, url in enumerate(URLS):
        assert got[i] == plain(url, url_filter.RULES, HOSTS), url


def test_many_rules(spark):
    rng = random.Random(4)
    names = ["a", "b", "c", "com", "net"]
    rules = {}
    for _ in range(300):
        host = ".".join(rng.choice(names) for _ in range(rng.randint(1, 3)))
        path = "/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, 3)))
        rules[host, path] = rng.choice(("allow", "block"))
    rules = [(v, h, p) for (h, p), v in rules.items()]
    urls = [
        "http://" + ".".join(rng.choice(names) for _ in range(rng.randint(1, 4))) + "/" + "".join(rng.choice("xy/") for _ in range(4))
        for _ in range(400)
    ]
    got = judged(spark, urls, rules=rules, blocked_hosts=["b.c"])
    assert all(got[i] == plain(u, rules, ["b.c"]) for i, u in enumerate(urls))


def test_colliding_digests_decide_nothing(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda data: len(data) % 3)
    path = tmp_path / "rules.idx"
    path.write_bytes(url_filter.index_bytes(url_filter.RULES, HOSTS))
    got = url_filter.Index(str(path)).judge(URLS)
    rows = list(zip(got["host"], got["path"], got["rule"], got["verdict"]))
    assert rows == [plain(u, url_filter.RULES, HOSTS) for u in URLS]


def test_no_rules_and_no_pages(spark):
    assert judged(spark, ["http://a.com/"], rules=[], blocked_hosts=[])[0] == ("a.com", "/", None, "allow")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(empty).count() == 0
    with pytest.raises(ValueError):
        url_filter.index_bytes([("allow", "a", "/"), ("block", "a", "/")], [])


def test_repeats_nulls_and_more_columns(spark):
    rows = [(1, "http://a.net/es/"), (1, "http://a.net/es/"), (None, None)]
    df = cases.clashing(spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS host", "1 AS rule"))
    got = sorted(map(str, url_filter.judge_urls(df).collect()))
    assert len(got) == 3 and got[0] == got[1] or got[1] == got[2]


def test_hosts_to_be_listed_are_those_with_a_name(spark):
    urls = [
        "http://m.free-bets.example.net/a", "HTTPS://X.Free-Bets.example.org?u=http://spam-farm.example.com", "http://free-bets-news.example.com/",
        "ftp://casino-win", "no host spam-farm.example.org", None, "http://a.example.com/spam-farm.", "http://m.free-bets.example.net/b",
    ]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    found = url_filter.hosts_named(pages)
    assert found == ["casino-win", "m.free-bets.example.net", "x.free-bets.example.org"]
    with pytest.raises(ValueError, match="more than 2"):
        url_filter.hosts_named(pages, most=2)
    judged = url_filter.judge_urls(pages.withColumn("page_id", F.lit(1)), blocked_hosts=found).collect()
    assert sorted(r.host for r in judged if r.rule is None and r.verdict == "block") == [
        "casino-win", "m.free-bets.example.net", "m.free-bets.example.net", "x.free-bets.example.org",
    ]
