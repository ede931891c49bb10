import random
import re

import pytest
from pyspark.sql import functions as F

from courtside.llm import common, url_filter

PAGES = "page_id long, url string, html string, host string, verdict string, `row` int, `a.b` int"
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"), ("Sub.Example.com", "/de/ok", "allow"), ("twice.org", "/", "allow"),
         ("twice.org", "/", "block"), ("bare.io", "", "block")]


def page(i, url):
    return (i, url, "<p>", "own", "own", 5, 1)


def host_and_path(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def brute(url, listed):
    host, path = host_and_path(url)
    fits = [(len(h + p), len(h), h.lower() + p, v) for h, p, v in RULES if "://" in (url or "")
            and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    rule, verdict = max(fits)[2:] if fits else (None, "block" if listed else "allow")
    return host, path, rule, verdict


@pytest.fixture(scope="module")
def urls():
    r = random.Random(3)
    hosts = ["a.net", "net", "x.example.net", "example.com", "b.example.com", "sub.example.com", "c.sub.example.com",
             "myexample.com", "z.org", "ORG", "twice.org", "u.twice.org", "bare.io", "q.bare.io", "plain.test", "net."]
    paths = ["", "/", "/en/1", "/de/", "/de/ok/7", "/fr/2", "/fr", "/x", "/EN/1"]
    made = [f"{r.choice(['http', 'HTTPS', ''])}://{r.choice(['', 'www.'])}{h}{p}{r.choice(['', '?a=1', '#f', '?utm_x=2&b=1#g'])}"
            for h in hosts for p in paths]
    odd = [None, "", "no scheme net/", "://", "http://", "http:///en/", "a://b://net/", "http://é.net/ü",
           "http://plain.test/" + "long/" * 20_000, "http://" + "x." * 3_000 + "net/", "http://n\net/\nx",
           "http://www.plain.test:80/x/?utm_q=1#z"]
    return made + odd + ["http://common.net/en/"] * 400


@pytest.mark.parametrize("max_blocks", [1, 65_536])
def test_verdicts_equal_brute_force(spark, urls, max_blocks):
    rows = [page(i % 50 if i % 7 else None, u) for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, PAGES)
    rules = spark.createDataFrame(RULES + [(None, "/", "block"), ("x", None, "block")],
                                  "host string, path string, verdict string")
    listed = spark.createDataFrame([("plain.test/x",), ("z.org?b=1",), (None,)], "canonical string")
    got = sorted((map(tuple, url_filter.judge(pages, rules, listed, max_blocks)
                      .select("page_id", "host", "path", "rule", "verdict").collect())), key=repr)
    want = []
    for (i, u, *_), canonical in zip(rows, map(canonical_of, urls)):
        want.append((i, *brute(u, canonical in ("plain.test/x", "z.org?b=1"))))
    assert got == sorted(want, key=repr)
    assert any(w[4] == "block" and w[3] is None for w in want)


def canonical_of(url):
    host, path = host_and_path(url)
    if "://" not in (url or ""):
        return None
    found = re.search(r"\?([^#]*)", url[url.find("://") + 3:].split("#")[0])
    kept = sorted(p for p in (found.group(1).split("&") if found else [])
                  if p and not re.match(url_filter.TRACKING, p))
    return re.sub(r"^www\.|:(80|443)\Z", "", host) + re.sub(r"/\Z", "", path) + ("?" + "&".join(kept) if kept else "")


def test_filter_passes_every_listed_key_and_few_others(spark):
    listed = spark.range(5000).select(F.concat(F.lit("u:"), F.col("id")).alias("key"))
    blocks = url_filter.block_count(5000)
    made = url_filter.bloom_blocks(listed, blocks)
    assert made.count() <= blocks
    passed = url_filter.possible_hits(spark.range(50_000).select(F.concat(F.lit("u:"), F.col("id")).alias("key")), made, blocks)
    assert passed.where("cast(substr(key, 3) as int) < 5000").count() == 5000
    assert passed.count() < 5000 + 450  # one in a hundred
    assert url_filter.block_count(10 ** 12) == url_filter.MAX_BLOCKS


def test_empty_tables(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    none = spark.createDataFrame([], "canonical string")
    assert url_filter.judge(spark.createDataFrame([], PAGES), rules, none).count() == 0
    one = url_filter.judge(spark.createDataFrame([page(1, "http://a.net/")], PAGES), rules, none).collect()
    assert [(r.host, r.rule, r.verdict, r.listed) for r in one] == [("a.net", None, "allow", False)]


def test_frequent_keys_join_like_the_others(spark, monkeypatch):
    rows = spark.createDataFrame([("a",)] * 90 + [("b",), ("c",), (None,)], "key string")
    facts = spark.createDataFrame([("a", 90, 1), ("b", 1, 2)], "key string, n int, v int")
    monkeypatch.setattr(common, "SHARE", 10)
    left = common.join_facts(rows, facts, "key", "n")
    assert sorted(left.groupBy("key", "v").count().collect(), key=repr) == sorted(
        [("a", 1, 90), ("b", 2, 1), ("c", None, 1), (None, None, 1)], key=repr)
    assert common.join_facts(rows, facts, "key", "n", "inner").count() == 91
