import random
import re

import pytest
from pyspark.sql import functions as F

from halocline.llm.url_filter import BLOCKED_HOSTS, RULES, Cascade, filter_urls, hashes, op4_url_filter

SF = "/root/testdata/sf0.001"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(url, rules=RULES, hosts=BLOCKED_HOSTS):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(LOW)
    under = lambda h: host == h or host.endswith("." + h)
    fit = [(len(h), len(p), h + p, v) for v, h, p in rules if under(h) and path.startswith(p)]
    listed = max((h for h in hosts if under(h)), key=len, default=None)
    rule = max(fit)[2] if fit else None
    return host, path, rule, listed, max(fit)[3] if fit else "block" if listed else "allow"


URLS = [None, "", "no scheme", "http://", "HTTP://A.NET", "http://a.net/", "http://net/x", "x://Example.Net/en/1?a#b", "http://example.net/en", "http://m.example.com/de/#", "http://org/fr/", "http://a.org?x=/fr/", "http://spam-farm.example.org", "http://www.SPAM-farm.example.org/fr/1", "http://a..net/", "http://.net/", "://x.net/y://z", "http://é.org/fr/é", "http://notexample.com/de/", "http://a b.net/ c", "http://x.net\n/en/\n1"]


def test_urls(spark):
    df = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(URLS)] + [(0, None, "h", 1)], "page_id long, url string, host string, found int")
    rows = filter_urls(df).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        assert (r.host, r.path, r.rule, r.listed_host, r.verdict) == plain(URLS[r.page_id])
    assert filter_urls(df.limit(0)).count() == 0
    assert {r.verdict for r in filter_urls(df, [], []).collect()} == {"allow"}
    assert sorted(filter_urls(df, max_bits=64).collect(), key=str) == sorted(rows, key=str)


@pytest.mark.parametrize("sizes", [{}, {"bits_per_key": 1}, {"max_bits": 2048}])
def test_cascade_is_exact(spark, sizes):
    rnd = random.Random(4)
    keys = [f"k{i}" for i in range(30000)]
    listed = set(rnd.sample(keys, 400)) | {"elsewhere"}
    u = spark.createDataFrame([(k,) for k in keys + keys[:50]], "key string")
    c = Cascade(u, spark.createDataFrame([(k,) for k in listed], "key string"), **sizes)
    levels = [c.levels(s) for s in range(c.shards)]
    assert c.shards > 1 if "max_bits" in sizes else len(levels[0]) > 1
    members = [r.key for s in range(c.shards) for r in u.distinct().where(c.member(s, levels[s], F.col("key"), *hashes(F.col("key")))).collect()]
    assert sorted(members) == sorted(listed - {"elsewhere"})


def test_table(spark):
    got = {r.page_id: (r.host, r.path, r.rule, r.listed_host, r.verdict) for r in op4_url_filter(spark, SF).collect()}
    assert got == {r.page_id: plain(r.url) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}


def test_a_long_list_as_a_table(spark):
    """120,000 listed hosts, half of which the corpus has, in several shards."""
    hosts = spark.range(120_000).select(F.concat(F.lit("Site"), F.col("id") * 2, F.lit(".example.info")).alias("host"))
    more = spark.createDataFrame([(None,), ("",), ("site0.example.info",), ("INFO2",)], "host string")
    pages = spark.range(120_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://www.site"), F.col("id"), F.lit(".example.info/x")).alias("url"))
    pages = pages.unionByName(spark.createDataFrame([(-1, "http://a.info2/"), (-2, "http://ainfo2/"), (-3, "http://site7.example.net/")], "page_id long, url string"))
    found = filter_urls(pages, hosts=hosts.unionByName(more), max_bits=1 << 18)
    wrong = found.where("page_id >= 0").where(F.col("listed_host").isNotNull() != (F.col("page_id") % 2 == 0))
    assert wrong.count() == 0
    named = found.where("page_id >= 0 and listed_host is not null and (listed_host <> concat('site', page_id, '.example.info') or verdict <> 'block')")
    assert named.count() == 0 and found.count() == 120_003
    assert {r.page_id: (r.listed_host, r.rule, r.verdict) for r in found.where("page_id < 0").collect()} == {-1: ("info2", None, "block"), -2: (None, None, "allow"), -3: (None, "net/", "block")}
