import numpy as np
import pytest
from pyspark.sql import functions as F

from intake.llm.queries import URL_RULES
from intake.llm.urls import Cascade, ask, build, is_listed, judged, shard_levels
from tests.llm.conftest import by_id


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def slow_verdict(host, path, listed):
    best = None
    for r in URL_RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path):
            best = r if best is None or len(r.name) > len(best.name) else best
    if best:
        return best.name, best.verdict
    return None, "block" if listed else "allow"


URLS = [
    "http://a.example.net/en/x", "HTTP://A.Example.NET/en", "http://example.net/en/", "http://notexample.net/en/1",
    "http://x.example.com/de/1?u=http://y.net/", "http://example.com/fr/1#top", "http://a.org/fr/", "http://org/fr/z",
    "http://net", "http://net/", "http://x.net?q=/a", "http://ÄÖ.com/É", "no scheme", "", None, "://", "http://", "x\ny://h\nost/p\nq",
    "http://example.com:80/de/", "http://" + "l" * 50000 + ".net/" + "p" * 50000, "a://b://c/d", "http://x.com/1", "http://x.com/1", "http://x.com/1?v=2",
]


def test_rules_and_parts(spark):
    rows = [(i, u, i % 2 == 0) for i, u in enumerate(URLS)]
    df = spark.createDataFrame(rows, "page_id long, url string, listed boolean").selectExpr("*", "'x' AS key", "'y' AS host", "1 AS shard")
    got = by_id(judged(df, URL_RULES, F.col("listed")), "host", "path", "rule", "verdict", key="page_id")
    listed = {parts(u) for _, u, on in rows if on and parts(u)[0]}
    for i, u, _ in rows:
        h, p = parts(u)
        assert got[i] == (h, p, *slow_verdict(h, p, (h, p) in listed)), u
    none = spark.createDataFrame([], df.schema)
    assert judged(none, URL_RULES, F.col("listed")).collect() == []


@pytest.mark.parametrize("share", [0.0, 0.001, 0.3, 0.999, 1.0])
def test_cascade_is_exact_on_its_universe(share):
    rng = np.random.default_rng(1)
    h1, h2 = (rng.integers(0, 2**64, 30000, np.uint64) for _ in range(2))
    listed = rng.random(30000) < share
    how = Cascade()
    levels = [np.frombuffer(b, np.uint8) for b in shard_levels(h1, h2, listed, how)]
    assert (ask(levels, h1, h2, how) == listed).all()
    assert sum(map(len, levels)) <= 30000 * 2.5


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_sent_and_sharded_answers_agree(spark, limit):
    rows = [(f"k{i % 4000}", i % 4000 % 7 == 0) for i in range(9000)] + [(None, True)]
    df = spark.createDataFrame(rows, "key string, listed boolean")
    how = Cascade(shard=500, broadcast=limit)
    filters, shards = build(df, how)
    assert shards == 8
    asked = df.select("key", F.col("listed").alias("want"))
    got = is_listed(asked, "key", filters, shards, how).collect()
    assert len(got) == 9001
    assert all(r.listed == (r.want and r.key is not None) for r in got)


def test_nothing_listed(spark):
    df = spark.createDataFrame([("a", False), ("b", None)], "key string, listed boolean")
    filters, shards = build(df)
    assert [r.listed for r in is_listed(df.select("key"), "key", filters, shards).collect()] == [False, False]
