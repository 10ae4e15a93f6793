import random

import pytest
from pyspark.sql import functions as F

from llm.helpers import ordered
from starbi.llm import urlfilter


@pytest.mark.parametrize("listed_share", [0, 0.02, 0.3, 0.9, 1])
def test_cascade_is_exact_over_its_universe(spark, listed_share):
    rng = random.Random(1)
    rows = [(f"host{i}.example", rng.random() < listed_share) for i in range(6000)]
    keys = spark.createDataFrame(rows, "key string, listed boolean")
    cascade = urlfilter.BloomCascade.build(keys)
    if 0 < listed_share < 1:
        assert len(cascade.levels) > 1  # false positives were met and encoded
    got = keys.select("key", "listed", cascade.contains(F.col("key")).alias("in"))
    assert got.where("listed <> in").count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "Join" not in plan


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, v) for h, p, v in urlfilter.RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


URLS = ["https://a.example.org/es/1", "https://EXAMPLE.org/en/12?x", "http://example.org/en/2",
        "http://x.com/fr/", "http://x.com/de/a#b", "http://x.com/de", "http://com/de/", "ftp://org",
        "http://notorg/x", "http://É.bad.net/a://b", None, "", "no scheme", "http://", "://h?q",
        "http://bad.net", "http://BAD.net/x", "http://good.net/\n/y", "http://bad.net"]


@pytest.mark.parametrize("max_bits", [urlfilter.MAX_BITS, 256])
def test_rules_and_awkward_cases(spark, max_bits):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, URLS[0], "", "")],
                                  "page_id long, url string, host string, verdict string")
    listed = spark.createDataFrame([("bad.net",), ("bad.net",), (None,), ("unseen.net",), ("",)],
                                   "host string")
    want = []
    for i, u in [*enumerate(URLS), (None, URLS[0])]:
        host, path, rule, verdict = brute(u)
        inside = host in ("bad.net", "")
        want.append((i, host, path, rule, verdict or ("block" if inside else "allow"), inside))
    got = urlfilter.filter_urls(pages, listed, max_bits=max_bits)
    assert ordered(got.collect()) == ordered(want)
    assert urlfilter.filter_urls(pages.limit(0), listed).count() == 0
    assert urlfilter.filter_urls(pages, listed.limit(0)).where("listed").count() == 0


def test_a_long_list_is_sharded(spark):
    """Beyond the bound the keys are split over cascades, and no page is joined."""
    rng = random.Random(2)
    hosts = [f"h{i}.net" for i in range(400)]
    bad = {h for h in hosts if rng.random() < 0.3}
    pages = spark.createDataFrame([(i, f"http://{rng.choice(hosts)}/p") for i in range(900)],
                                  "page_id long, url string")
    listed = spark.createDataFrame([(h,) for h in bad], "host string")
    got = urlfilter.filter_urls(pages, listed, max_bits=640)
    assert {(r.host, r.listed) for r in got.collect()} == \
        {(r.url[7:-2], r.url[7:-2] in bad) for r in pages.collect()} and got.count() == 900
    assert "Join" not in got._jdf.queryExecution().toString()
    assert got._jdf.queryExecution().toString().count("Union") > 0
    with pytest.raises(ValueError, match="hold no cascade"):
        urlfilter.filter_urls(pages, listed, max_bits=8)


def test_suspect_hosts(spark):
    urls = ["http://a.com/de/1"] + ["http://a.com/x"] * 9 + ["http://b.com/de/1"] + ["http://b.com/x"] * 10 \
        + ["http://cheap-spam.net/", "http://spammy.net/", "http://c.org/de/", None]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r.host for r in urlfilter.suspect_hosts(pages, ("spam",), 10).collect()}
    assert got == {"a.com", "cheap-spam.net"}
