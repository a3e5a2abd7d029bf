"""URL rules against their SQL form and a plain search; the cascade is exact."""

import numpy as np
import pytest

from tidewater.catalog.compare import compare, duckdb_for
from tidewater.llm import catalog, url_rules as U

URLS = [None, "", "no scheme", "http://", "http://NET", "http://a.net/", "http://example.net/en/x", "HTTP://Example.NET/en/?q", "http://xexample.net/en/",
        "http://example.com/de/1#x", "http://example.com/den", "http://sub.example.com/de/", "ftp://org/fr/", "x://a.b.org/fr", "http://a.org/FR/", "http://a.org?x=/fr/",
        "http://É.net/é", "http://a.net#/en/", "a://b://c.net/", "http://example.net/en/" + "y/" * 300, "http://" + "s." * 200 + "net/", "http://a..net//", "://net/", "http://net/\nen/"]


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = []
    for rule, verdict in rules:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    _, rule, verdict = max(fits, default=(0, None, U.DEFAULT))
    return host, path, rule, verdict


def judged(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id bigint, url string, host string, rule string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(pages, U.rule_table(spark, rules)).collect()}


def test_oracle(spark, sf_dir):
    assert compare(catalog.queries()["op7_url_rules"](spark, sf_dir), duckdb_for(sf_dir), catalog.oracles()["op7_url_rules"]) is None


def test_awkward_urls(spark):
    assert judged(spark, URLS, U.RULES) == {i: plain(u, U.RULES) for i, u in enumerate(URLS)}


def test_long_urls_are_judged(spark):
    """A url of 100 KB with thousands of labels and segments, among rules of
    several depths."""
    long = ["http://" + "l." * 25_000 + "example.net/en/" + "s/" * 25_000, "http://example.com/" + "de/" * 30_000, "x://" + "net." * 20_000 + "org/fr/" * 9]
    rules = [*U.RULES, ("l.l.l.example.net/en/s/s/s/", "block"), ("a/b/c/d/e/", "block")]
    assert judged(spark, long + URLS, rules) == {i: plain(u, rules) for i, u in enumerate(long + URLS)}


@pytest.mark.parametrize("hashes", [1, 7, 300])
def test_keys_that_share_a_hash(spark, monkeypatch, hashes):
    from pyspark.sql import functions as F
    monkeypatch.setattr(U, "_key", lambda text: F.pmod(F.xxhash64(text), F.lit(hashes)))
    urls = URLS + [f"http://h{i}.example{i % 9}.net/p{i % 50}/" for i in range(200)]
    rules = U.RULES + [(f"h{i}.example{i % 9}.net/", "block" if i % 3 else "allow") for i in range(0, 220, 2)]
    assert judged(spark, urls, rules) == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_repeated_and_null_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, "http://a.org/fr/"), (2, None)], "page_id bigint, url string")
    got = sorted(map(tuple, U.judge(pages, U.rule_table(spark)).collect()), key=repr)
    assert got == sorted([(1, "a.net", "/", "net/", "block")] * 2 + [(None, "a.org", "/fr/", "org/fr/", "allow"), (2, "", "", None, "allow")], key=repr)


def test_many_rules_need_many_levels(spark):
    urls = [f"http://h{i}.example{i % 9}.net/p{i % 50}/q{i}/" for i in range(1500)]
    rules = [(f"h{i}.example{i % 9}.net/", "block" if i % 3 else "allow") for i in range(0, 1500, 2)] + [(f"example3.net/p{i}/", "allow") for i in range(25)]
    assert judged(spark, urls, rules) == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_cascade_is_exact_over_its_universe(spark):
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(-2**63, 2**63 - 1, 4000))
    member = keys[rng.random(len(keys)) < 0.3]
    frame = lambda x: spark.createDataFrame([(int(k),) for k in x], "key bigint")
    levels = U.build_cascade(frame(keys), frame(member))
    assert len(levels) > 1
    assert (U.listed(levels, keys.view(np.uint64)) == np.isin(keys, member)).all()
    assert U.build_cascade(frame(keys), frame(keys[:0])) == []


def test_empty_tables_and_wrong_rules(spark):
    assert judged(spark, ["http://a.net/"], [("zzz/", "block")]) == {0: ("a.net", "/", None, "allow")}
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert U.judge(pages, U.rule_table(spark)).count() == 0
    with pytest.raises(ValueError):
        U.judge(pages, U.rule_table(spark, [("a.net/x", "block")]))
