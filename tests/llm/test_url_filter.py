"""URL rules against plain string handling; the trees on separable URLs."""

import re
from math import log1p

import pytest
from pyspark.sql import functions as F

from chatpulse.llm import common, url_filter
from chatpulse.llm.queries import URL_RULES


def plain(url):
    url = url or ""
    if "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule in URL_RULES:
        name, slash, prefix = rule.text.partition("/")
        fits = (host == name or host.endswith("." + name)) and path.startswith(slash + prefix)
        if fits and (best is None or len(rule.text) > len(best.text)):
            best = rule
    return host, path, best and best.text, best and best.verdict


URLS = [
    None, "", "no scheme", "http://", "http:///x", "https://example.org", "https://example.org/", "https://EXAMPLE.org/es/1",
    "http://example.org/en/12", "http://example.org/en/2", "http://badexample.org/es/1", "http://a.b.example.org/es/",
    "http://org/es/", "http://x.org?y=/es/", "http://x.com/fr/#z", "http://x.com/de/?q", "http://x.com/DE/", "http://com/de/",
    "a://b://c.org/x", "http://x.org:80/y", "http://ÀÉ.org/ß", "http://x.org/a\nb?c", "http://x.net/en/1", "://x.org/", "http://x.com/fr",
    "http://" + "a." * 3000 + "org/" + "p/" * 3000,
]


def test_hosts_paths_and_rules(spark):
    frame = spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.with_rules(frame, URL_RULES).collect()}
    assert got == {i: plain(u) for i, u in enumerate(URLS)}


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    urls = {r.page_id: r.url for r in pages.select("page_id", "url").collect()}
    got = url_filter.judge(pages, URL_RULES).collect()
    assert {r.page_id for r in got} == set(urls) and len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = plain(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_features(spark):
    url = "http://a-b.example.com/x/y1/?p=1&q=22#f"
    frame = spark.createDataFrame([(url,), (None,)], "url string")
    frame = frame.withColumn("host", url_filter.host_of(F.col("url"))).withColumn("path", url_filter.path_of(F.col("url")))
    row, empty = frame.select(*url_filter.lexical(F.col("url"), F.col("host"), F.col("path"))).collect()
    assert (row.length, row.host_length, row.depth, row.host_depth, row.parameters, row.has_fragment, row.hyphens) == (39, 15, 2, 2, 2, 1, 1)
    assert row.digit_ratio == pytest.approx(4 / 39)
    shares = [url.count(c) / len(url) for c in set(url)]
    from math import log2

    assert row.entropy == pytest.approx(-sum(s * log2(s) for s in shares))
    assert all(v == 0 for v in empty)


def test_trees_learn_from_what_rules_decide(spark):
    """Hosts that no rule names get the verdict of the URLs they look like."""
    rules = (url_filter.Rule("block", "bad.test/"), url_filter.Rule("allow", "good.test/"))
    rows = []
    for i in range(300):
        rows.append((3 * i, f"http://{'h' * (i % 9 + 1)}.bad.test/{i * 7919 % 10007}{i * 31 % 997}?a={i}&b={i}&c={i}&d=1"))
        rows.append((3 * i + 1, f"http://{'h' * (i % 9 + 1)}.good.test/a/quiet/page/" + "abcdefgh"[i % 8] * (i % 5 + 1)))
        rows.append((3 * i + 2, f"http://h.new{i}.test/{i * 7907 % 10007}{i * 37 % 997}?x={i}&y={i}&z={i}&w=1" if i % 2 else f"http://h.new{i}.test/some/quiet/page/"))
    pages = spark.createDataFrame(rows + rows[:5], "page_id bigint, url string").selectExpr("*", "'h' AS host", "1 AS features")
    got = url_filter.judge(pages, rules).collect()
    assert len(got) == len(rows) + 5
    fresh = [r for r in got if r.rule is None]
    right = sum(r.verdict == ("block" if r.page_id // 3 % 2 else "allow") for r in fresh)
    assert right > 0.95 * len(fresh)


@pytest.mark.parametrize("rules, verdict", [((), "allow"), ((url_filter.Rule("block", "x.test/"),), "block")])
def test_one_verdict_or_none_to_learn_from(spark, rules, verdict):
    pages = spark.createDataFrame([(1, "http://x.test/a"), (2, None), (None, "http://y.test/b")], "page_id bigint, url string")
    assert {r.verdict for r in url_filter.judge(pages, rules).collect()} == {verdict}
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_too_many_rules(spark):
    with pytest.raises(ValueError):
        url_filter.first_rule([url_filter.Rule("block", f"h{i}/") for i in range(501)], F.lit(""), F.lit(""))


@pytest.mark.parametrize("broadcast_bytes", [10_000_000, 0])
def test_every_suffix_has_statistics(spark, monkeypatch, broadcast_bytes):
    """Also the rarest of many domains; a large table gives what a small one gives."""
    monkeypatch.setattr(common, "BROADCAST_BYTES", broadcast_bytes)
    rows = [(i, f"http://h.d{i % 2500:04}.test/{i}", f"h.d{i % 2500:04}.test", f"/{i}", "block" if i % 2 else "allow") for i in range(5000)]
    rows += [(5000 + i, "http://hot.test/", "hot.test", "/", "block") for i in range(500)]
    labelled = spark.createDataFrame(rows, "page_id bigint, url string, host string, path string, verdict string")
    model = url_filter.train(labelled, sample_rows=200)
    urls = [(f"http://www.{d}/", f"www.{d}", "/") for d in [*(f"d{i:04}.test" for i in range(2500)), "new.test", "new.new"]] * 2
    shown = model.features(spark.createDataFrame(urls, "url string, host string, path string"))
    got = {(r.host, round(r.block_rate_2, 6), round(r.seen_2, 6), r.seen_1 > 0) for r in shown.collect()}
    rate = {0: round(1 / 4, 6), 1: round(3 / 4, 6)}
    expected = {(f"www.d{i:04}.test", rate[i % 2], round(log1p(2), 6), True) for i in range(2500)}
    assert got == expected | {("www.new.test", 0.5, 0.0, True), ("www.new.new", 0.5, 0.0, False)}
    assert shown.count() == len(urls)
