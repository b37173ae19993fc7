"""Address rules against trying every rule."""

import random

from helpers import SAMPLE, dicts, lower, pages
from metricloom.llm import url_rules
from metricloom.llm.queries import ORACLE, REGISTRY
from metricloom.llm.storage import read


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = lower(rest[:end]), rest[end:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return host, rest[:end]


def by_hand(url, rules):
    host, path = parts(url)
    fit = [
        (len(h) + len(p), len(h), h + p, v)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fit, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def check(spark, urls, rules, **kw):
    rows = [(i, u, None) for i, u in enumerate(urls)]
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    for r in dicts(url_rules.filter_urls(pages(spark, rows), table, **kw)):
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == by_hand(urls[r["page_id"]], rules)


def test_edge_addresses(spark):
    urls = [
        None, "", "no scheme", "http://", "://x.org/a", "http://EXAMPLE.org/es/1?x#y", "http://a.example.org/en/15",
        "http://example.org", "http://org/", "http://x.org?q=/es/", "http://x.org#f/es/", "http://xorg/",
        "http://b.com/fr", "http://b.com/fr/://de/", "http://b.com:80/de/", "http://com/de/x", "http://..com/de/",
        "a\nb://c.com/de/\n?", "http://É.com/FR/", "http://c.com/de/" + "x" * 50_000, "http://" + "a." * 3000 + "com/de/",
    ]
    check(spark, urls, list(url_rules.RULES))


def test_random_nested_rules_with_split_sweeps(spark):
    draw = random.Random(4)
    hosts = ["a", "b.a", "c.b.a", "d", "a.d"]
    rules = {
        (h, "/" + "".join(draw.choices("xy/", k=draw.randint(0, 4)))) for h in hosts for _ in range(12)
    } | {("a", "")}
    rules = [(draw.choice(("allow", "block")), h, p) for h, p in sorted(rules)]
    urls = [
        f"http://{draw.choice(('', 'w.', 'b.'))}{draw.choice(hosts)}/" + "".join(draw.choices("xy/", k=draw.randint(0, 6)))
        for _ in range(600)
    ]
    check(spark, urls + urls[:300] + ["http://a/x"] * 300, rules, rows_per_sweep=7)


def test_nulls_repeats_and_empty_tables(spark):
    rules = spark.createDataFrame(
        [("block", "a", None), ("allow", "a", ""), (None, "a", "/"), ("block", None, "/")],
        "verdict string, host string, path string",
    )
    table = pages(spark, [(None, "http://a/", None), (None, "http://a/", None), (1, None, "x")])
    got = dicts(url_rules.filter_urls(table.selectExpr("*", "1 as host", "2 as rule"), rules))
    assert sorted((r["rule"] or "", r["verdict"]) for r in got) == [("", "allow"), ("a", "block"), ("a", "block")]
    assert url_rules.filter_urls(table.limit(0), rules).collect() == []
    assert {r["verdict"] for r in dicts(url_rules.filter_urls(table, rules.limit(0)))} == {"allow"}


def test_query_on_the_sample(spark):
    urls = {r["page_id"]: r["url"] for r in read(spark, SAMPLE, "pages").collect()}
    got = dicts(REGISTRY["op9_url_filter"](spark, SAMPLE))
    assert len(got) == len(urls)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == by_hand(urls[r["page_id"]], url_rules.RULES)
