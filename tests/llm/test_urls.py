"""URL filters against a plain loop over rules."""

import re

from samesense.llm import urls

RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
    ("Host.Net", "block"),
    ("host.net/ok", "allow"),
    ("both.org/x", "allow"),
    ("both.org/x", "block"),
    (None, "block"),
]
URLS = [
    "http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x#y", "http://example.org", "http://example.org/", "x://com/fr/",
    "http://a.b.com/de/q?u=http://c.org/es/", "nothing here", "", None, "http://", "http://?q", "http:///path", "//example.org/",
    "http://notexample.org/es/", "http://a.host.net/", "http://host.net", "http://host.net/ok/1", "http://both.org/xy",
    "http://example.org:80/es/", "http://a..com/fr/x", "http://ÜBER.com/de/ü", "http://x.org/a://b/c", "a\nb://c.com/de/\n?x",
]


def plain(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = re.split("[?#]", url.split("://", 1)[1])[0]
        host, slash, tail = rest.partition("/")
        host, path = re.sub("[A-Z]", lambda m: m.group().lower(), host), slash + tail
    best = None
    for rule, verdict in RULES:
        if rule is None or not host:
            continue
        at, slash, tail = rule.partition("/")
        at = at.lower()
        if (host == at or host.endswith("." + at)) and path.startswith(slash + tail):
            key = (len(at + slash + tail), len(at), verdict == "block", at + slash + tail)
            best = max(best or key, key)
    return host, path, best and best[3], "allow" if not best or not best[2] else "block"


def test_equals_plain_loop(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS * 2)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, judged string")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    judged, name = urls.judge_urls(pages, rules)
    for row in judged.collect():
        assert tuple(row[name]) == plain(row["url"]), row["url"]


def test_cascade_is_exact(spark):
    """Many listed keys among many more: every key of the universe is told apart."""
    universe = spark.range(20_000).selectExpr("concat('key', id) AS key")
    listed = spark.range(0, 20_000, 7).selectExpr("concat('key', id) AS key")
    levels = urls.cascade(listed, universe)
    assert len(levels) > 2
    wrong = universe.select("key", urls.contains(universe["key"], levels).alias("found"))
    assert wrong.where("found <> (cast(substr(key, 4) AS int) % 7 = 0)").count() == 0


def test_nothing_listed(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id bigint, url string")
    none = spark.createDataFrame([], "rule string, verdict string")
    judged, name = urls.judge_urls(pages, none)
    assert [tuple(r[name]) for r in judged.collect()] == [("a.org", "/", None, "allow")]
    judged, name = urls.judge_urls(pages.limit(0), spark.createDataFrame(RULES, "rule string, verdict string"))
    assert judged.count() == 0
