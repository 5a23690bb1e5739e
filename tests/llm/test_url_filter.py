"""URL filters against their SQL and a rule-by-rule loop."""
import random

import duckdb
import pytest

from rainrisk.llm import url_filter as U

SCHEMA = "page_id long, url string, host string, id int, n int, d string, best string"
RULES = [("org", "/", "allow"), ("Example.ORG", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
         ("com", "/de/", "block"), ("a.com", "", "block"), ("com", "/fr/x", "block"), ("x.y.com", "/", "allow"), ("x.y.com", "/", "block"),
         ("", "", "block"), (None, "/", "block"), ("org", None, "block"), ("net", "/", None), ("ab", "c", "block")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if c.isascii() else c for c in host), rest[:end]


def judged(url, rules):
    host, path = split(url)
    best = None
    for h, p, v in rules:
        if None in (h, p, v):
            continue
        h = h.lower()
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1,), (len(h + p), len(h), v == "block", h + p, v))
    return host, path, *(best[3:] if best else (None, "allow"))


URLS = ["http://www.Example.org/es/1?x=/en/", "https://example.org/es", "https://example.org/en/12#t", "http://EXAMPLE.ORG", "ftp://o.rg/",
        "http://notexample.org/en/1", "http://a.b.com/fr/x/1", "http://com/fr/y", "http://x.com/de/", "http://a.com", "http://a.com?x",
        "http://z.a.com/fr/", "http://x.y.com/q", "http://y.com:80/fr/", "http://u@y.com/fr/é", None, "", "no scheme.org/", "://org/", "a://b://org/",
        "http:///x", "http://./", "http://a..org/x", "http://org./x", "http://É.com/de/ü", "http://abc/", "http://ab/c", "http://ab"]


def compare(spark, rows, rules, **options):
    df = spark.createDataFrame([(i, u, "h", 1, 2, "d", "b") for i, u in rows], SCHEMA)
    rf = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted((tuple(r) for r in U.filter_urls(df, rf, **options).collect()), key=repr)
    assert got == sorted(((i, *judged(u, rules)) for i, u in rows), key=repr)
    return got


@pytest.mark.parametrize("limit", [U.BROADCAST_BYTES, 0])
def test_cases(spark, limit):
    rows = list(enumerate(URLS)) + [(None, "http://a.org/"), (None, None), (3, URLS[3]), (3, URLS[4])] + [(7, "http://a.org/x")] * 500 + [(None, None)] * 40
    compare(spark, rows, RULES, broadcast_bytes=limit)
    compare(spark, rows, [], broadcast_bytes=limit)
    compare(spark, [], RULES, broadcast_bytes=limit)


def test_random_urls(spark):
    rnd = random.Random(5)
    name = lambda k: ".".join(rnd.choice("abc") for _ in range(rnd.randint(0, k)))
    path = lambda: rnd.choice(["", "/"]) + "".join(rnd.choice("ab/é") for _ in range(rnd.randint(0, 4)))
    rules = [(name(3), path(), rnd.choice(["allow", "block"])) for _ in range(60)]
    rows = [(i, f"h://{name(4)}/{path()}{rnd.choice(['', '?q', '#f'])}") for i in range(600)]
    assert len({r[3] for r in compare(spark, rows, rules)}) > 5


def test_long_url(spark):
    rows = [(1, "http://" + "a." * 50_000 + "org/" + "x" * 1_000_000), (2, "http://" + "b" * 500_000 + ".com/de/" + "/" * 300_000)]
    assert [r[3] for r in compare(spark, rows, RULES)] == ["org/", "com/de/"]


def test_default_and_sql(spark):
    urls = [u for u in URLS if u is None or "a.com" not in u]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(None, "http://a.org/"), (0, urls[0])], "page_id long, url string")
    rules = spark.sql(f"SELECT col1 AS host, col2 AS path, col3 AS verdict FROM {U.RULES}")
    con = duckdb.connect()
    con.execute("create table pages(page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", [tuple(r) for r in pages.collect()])
    con.execute(f"create table o as {U.OP11_SQL}")
    want = con.execute("select page_id, host, path, rule, verdict from o").fetchall()
    out = U.filter_urls(pages, rules)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(want, key=repr)
    assert {r["verdict"] for r in U.filter_urls(pages, rules, default="block").where("rule is null").collect()} == {"block"}
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_empty_table(spark):
    assert U.filter_urls(spark.createDataFrame([], "page_id long, url string"),
                         spark.createDataFrame(RULES, "host string, path string, verdict string")).collect() == []
