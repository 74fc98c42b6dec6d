from pathloom.llm.queries import ORACLES, QUERIES
from pathloom.llm.url_rules import RULES, judge_urls
from tools.check_queries import table


def plain(url, rules=RULES):
    at = (url or "").find("://")
    rest = url[at + 3:] if at >= 0 else ""
    ends = [i for i in (rest.find(c) for c in "/?#") if i >= 0]
    host = "".join(c.lower() if c.isascii() else c for c in rest[:min(ends, default=len(rest))])
    tail = rest[min(ends, default=len(rest)):]
    path = tail[:min((i for i in (tail.find("?"), tail.find("#")) if i >= 0), default=len(tail))]
    fit = [(len(r), len(r.split("/")[0]), v == "block", r, v) for v, r in rules
           if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0])) and path.startswith(r[len(r.partition("/")[0]):])]
    best = max(fit, default=None)
    return (host, path, best[3] if best else None, best[4] if best else "allow")


URLS = [None, "", "no scheme", "://", "http://", "http://NET/", "http://net", "http://net?x=/", "https://a.b.net/p?q#f", "http://example.net/en/x",
        "http://Example.NET/en", "http://blog.example.net/en/", "http://badexample.net/en/", "http://example.com/de/1", "http://example.com/den", "x://org/fr/",
        "http://a.org/fr/a", "http://net./x", "http://.net/", "http://é.NET/ä/", "http://a.org\n/fr/", "http://" + "a." * 3000 + "net/" + "p" * 5000, "a://b://net/"]


def test_query_agrees_with_sql(spark, con, small):
    found = QUERIES["op2_url_rules"](spark, small)
    want = con.execute(ORACLES["op2_url_rules"])
    columns = [d[0] for d in want.description]
    assert table(found.collect(), found.columns) == table(want.fetchall(), columns)
    assert sorted(columns) == sorted(found.columns)


def test_edges_and_repeated_rows(spark):
    rows = [(i, u, "k", 1) for i, u in enumerate(URLS + URLS)] + [(None, "http://x.net/", "k", 2)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, key string, salt int")
    found = sorted(map(tuple, judge_urls(pages, ranges=7).collect()), key=repr)
    assert found == sorted(((i, *plain(u)) for i, u, _, _ in rows), key=repr)


def test_hot_url_over_many_ranges_and_nested_rules(spark):
    rules = [("block", "b.a/"), ("allow", "a/x"), ("allow", "c.b.a/x/y"), ("block", "c.b.a/x/y"), ("block", "a"), ("allow", "A.a/xx")]
    urls = ["http://c.b.a/x/y"] * 500 + ["http://d.c.b.a/x/y/z", "http://a/x", "http://b.a/x", "http://ba/x", "http://a", "http://a.A/xxx"] * 30
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = sorted(map(tuple, judge_urls(pages, rules, ranges=20).collect()))
    lowered = [(v, r.lower() if "A.a" in r else r) for v, r in rules]
    want = sorted((i, *plain(u, lowered)) for i, u in enumerate(urls))
    assert [(f[0], f[1], f[2], (f[3] or "").lower() or None, f[4]) for f in found] == want


def test_empty_tables(spark):
    assert judge_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []
    pages = spark.createDataFrame([(1, "http://net/")], "page_id long, url string")
    assert [r.verdict for r in judge_urls(pages, spark.createDataFrame([], "verdict string, rule string")).collect()] == ["allow"]
