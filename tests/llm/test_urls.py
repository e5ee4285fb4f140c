"""Operator 7: rules, aliases and precedence."""
from intake_spark.llm import url_filter as U
from intake_spark.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string, host string, verdict string"


def judge(spark, pages, rules=None, redirects=None):
    df = spark.createDataFrame([(i, u, h, "x", None) for i, u, h in pages], SCHEMA)
    rules = spark.createDataFrame(URL_RULES if rules is None else rules, "verdict string, host string, path string")
    if redirects is not None:
        redirects = spark.createDataFrame(redirects, "url string, to_url string")
    got = U.judge(df, rules, redirects).collect()
    assert len(got) == len(pages)
    return got


def one(spark, url):
    r = judge(spark, [(1, url, None)])[0]
    return r.host, r.path, r.rule, r.verdict


def test_parts_and_rules(spark):
    cases = {
        "http://A.Example.ORG/es/x?y#z": ("a.example.org", "/es/x", "example.org/es/", "block"),
        "https://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "https://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
        "https://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://x.com/de/": ("x.com", "/de/", "com/de/", "block"),
        "http://x.com/DE/": ("x.com", "/DE/", None, "allow"),
        "http://x.com": ("x.com", "", None, "allow"),
        "http://x.org": ("x.org", "", None, "allow"),
        "http://x.com?a=/de/": ("x.com", "", None, "allow"),
        "http://x.com#://y.org/": ("x.com", "", None, "allow"),
        "//x.com/de/": ("", "", None, "allow"),
        "http:///de/": ("", "/de/", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "": ("", "", None, "allow"),
        "http://" + "a." * 3000 + "com/de/": ("a." * 3000 + "com", "/de/", "com/de/", "block"),
        "http://É.com/fr/": ("É.com", "/fr/", "com/fr/", "allow"),
    }
    got = judge(spark, [(i, u, None) for i, u in enumerate(cases)])
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == dict(enumerate(cases.values()))


def test_blocks_reach_aliases_and_allows_come_first(spark):
    canonical = '<html><LINK href="{}" REL="canonical"></html>'
    refresh = '<meta http-equiv="Refresh" content="0; URL={}">'
    pages = [
        (1, "http://a.net/1", canonical.format("http://b.net/2")),
        (2, "http://b.net/2", refresh.format("https://x.com/de/9")),     # the target is blocked
        (3, "http://c.net/3?q=1#f", canonical.format("//a.net/1")),
        (4, "http://d.org/4", canonical.format("http://a.net/1")),       # allowed itself, and so is its class
        (5, "http://e.net/5", canonical.format("http://y.com/de/1")),
        (6, "https://e.net/5#top", None),                                # same address as 5
        (7, "http://e.net/6", canonical.format("/5")),
        (8, "http://y.com/de/1", None),
        (9, "http://f.net/", canonical.format("not a url")),
        (10, None, canonical.format("http://y.com/de/1")),
        (5, "http://e.net/5", canonical.format("http://y.com/de/1")),
    ]
    got = {}
    for r in judge(spark, pages):
        got.setdefault(r.page_id, set()).add((r.verdict, r.rule))
    allow, block = {("allow", None)}, {("block", None)}
    assert got == {1: allow, 2: allow, 3: allow, 4: {("allow", "org/")}, 5: block, 6: block, 7: block,
                   8: {("block", "com/de/")}, 9: allow, 10: allow}
    without = {r.page_id: r.verdict for r in judge(spark, [p for p in pages if p[0] != 4])}
    assert [without[i] for i in (1, 2, 3)] == ["block"] * 3


def test_redirect_table_and_long_chains(spark):
    pages = [(i, f"http://n{i}.net/", None) for i in range(40)] + [(99, "http://z.com/de/", None)]
    hops = [(f"http://n{i}.net/", f"https://n{i + 1}.net/") for i in range(30)] + [("http://n30.net/", "http://z.com/de/")]
    got = {r.page_id: (r.verdict, r.aliases) for r in judge(spark, pages, redirects=hops + hops[:3] + [(None, "http://n1.net/")])}
    assert all(got[i] == ("block", 31) for i in range(31)) and all(got[i] == ("allow", 0) for i in range(31, 40))


def test_empty_tables(spark):
    assert judge(spark, []) == []
    assert [r.verdict for r in judge(spark, [(1, "http://x.com/de/", None)], rules=[])] == ["allow"]
    assert one(spark, None) == ("", "", None, "allow")


def test_targets_resolve_against_the_page(spark):
    base = "http://H.net/a/b/c?q=1#f"
    cases = {"page2.html": "h.net/a/b/page2.html", "../d": "h.net/a/d", "?id=1": "h.net/a/b/c?id=1", "./": "h.net/a/b/",
             "..": "h.net/a/", "../../../x": "h.net/x", "/y/./z/../w?k=..": "h.net/y/w?k=..", "//o.net/p/../q": "o.net/q",
             "https://O.net": "o.net/", "https://o.net?x": "o.net/?x", "n?u=http://e.net/": "h.net/a/b/n?u=http://e.net/",
             "/l?u=http://e.net/": "h.net/l?u=http://e.net/", "mailto:a@b.net": None, "#top": None, "": None}
    df = spark.createDataFrame([(base, t) for t in cases], "url string, t string")
    got = df.select("t", U.address_of(U.resolve(df.t, df.url)).alias("a")).collect()
    assert {r.t: r.a for r in got} == cases
    top = spark.createDataFrame([("http://h.net", t) for t in ("x", "?x")], "url string, t string")
    assert {r.a for r in top.select(U.address_of(U.resolve(top.t, top.url)).alias("a")).collect()} == {"h.net/x", "h.net/?x"}


def test_aliases_by_relative_unquoted_and_listed_links(spark):
    pages = [
        (1, "http://a.net/d/1", "<link rel=canonical href=page2.html>"),
        (2, "http://a.net/d/page2.html", "<link href=http://x.com/de/2 rel=canonical>"),
        (3, "http://b.net/d/e/3", "<link rel='alternate canonical' href='../up'>"),
        (4, "http://b.net/d/up", "<LINK REL=\"canonical nofollow\" href=' http://x.com/de/4 '>"),
        (5, "http://c.net/5", '<meta http-equiv=refresh content="0; url=?id=1">'),
        (6, "http://c.net/5?id=1", "<link rel=canonical href='http://x.com/de/6'/>"),
        (7, "http://d.net", None),
        (8, "http://d.net/", "<link rel=canonical href=http://x.com/de/8>"),
        (9, "http://e.net/9", "<base href='//d.net/k/'><link rel=canonical href=../>"),
        (10, "http://f.net/10", "<link rel=canonical-x href=http://x.com/de/1><link rel='not' href='http://x.com/de/2'>"),
        (11, "http://g.net/11", "<link rel=stylesheet href=http://x.com/de/1><link rel=canonical href='http://g.net/ok'>"),
        (12, "http://z.com", None),
    ]
    got = {r.page_id: r for r in judge(spark, pages, rules=URL_RULES + [("block", "z.com", "/")])}
    assert {i for i, r in got.items() if r.verdict == "block"} == {1, 2, 3, 4, 5, 6, 7, 8, 9, 12}
    assert (got[7].path, got[8].path, got[7].aliases, got[12].aliases) == ("", "/", got[8].aliases, 0)
    moved = judge(spark, [(1, "http://m.net/a", None)], redirects=[("http://m.net/a", "b"), ("http://m.net/b", "//y.com/de/")])
    assert [r.verdict for r in moved] == ["block"]
