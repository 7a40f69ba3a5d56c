from llm_cases import bag

from pledgeline.llm import url_filter
from pledgeline.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string, host string, rule string, node long"


def canonical(target):
    return f'<html><head><LINK href="{target}" rel="nofollow canonical"></head><body>x</body></html>'


def refresh(target):
    return f"<meta content='0; URL={target}' http-equiv=Refresh>"


PAGES = [
    (0, None, None),
    (1, "no scheme net/", canonical("http://a.net/")),
    (2, "http://A.Net/x", "<p>blocked</p>"),
    (3, "https://a.net", None),
    (4, "http://example.net/en/1?q=/de/", None),
    (5, "http://x.example.net/enx", None),
    (6, "http://www.example.com/de/5#f", None),
    (7, "http://notexample.com/de/5", None),
    (8, "http://x.org/fr/1", None),
    (9, "ftp://x.org/en/1", None),
    # aliases of a blocked page, over two links
    (10, "http://one.com/a", canonical("/b?x=1&amp;y=2")),
    (11, "https://one.com/b?x=1&y=2#top", refresh("http://bad.net/page")),
    (12, "http://one.com/b?x=1&y=3", None),
    # an explicitly allowed alias takes precedence over a blocked one
    (13, "http://two.com/a", canonical("//bad.net/two")),
    (14, "http://two.com/b", canonical("http://two.com/a") + canonical("https://x.org/fr/home")),
    # a rule of the page itself stays
    (15, "http://own.net/", canonical("http://x.org/fr/home")),
    # a link in a comment, in a script, of another scheme, or to the page itself is none
    (16, "http://three.com/a", "<!--" + canonical("http://bad.net/") + "-->"),
    (17, "http://three.com/b", "<script>'" + canonical("http://bad.net/") + "'</script>"),
    (18, "http://three.com/c", canonical("mailto:bad.net") + canonical("#x") + canonical("")),
    (19, "http://four.com", canonical("http://FOUR.com/#y")),
    (20, "http://four.com/", None),
    (21, "http://six.com/dir/a", canonical("b")),
    (22, "http://six.com/dir/b", canonical("http://bad.net/page")),
    (22, "http://six.com/dir/b", canonical("http://bad.net/page")),
    (23, "http://://x", None),
    (24, "http://h?://net/", None),
]

VERDICTS = {
    0: "allow", 1: "allow", 2: "block", 3: "allow", 4: "allow", 5: "block", 6: "block", 7: "allow",
    8: "allow", 9: "allow", 10: "block", 11: "block", 12: "allow", 13: "allow", 14: "allow",
    15: "block", 16: "allow", 17: "allow", 18: "allow", 19: "allow", 20: "allow", 21: "block",
    22: "block", 23: "allow", 24: "allow",
}


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if c.isascii() else c for c in host), rest[:end]


def rule(host, path):
    fits = [
        (len(h + p), v == "allow", h + p)
        for v, h, p in URL_RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[2] if fits else None


def judged(spark, pages, **more):
    df = spark.createDataFrame([(*p, "h", "r", 1) for p in pages], SCHEMA).repartition(3)
    rules = url_filter.rule_table(spark, URL_RULES)
    return url_filter.judge(df, rules, **more).collect()


def test_pages(spark):
    got = judged(spark, PAGES)
    expected = []
    for page_id, url, _ in PAGES:
        host, path = parts(url)
        expected.append((page_id, host, path, rule(host, path), VERDICTS[page_id]))
    assert bag(r[:5] for r in got) == bag(expected)


def test_redirect_table_and_no_rules(spark):
    redirects = spark.createDataFrame(
        [("http://one.com/z", "http://bad.net/"), (None, "http://bad.net/")],
        "from_url string, to_url string",
    )
    got = judged(spark, [(1, "https://one.com/z", None), (2, "http://q.com/", "")], redirects=redirects)
    assert {r.page_id: (r.verdict, r.aliases) for r in got} == {1: ("block", True), 2: ("allow", False)}
    df = spark.createDataFrame([(1, "http://a.net/", None)], "page_id long, url string, html string")
    none = url_filter.rule_table(spark, [])
    assert url_filter.judge(df, none).collect()[0].verdict == "allow"


def test_no_pages(spark):
    assert judged(spark, []) == []


def test_dot_segments_of_relative_links(spark):
    targets = {
        "../a": "/a", "./b": "/d/b", ".": "/d/", "..": "/", "../../../a?x=../y#/../z": "/a?x=../y#/../z",
        "/x/./y/../z/": "/x/z/", "/x//../y": "/x/y", "c/..": "/d/", "..c/.d": "/d/..c/.d", "?../a": "/d/e?../a",
        "//h/d/../a": "/a", "e?./": "/d/e?./", "http://h/d/../a": "/d/../a",
    }
    pages = [(k, "http://h/d/e", f'<link rel="canonical" href="{t}">') for k, t in enumerate(targets)]
    links = url_filter.page_links(spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert bag(links.select("to_url").collect()) == bag((f"http://h{path}",) for path in targets.values())
    pages = [
        (1, "http://h/d/e", '<link rel=canonical href="../a">'),
        (2, "http://h/a", ""),
        (3, "http://h/d/f", '<meta http-equiv=refresh content="0; url=./g">'),
        (4, "http://h/d/g", ""),
    ]
    rules = url_filter.rule_table(spark, [("block", "h", "/a"), ("block", "h", "/d/f")])
    judged = url_filter.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), rules)
    assert {r.page_id: (r.verdict, r.aliases) for r in judged.collect()} == dict.fromkeys((1, 2, 3, 4), ("block", True))
