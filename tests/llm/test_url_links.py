from stridelake.llm import url_filter


def test_relative_encoded_and_further_targets(spark):
    page = "http://a.test/x/y?q=1"
    canonical = lambda href: f'<link rel="canonical" href="{href}">'
    cases = [
        ("page2.html", "http://a.test/x/page2.html"), ("../z", "http://a.test/z"), ("../../../z?a#b", "http://a.test/z?a#b"), ("?a=1", "http://a.test/x/y?a=1"),
        ("./", "http://a.test/x/"), ("..", "http://a.test/"), ("http://b.test/?a=1&amp;b=2", "http://b.test/?a=1&b=2"), ("/r?u=http://c.test", "http://a.test/r?u=http://c.test"),
        ("p?u=http://c.test", "http://a.test/x/p?u=http://c.test"),
    ]
    rows = [(page, canonical(t)) for t, _ in cases]
    got = {(r["a"], r["b"]) for r in url_filter.declared_links(spark.createDataFrame(rows, "url string, html string")).collect()}
    assert got == {(page, b) for _, b in cases}
    more = [("http://a.test", canonical("p") + canonical("/q") + '<meta http-equiv=refresh content="0; url=r?a=1&amp;b=2">'), (page, canonical("mailto:x@y.test")), ("no scheme", canonical("p")), (page, None)]
    got = sorted((r["a"], r["b"]) for r in url_filter.declared_links(spark.createDataFrame(more, "url string, html string")).collect())
    assert got == [("http://a.test", f"http://a.test/{x}") for x in ("p", "q", "r?a=1&b=2")]


def test_the_query_spreads_verdicts_over_declared_links(spark, tmp_path):
    link = lambda to: f'<html><head><link rel="canonical" href="{to}"></head><body>x</body></html>'
    pages = [
        (1, "http://a.test/1", link("http://b.com/en/1")),  # blocked by its canonical page's rule
        (2, "http://a.test/2#part", link("http://A.TEST/1#top")),  # an alias of an alias, but for fragment and case
        (3, "http://a.test/3", '<meta http-equiv="refresh" content="0; url=/1">'),  # a redirect to an alias
        (4, "http://a.test/4", link("http://c.com/en/1") + link("http://example.com/en/70")),  # an allowed member outranks a blocked one
        (5, "http://a.test/5", "<!-- " + link("http://b.com/en/1") + " -->"),  # a link in a comment is none
        (6, "http://a.test/6", None),
        (7, None, link("http://b.com/en/1")),
        (8, "http://b.com/en/1", ""),  # the rule itself
        (9, "http://far.test/", "<!-- open " + link("http://b.com/en/1")),
        (1, "http://a.test/1", link("http://b.com/en/1")),  # the same row again
        (10, "http://a.test/dir/x", link("../3")),  # relative, to a page that is an alias
        (11, "http://a.test/none", link("mailto:x@y.test")),
    ]
    folder = f"file://{tmp_path}"
    spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3).write.parquet(f"{folder}/pages.parquet")
    got = sorted((r["page_id"], r["rule"], r["verdict"]) for r in url_filter.op8_url_filter(spark, folder).collect())
    block = {1, 2, 3, 8, 10}
    assert got == sorted((i, "com/en/" if i == 8 else None, "block" if i in block else "allow") for i, _, _ in pages)


def test_the_query_on_pages_without_links_and_without_rows(spark, tmp_path):
    for name, rows in (("plain", [(1, "http://x.com/en/1", "a"), (2, "http://x.test/", None), (3, None, None)]), ("none", [])):
        folder = f"file://{tmp_path}/{name}"
        spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
        got = sorted((r["page_id"], r["host"], r["path"], r["verdict"]) for r in url_filter.op8_url_filter(spark, folder).collect())
        assert got == [(1, "x.com", "/en/1", "block"), (2, "x.test", "/", "allow"), (3, "", "", "allow")][: len(rows)]
