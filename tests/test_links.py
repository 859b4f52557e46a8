"""Anchors, positions and error policies on inline pages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from linkloom.functions.html import page_hrefs
from linkloom.functions.outcomes import all_or_null, present_only
from linkloom.operators import links, policy
from linkloom.sources import pages as sources

HREFS = [
    ('<a href="/1">', ["/1"]),
    ("<A HREF='/2'>", ["/2"]),
    ("<a class='k' href=/3>", ["/3"]),
    ('<a data-href="/no" href="/4">', ["/4"]),
    ('<a id=x href = "/5?a=1&amp;b=2">', ["/5?a=1&b=2"]),
    ('<a title="x > y" href="/6">', ["/6"]),
    ("<a title=\" href='/no'\" href=\"/8\">", ["/8"]),
    ('<a href="">', [""]),
    ('<a data-href="/no">', []),
    ('<abbr href="/no">', []),
    ('<area href="/no">', []),
    ('<a name="n">', []),
    ("<a href>", []),
    ('<!-- <a href="/no"> -->', []),
    ("<script>\"<a href='/no'>\"</script>", []),
    ('<style>a{}</style><a href="/s">', ["/s"]),
    ('<a\nhref="/n">x</a><p><a href="/m">', ["/n", "/m"]),
    ('<a href="&amp;lt;">', ["&lt;"]),
    ('<a href="/&#38;lt;&#x2F;&#233;&#x1F600;&#39;&quot;&gt;">', ["/&lt;/é😀'\">"]),
    ('<a href="?a=1&b=2&nosuch;&#xD800;&#;&#99999999;&">', ["?a=1&b=2&nosuch;&#xD800;&#;&#99999999;&"]),
    ('<a href="/once" href="/twice">', ["/twice"]),
    ('<a class="k"href="/close">', ["/close"]),
    ('<!-- open <a href="/no">', []),
    ('<style-guide>a</style-guide><a href="/1">', ["/1"]),
    ('<script-x>a</script-x><a href="/2">', ["/2"]),
    ('<div title="<script "><a href="/4">', ["/4"]),
    ('<div title="<!-- "><a href="/5">', ["/5"]),
    ("<p title=\"<a href='/6'>\">", []),
    ("<a title=it's href=\"/7\">", ["/7"]),
    ('<a/href="/x">', ["/x"]),
    ('<a href="/&#0000000065;&#x00000041;">', ["/AA"]),
    ('<a href="/&eacute;&copy;&nosuch;&Eacute;">', ["/é©&nosuch;É"]),
    ('<SCRIPT src="a>b"><a href="/no"></SCRIPT><A HREF = "/9" >', ["/9"]),
    ("", []),
]


def test_hrefs(spark):
    frame = spark.createDataFrame([(html,) for html, _ in HREFS], "html string")
    got = {r.html: r.hrefs for r in frame.select("html", page_hrefs(F.col("html")).alias("hrefs")).collect()}
    for html, hrefs in HREFS:
        assert got[html] == hrefs, html


def test_long_tags_and_texts_are_read_whole(spark):
    long_tag = '<a data-x="' + "y" * 300_000 + '" ' + "z " * 100_000 + ' href="/end">'
    never_closed = "<a " + "w " * 200_000
    many = "".join(f'<a href="/{i}">' for i in range(20_000))
    frame = spark.createDataFrame([(1, long_tag), (2, never_closed), (3, many)], "id int, html string")
    got = {r.id: r.hrefs for r in frame.select("id", page_hrefs(F.col("html")).alias("hrefs")).collect()}
    assert got[1] == ["/end"] and got[2] == []
    assert got[3] == [f"/{i}" for i in range(20_000)]


def page(page_id, *hrefs, url="http://h/"):
    return page_id, url, "".join(f'<a href="{href}">' for href in hrefs)


@pytest.fixture(scope="module")
def five_pages(spark):
    return spark.createDataFrame(
        [
            page(1, "/a", "/b"),
            page(2, "/a", "mailto:x@y", "/b"),
            page(3, "/a", "javascript:f()", "mailto:x@y"),
            page(4, "mailto:x@y", "tel:1"),
            page(5),
        ],
        sources.PAGE_SCHEMA,
    )


KEPT = {
    "strict": {1: ["/a", "/b"]},
    "forgive": {1: ["/a", "/b"], 2: ["/a", "/b"]},
    "lax": {1: ["/a", "/b"], 2: ["/a", "/b"], 3: ["/a"]},
}


@pytest.mark.parametrize("name", policy.POLICIES)
def test_page_policies(spark, five_pages, rows, name):
    expected = [(i, pos, "http://h" + dst) for i, kept in KEPT[name].items() for pos, dst in enumerate(kept)]
    assert rows(links.extract_links(five_pages, name), "page_id", "pos", "dst") == sorted(expected)
    # The same by key, over link rows.
    kept = policy.apply_policy(links.link_outcomes(five_pages), "page_id", name)
    assert rows(kept, "page_id", "dst") == sorted((i, dst) for i, _, dst in expected)


def test_first_failure_is_reported(five_pages, rows):
    strict = rows(links.page_verdicts(five_pages, "strict"), "page_id", "error_class")
    assert strict == [(1, None), (2, "protocol"), (3, "malformed"), (4, "protocol"), (5, None)]
    forgiving = rows(links.page_verdicts(five_pages, "forgive"), "page_id", "error_class")
    assert forgiving == [(1, None), (2, None), (3, "malformed"), (4, "malformed"), (5, None)]
    groups = policy.failed_groups(links.link_outcomes(five_pages), "page_id", "forgive")
    assert rows(groups) == [(3, "malformed"), (4, "malformed")]


def test_one_failed_page_empties_its_batch(five_pages, rows):
    batch = F.when(F.col("page_id") < 3, "good").otherwise("bad")
    found = links.link_outcomes(five_pages).withColumn("batch", batch)
    assert rows(policy.apply_policy(found, "batch", "forgive"), "page_id", "pos") == [(1, 0), (1, 1), (2, 0), (2, 2)]
    assert policy.apply_policy(found, None, "forgive").count() == 0
    assert policy.apply_policy(found, None, "lax").count() == 5


def test_forgiveness_is_pluggable(five_pages, rows):
    anything = links.extract_links(five_pages, "forgive", lambda error_class: F.lit(True))
    assert rows(anything, "page_id", "pos", "dst") == rows(links.extract_links(five_pages), "page_id", "pos", "dst")
    named = links.extract_links(five_pages, "forgive", ("protocol", "malformed"))
    assert rows(named, "page_id", "pos") == rows(anything, "page_id", "pos")


def test_unknown_policy(five_pages):
    with pytest.raises(ValueError):
        links.extract_links(five_pages, "lenient")


def test_failure_log(five_pages, rows):
    log = policy.failure_log(links.link_outcomes(five_pages))
    assert rows(log, "page_id", "pos") == [(2, 1), (3, 1), (3, 2), (4, 0), (4, 1)]
    assert rows(policy.failure_counts(links.link_outcomes(five_pages))) == [("malformed", 2), ("protocol", 3)]


def test_links_per_page_counts_zero(five_pages, rows):
    assert rows(links.links_per_page(five_pages)) == [(1, 2), (2, 2), (3, 1), (4, 0), (5, 0)]


def test_lists_of_outcomes(spark):
    frame = spark.createDataFrame([(["a", None],), (["a", "b"],), ([],)], "x array<string>")
    got = [tuple(r) for r in frame.select(all_or_null(F.col("x")), present_only(F.col("x"))).collect()]
    assert got == [(None, ["a"]), (["a", "b"], ["a", "b"]), ([], [])]


def test_seeds_are_all_or_nothing(spark, rows):
    good = spark.createDataFrame([("HTTP://a/x",), ("https://b",)], "url string")
    assert rows(sources.seeds(good)) == [("http://a/x",), ("https://b",)]
    bad = good.unionAll(spark.createDataFrame([("b/c",)], "url string"))
    assert rows(sources.seeds(bad)) == []
    assert rows(sources.seeds(bad, policy="lax")) == [("http://a/x",), ("https://b",)]


def test_fetch_reports_misses(spark, rows):
    store = spark.createDataFrame([page(1, "/a", url="http://a"), page(2, "/b", url="http://a")], sources.PAGE_SCHEMA)
    wanted = spark.createDataFrame([("http://a",), ("http://b",)], "url string")
    got = rows(sources.fetch(wanted, store), "url", F.col("html").isNull(), "error_class")
    assert got == [("http://a", False, None), ("http://a", False, None), ("http://b", True, "not_found")]


def test_parse_gate(spark, rows):
    frame = spark.createDataFrame(
        [(1, "http://h/a.pdf"), (1, "http://h/b.html"), (2, "http://h/c.pdf")], "batch int, url string"
    )
    assert rows(sources.parse_gate(frame, "batch"), "url") == [("http://h/a.pdf",), ("http://h/b.html",)]


def test_a_page_without_content_has_failed(spark, rows):
    pages = spark.createDataFrame([(1, "http://h/", None), (2, "http://h/b", '<a href="/x">')], "page_id int, url string, html string")
    assert rows(links.link_outcomes(pages), "page_id", "href", "error_class") == [(1, None, "other"), (2, "/x", None)]
    assert rows(links.page_verdicts(pages, "forgive"), "page_id", "error_class") == [(1, "other"), (2, None)]
    assert rows(links.links_per_page(pages), "page_id", "links") == [(1, 0), (2, 1)]
    assert rows(policy.failure_counts(links.link_outcomes(pages))) == [("other", 1)]
