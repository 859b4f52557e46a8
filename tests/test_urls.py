"""URL columns against the fixtures and against the JDK's own URL class."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from linkloom.functions import urls

BASE = "http://h/a/b?q#f"
RESOLVED = [
    ("http://z/p", "http://z/p", None),
    ("http:/y", "http:/y", None),
    ("http:y", "http:y", None),
    ("HTTP://Z/P", "http://Z/P", None),
    ("httpdocs/x", None, "malformed"),
    *[(href, None, "protocol") for href in ("mailto:a@b", "ftp://z/q", "file:/x", "jrt:/x", "jmod:/x")],
    *[
        (href, None, "malformed")
        for href in ("javascript:f()", "tel:1", "data:x", "gopher://x/", "y:z", "jar:x", "mailto:", "//h:port/")
    ],
    ("1:z", "http://h/a/1:z", None),
    ("//x/y", "http://x/y", None),
    ("/y", "http://h/y", None),
    ("/a b", "http://h/a b", None),
    ("/%%%", "http://h/%%%", None),
    ("/a/../b/./c", "http://h/a/../b/./c", None),
    ("y", "http://h/a/y", None),
    ("y/", "http://h/a/y/", None),
    ("./y", "http://h/a/y", None),
    ("../y", "http://h/y", None),
    ("../../../y", "http://h/../../y", None),
    ("?z", "http://h/a/?z", None),
    ("#t", "http://h/a/b?q#t", None),
    ("", "http://h/a/b?q#f", None),
    ("url:/y", "http://h/y", None),
    ("  /q\t", "http://h/q", None),
]
BARE = [
    ("http://h", "y", "http://h/y"),
    ("http://h", "?z", "http://h/?z"),
    ("http://h", "#t", "http://h#t"),
    ("http://h?q", "y", "http://h/y"),
]


def resolve_all(spark, pairs):
    frame = spark.createDataFrame(pairs, "base string, href string")
    found = frame.select("base", "href", urls.resolve_url(F.col("base"), F.col("href")).alias("r"))
    return {(r.base, r.href): (r.r.dst, r.r.error_class) for r in found.collect()}


def test_resolution_table(spark):
    got = resolve_all(spark, [(BASE, href) for href, _, _ in RESOLVED] + [(base, href) for base, href, _ in BARE])
    for href, dst, error_class in RESOLVED:
        assert got[BASE, href] == (dst, error_class), href
    for base, href, dst in BARE:
        assert got[base, href] == (dst, None), (base, href)


def test_resolution_agrees_with_the_jdk(spark):
    """Random references made of the pieces that matter, judged by the stock class."""
    pick = random.Random(7)
    pieces = ["a", "b.c", "/", "//", ".", "..", "/./", "/../", "?", "#", ":", "@", "http:", "HTTP:", "https://", "x=1",
              " ", "h:80", "%", "é", "mailto:", "ftp://", "url:", "..d", "[::1]", "&"]
    bases = [BASE, "http://h", "https://u@h:8/", "http://h?q", "http://h/a/b/c/", "http:/x/y", "http:q", "http://h/../k/"]
    pairs = list({(pick.choice(bases), "".join(pick.choices(pieces, k=pick.randint(0, 6)))) for _ in range(700)})
    jdk = spark._jvm.java.net.URL

    def expected(base, href):
        try:
            url = jdk(href) if href.startswith("http") else jdk(jdk(base), href)
        except Exception:
            return None, "malformed"
        return (url.toString(), None) if url.getProtocol() in ("http", "https") else (None, "protocol")

    got = resolve_all(spark, pairs)
    wrong = [(pair, got[pair], expected(*pair)) for pair in pairs if got[pair] != expected(*pair)]
    assert not wrong, wrong[:5]


def test_settled_links_agree_with_the_general_way(spark):
    """Links read off their text come out as the general resolution has them, on odd pages too."""
    pick = random.Random(11)
    heads = ["http://", "https://", "http:", "https:/", "HTTP://", "mailto:", "Mailto:", "javascript:", "JAVASCRIPT:", "url:mailto:", "httpx://"]
    pieces = ["a", "b.c", "/", "..", "?", "#", ":", "@", ":80", ":", ":99999999999", ":-1", "[::1]", " ", "\n", "\u00a0", "é", "\U0001f600"]
    bases = [BASE, "mailto:/x", "javascript:/x", "http:q", "", "HTTPS://u@h/../a?b#c"]
    pairs = [(pick.choice(bases), pick.choice(heads) + "".join(pick.choices(pieces, k=pick.randint(0, 4)))) for _ in range(2000)]
    frame = spark.createDataFrame(sorted(set(pairs)), "base string, href string")
    general = urls.bind(urls._base_parts(F.col("base")), lambda base: urls._resolve_parts(base, F.col("href")))
    fast = urls.resolve_url(F.col("base"), F.col("href"))
    assert frame.select("base", "href", fast.alias("fast"), general.alias("general")).where("NOT fast <=> general").collect() == []


def test_web_and_mail_links_skip_the_general_way(spark):
    """The costly general resolution is for links that need the page or are odd."""
    frame = spark.createDataFrame(
        [("https://h.org/x?y#z",), ("http://h:80",), ("mailto:a@b",), ("javascript:f()",)], "href string"
    )
    broken = lambda base, href: F.raise_error(F.lit("general")).cast("struct<dst:string,error_class:string>")
    usual, urls._resolve_parts = urls._resolve_parts, broken
    try:
        found = frame.select("href", urls.resolve_url(F.lit(BASE), F.col("href")).alias("r")).collect()
    finally:
        urls._resolve_parts = usual
    assert [tuple(row.r) for row in found] == [
        ("https://h.org/x?y#z", None), ("http://h:80", None), (None, "protocol"), (None, "malformed")
    ]


def test_parts(spark):
    cases = {
        "HTTP://User@Host.Org:80/a/b?c#d": ("http", "Host.Org", "/a/b"),
        "http://a_b.com/%%%|x": ("http", "a_b.com", "/%%%|x"),
        "https://h": ("https", "h", ""),
        "http://a@b@c/x": ("http", "", "/x"),
        "http://[::1]:8/x": ("http", "[::1]", "/x"),
        "mailto:a@b": ("mailto", "", "a@b"),
    }
    frame = spark.createDataFrame([(url,) for url in cases], "url string")
    for row in frame.select("url", urls.url_parts(F.col("url")).alias("p")).collect():
        assert (row.p.scheme, row.p.host, row.p.path) == cases[row.url]
        assert row.p.text == row.url


PRIORITIES = {
    "https://shelf.test/a/b/c/d//leaf": 6,
    "http://shelf.test/a/leaf": 12,
    "http://h/" + "\U0001f600" * 60: 12,
    "https://h/" + "a" * 240: 3,
    "https://h/" + "a" * 690: 6,
}
IGNORED = {
    "https://shelf.test": None,
    "http://shelf.test/": None,
    "http://notmalicious.test/x": "blocked_host",
    "http://shelf.test/cover.jpg": "blocked_extension",
    "http://shelf.test/deep/er/cover.PnG": "blocked_extension",
    "http://shelf.test/cover.gif..": "blocked_extension",
    "http://shelf.test/cover.zip?as=.txt": "blocked_extension",
    "http://shack.test": "blocked_host",
    "http://SHACK.test": None,
    "ftp://shelf.test": "unsupported_protocol",
    "javascript:f()": "unsupported_protocol",
    "http://w3.shelf.test/~lib/plainPage.html": None,
}
ACCEPTED = ["", "/", "/a.html", "/a.htm", "/a.tar.gz", "/the,", "/v1.2/x.pdf", "/é.pdf"]
REJECTED = ["/a.pdf", "/a.", "/x/y.HTM", "/a:b/c.php"]


def test_priority(spark):
    frame = spark.createDataFrame([(url,) for url in PRIORITIES], "url string")
    got = {r.url: r.p for r in frame.select("url", urls.url_priority(F.col("url")).alias("p")).collect()}
    assert got == PRIORITIES


def test_ignore_reason(spark):
    frame = spark.createDataFrame([(url,) for url in IGNORED], "url string")
    got = {r.url: r.i for r in frame.select("url", urls.ignore_reason(F.col("url")).alias("i")).collect()}
    assert got == IGNORED


@pytest.mark.parametrize("query", ["", "?a.pdf", "#a.pdf"])
def test_can_parse(spark, query):
    frame = spark.createDataFrame([("http://h" + path + query,) for path in ACCEPTED + REJECTED], "url string")
    got = {r.url: r.p for r in frame.select("url", urls.can_parse(F.col("url")).alias("p")).collect()}
    assert [path for path in ACCEPTED if not got["http://h" + path + query]] == []
    assert [path for path in REJECTED if got["http://h" + path + query]] == []


def test_label(spark):
    face = "\U0001f600"
    frame = spark.createDataFrame([("x" * 30,), ("x" * 31,), (face * 15,), (face * 16,), ("x" + face * 15,)], "url string")
    got = [r.l for r in frame.select(urls.display_label(F.col("url")).alias("l")).collect()]
    assert got == ["x" * 30, "x" * 27 + "...", face * 15, face * 13 + "...", "x" + face * 13 + "..."]


def test_padded_ports(spark):
    ports = {"0" * 60 + "80": True, "+0080": True, "0" * 50: True, "2147483647": True, "2147483648": False, "9" * 50: False}
    got = resolve_all(spark, [(BASE, f"http://h:{port}/x") for port in ports])
    assert {port: got[BASE, f"http://h:{port}/x"][1] is None for port in ports} == ports


def test_seed_texts(spark):
    frame = spark.createDataFrame([("HTTP://H/a ",), ("ftp://z/q",), ("/a",), ("httpx://y",), ("mailto:a@b",)], "t string")
    got = {r.t: tuple(r.u) for r in frame.select("t", urls.absolute_url(F.col("t")).alias("u")).collect()}
    assert got == {
        "HTTP://H/a ": ("http://H/a", None),
        "ftp://z/q": ("ftp://z/q", None),
        "/a": (None, "malformed"),
        "httpx://y": (None, "malformed"),
        "mailto:a@b": ("mailto:a@b", None),
    }
