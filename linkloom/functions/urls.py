"""URL columns: parts, resolution, filtering and scoring.

Every function maps Columns to a Column and stays inside the JVM.  Resolution
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a URL may use, and what is turned away.
WEB_SCHEMES = ("http", "https")
KNOWN_SCHEMES = ("http", "https", "ftp", "file", "jar", "mailto", "jmod", "jrt")
BLOCKED_HOSTS = ("malicious", "porn", "hack", "onion")
BLOCKED_EXTENSIONS = ("jpg", "png", "gif", "exe", "zip", "pdf")
HTML_EXTENSIONS = ("html", "htm")
SIMPLE_PATH = r"^([\/-_\w~]*\/)?([-_\w]*)?(\.(\w*))?$"

MALFORMED = "malformed"
PROTOCOL = "protocol"
OTHER = "other"
NOT_FOUND = "not_found"

_BLANKS = "".join(map(chr, range(33)))
_ORIGIN = r"^[^:/?#]+:(?://[^/?#]+)?"
_HOST = r"^[^:/?#]+://(?:[^@/?#]*@)?(\[[^\]/?#]*\]|[^:@/?#\[]*)(?![^/?#]*@)"
_PATH = r"^[^:/?#]+:(?://[^/?#]*)?([^?#]*)"
_SCHEME = r"^(\p{L}[\p{L}\p{Nd}.+\-]*):"
_TAIL = r"(?s)^([^?#]*)(\?[^#]*)?(#.*)?\z"
# Links whose outcome can be read off their text: web URLs that stay as they are, and mail addresses.
_WHOLE = r"^https?://[^:/?#@\[\x00-\x20]++(?::[0-9]{0,9})?(?:[/?#][^\x00-\x20]*)?\z"
_MAIL = r"^mailto:[^#\x00-\x20]"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often it is used."""
    return F.transform(F.array(value), body).getItem(0)


def scheme_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([^:/?#]+):", 1))


def host_of(url: Column) -> Column:
    """Host with its case kept; empty where the authority has two ``@``."""
    return F.regexp_extract(url, _HOST, 1)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, _PATH, 1)


def url_parts(url: Column) -> Column:
    """Scheme, host, path and full text of an absolute URL, as one struct."""
    return F.struct(
        scheme_of(url).alias("scheme"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        url.alias("text"),
    )


def base_of(url: Column) -> Column:
    """What every link of a page needs of the page's URL: the URL and its origin."""
    return F.struct(url.alias("url"), F.regexp_extract(url, _ORIGIN, 0).alias("origin"))


def _base_parts(url: Column) -> Column:
    return F.struct(
        scheme_of(url).alias("scheme"),
        F.nullif(F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1), F.lit("")).alias("authority"),
        path_of(url).alias("path"),
        F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1).alias("query"),
        F.regexp_extract(url, r"(?s)^[^#]*(#.*)", 1).alias("fragment"),
    )


def _authority_fault(authority: Column) -> Column:
    """True where the authority's port or bracketed address cannot be read."""
    host = F.regexp_replace(authority, r"(?s)^[^@]*@", "")
    port = F.when(
        host.startswith("["), F.regexp_extract(host, r"(?s)^\[[^\]]*\]:(.+)\z", 1)
    ).otherwise(F.regexp_extract(host, r"(?s)^[^:]*:(.+)\z", 1))
    port_fault = (port != "") & ~F.coalesce(
        F.when(
            port.rlike(r"^[+]?[0-9]+\z"),
            F.coalesce(
                F.regexp_extract(port, r"^[+]?0*+([0-9]{0,10})\z", 1).try_cast("bigint") < 2**31, port.rlike(r"^[+]?0+\z")
            ),
        )
        .when(port.rlike(r"^-0*[01]\z"), F.lit(True)),
        F.lit(False),
    )
    bracket_fault = host.startswith("[") & ~host.rlike(r"^\[[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*(%[^\]]*)?\](:.*)?\z")
    return ~authority.rlike("(?s)@.*@") & (port_fault | bracket_fault)


def _without_dots(path: Column) -> Column:
    """Dot segments removed from a merged relative path.

    ``..`` removes the segment before it unless there is none, or that segment
    is itself a leading ``..``.  A closing ``..`` looks back from the *first*
    segment that starts with two dots, as the public JDK class does.
    """

    def fold(path: Column) -> Column:
        pieces = F.split(path, "/", -1)
        inner = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 2, F.lit(0)))
        kept = F.aggregate(
            inner,
            F.array().cast("array<string>"),
            lambda done, piece: F.when(piece == ".", done)
            .when(
                (piece == "..")
                & (F.size(done) > 0)
                & ~((F.element_at(pieces, 1) == "") & (F.size(done) == 1) & (F.element_at(done, 1) == "..")),
                F.slice(done, F.lit(1), F.size(done) - 1),
            )
            .otherwise(F.array_append(done, piece)),
        )
        return F.concat(
            F.when(F.element_at(pieces, 1) == ".", "").otherwise(F.concat(F.element_at(pieces, 1), F.lit("/"))),
            F.concat_ws("", F.transform(kept, lambda piece: F.concat(piece, F.lit("/")))),
            F.element_at(pieces, -1),
        )

    def close(path: Column) -> Column:
        before = F.regexp_extract(path, r"(?s)^(.*?)/\.\.", 1)
        parent = F.regexp_extract(before, r"(?s)^(.*/)", 1)
        return (
            F.when(path.endswith("/..") & (parent != ""), parent)
            .when(path.endswith("/."), F.substring(path, F.lit(1), F.length(path) - 1))
            .otherwise(path)
        )

    return F.when(path.rlike(r"(?s)(/\.\.?(/|\z))|(^\./.)"), bind(fold(path), close)).otherwise(path)


def resolve_against(page: Column, href: Column) -> Column:
    """Resolve ``href`` on the page of a :func:`base_of` struct.

    Gives ``struct<dst string, error_class string>``; exactly one is set.
    """
    # Most links are plain absolute paths; they need no more than the page's origin.
    plain = href.rlike(r"^/(?:[^/\x00-\x20][^\x00-\x20]*)?\z") & page["origin"].rlike("^https?:")
    joined = F.struct(
        F.concat(page["origin"], href).alias("dst"), F.lit(None).cast("string").alias("error_class")
    )
    general = bind(_base_parts(page["url"]), lambda base: _resolve_parts(base, href))

    def failed(error_class: str) -> Column:
        return F.struct(F.lit(None).cast("string").alias("dst"), F.lit(error_class).alias("error_class"))

    # So are most others: whatever the page, they are taken as written or fail.
    whole = F.struct(href.alias("dst"), F.lit(None).cast("string").alias("error_class"))
    return (
        F.when(plain, joined)
        .when(href.rlike(_WHOLE), whole)
        .when(href.rlike(_MAIL), failed(PROTOCOL))
        .when(href.startswith("javascript:"), failed(MALFORMED))
        .otherwise(general)
    )


def _resolve_parts(base: Column, href: Column) -> Column:
    trimmed = F.regexp_replace(F.btrim(href, F.lit(_BLANKS)), "(?i)^url:", "")

    def split_off_scheme(text: Column) -> Column:
        scheme = F.lower(F.regexp_extract(text, _SCHEME, 1))
        return F.struct(
            text.alias("text"),
            scheme.alias("scheme"),
            F.regexp_replace(text, _SCHEME, "").alias("rest"),
        )

    def place(s: Column) -> Column:
        alone = href.startswith("http")
        relative = ~alone & (
            (s["scheme"] == "") | ((s["scheme"] == base["scheme"]) & base["path"].startswith("/"))
        )
        rest = F.regexp_extract(s["rest"], _TAIL, 1)
        return F.struct(
            relative.alias("relative"),
            F.when(relative, base["scheme"]).otherwise(s["scheme"]).alias("scheme"),
            s["rest"].alias("rest"),
            rest.alias("body"),
            F.regexp_extract(s["rest"], _TAIL, 2).alias("query"),
            F.regexp_extract(s["rest"], _TAIL, 3).alias("fragment"),
            (rest.startswith("//") & ~rest.startswith("////")).alias("own_authority"),
            F.regexp_extract(rest, r"(?s)^//([^/]*)", 1).alias("authority"),
        )

    def build(s: Column) -> Column:
        authority = F.when(s["own_authority"], s["authority"]).when(s["relative"], base["authority"])
        onto = (
            F.when(s["own_authority"] & (s["authority"] != ""), F.lit(""))
            .when(s["relative"], base["path"])
            .otherwise(F.lit(""))
        )
        rest = F.when(s["own_authority"], F.regexp_replace(s["body"], r"(?s)^//[^/]*", "")).otherwise(s["body"])
        folder = F.regexp_extract(onto, r"(?s)^(.*/)", 1)
        has_authority = authority.isNotNull()
        merged = F.when((folder == "") & has_authority, F.concat(F.lit("/"), rest)).otherwise(
            F.concat(folder, rest)
        )
        path = (
            F.when(rest.startswith("/"), rest)
            .when((rest != "") & (onto != ""), _without_dots(merged))
            .when((rest != "") & has_authority, F.concat(F.lit("/"), rest))
            .when(rest != "", rest)
            .when(
                s["relative"] & ~s["own_authority"] & (s["query"] != ""),
                F.concat(F.regexp_replace(folder, r"/\z", ""), F.lit("/")),
            )
            .otherwise(onto)
        )
        bare = s["relative"] & (s["body"] == "") & (s["query"] == "")
        query = F.when(bare, base["query"]).otherwise(s["query"])
        fragment = F.when(bare & (s["fragment"] == ""), base["fragment"]).otherwise(s["fragment"])
        return F.concat(
            s["scheme"],
            F.lit(":"),
            F.when(F.coalesce(authority, F.lit("")) != "", F.concat(F.lit("//"), authority)).otherwise(""),
            path,
            query,
            fragment,
        )

    def judge(s: Column) -> Column:
        readable = (
            F.when(s["scheme"] == "mailto", s["rest"].rlike(r"(?s)^[^#]*[^#\s]"))
            .when(s["scheme"] == "jar", s["rest"].rlike(rf"(?is)^({'|'.join(KNOWN_SCHEMES)}):.*!/"))
            .otherwise(~(s["own_authority"] & _authority_fault(s["authority"])))
        )
        return F.when(~s["scheme"].isin(*KNOWN_SCHEMES) | ~readable, MALFORMED).when(
            ~s["scheme"].isin(*WEB_SCHEMES), PROTOCOL
        )

    def outcome(s: Column) -> Column:
        fault = judge(s)
        return F.struct(F.when(fault.isNull(), build(s)).alias("dst"), fault.alias("error_class"))

    return bind(bind(trimmed, split_off_scheme), lambda s: bind(place(s), outcome))


def resolve_url(base: Column, href: Column) -> Column:
    """Resolve ``href`` against the absolute URL ``base``; see :func:`resolve_against`."""
    return bind(base_of(base), lambda page: resolve_against(page, href))


def absolute_url(text: Column) -> Column:
    """Read ``text`` as a URL of its own; any known scheme is accepted.

    A non-web scheme is kept as written (with the scheme lower-cased): only
    links, not seeds, are limited to the web schemes.
    """
    trimmed = F.regexp_replace(F.btrim(text, F.lit(_BLANKS)), "(?i)^url:", "")
    kept = F.concat(
        F.lower(F.regexp_extract(trimmed, _SCHEME, 1)), F.lit(":"), F.regexp_replace(trimmed, _SCHEME, "")
    )
    return bind(
        bind(_base_parts(F.lit("")), lambda nothing: _resolve_parts(nothing, text)),
        lambda r: F.struct(
            F.when(r["error_class"] == PROTOCOL, kept).otherwise(r["dst"]).alias("url"),
            F.when(r["error_class"] != PROTOCOL, r["error_class"]).alias("error_class"),
        ),
    )


def can_parse(url: Column) -> Column:
    """True where the path has no extension, an HTML one, or no simple shape."""
    full = SIMPLE_PATH.removesuffix("$") + r"\z"
    path = path_of(url)
    return (
        ~path.contains(".")
        | ~path.rlike(full)
        | (F.regexp_extract(path, full, 3) == "")
        | F.regexp_extract(path, full, 4).isin(*HTML_EXTENSIONS)
    )


def ignore_reason(
    url: Column,
    hosts: Sequence[str] = BLOCKED_HOSTS,
    extensions: Sequence[str] = BLOCKED_EXTENSIONS,
) -> Column:
    """The first reason to leave ``url`` out, or null where it is admitted."""
    return (
        F.when(~url.rlike(rf"(?i)^(?:{_any_of(WEB_SCHEMES)}):"), "unsupported_protocol")
        .when(host_of(url).rlike(_any_of(hosts)), "blocked_host")
        .when(path_of(url).rlike(rf"(?i)(?:^|\.)(?:{_any_of(extensions)})\.*\z"), "blocked_extension")
    )


def _any_of(words: Sequence[str]) -> str:
    """A pattern for any of ``words``, taken literally; none of them matches if there are none."""
    return "|".join(re.escape(word) for word in words) or r"(?!)"


def _units(text: Column) -> Column:
    """Length in UTF-16 units: a character above U+FFFF counts twice."""
    return F.length(text) + F.length(F.regexp_replace(text, r"[^\x{10000}-\x{10FFFF}]", ""))


def url_priority(url: Column) -> Column:
    """Smaller comes first: https before http, short before long, shallow before deep."""
    path = path_of(url)
    slashes = F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))
    return (
        F.when(url.rlike("(?i)^https:"), 0).otherwise(10)
        + F.least(F.floor(_units(url) / 100), F.lit(5))
        + slashes
    ).cast("int")


def display_label(url: Column) -> Column:
    """``url`` shortened to 27 UTF-16 units and an ellipsis where it exceeds 30; a character is not cut in two."""
    rough = F.substring(url, 1, 27)
    above = _units(rough) - F.length(rough)
    # Every character above U+FFFF among the first 27 takes the place of one more.
    fits = F.filter(F.sequence(F.lit(13), F.lit(27)), lambda n: _units(F.substring(url, F.lit(1), n)) <= 27)
    start = F.when(above == 0, rough).otherwise(F.substring(url, F.lit(1), F.array_max(fits)))
    return F.when(_units(url) > 30, F.concat(start, F.lit("..."))).otherwise(url)
