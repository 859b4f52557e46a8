"""Anchors of an HTML text, as Columns.

One pass over the text finds comments, scripts and styles (skipped), the
attribute text of every ``a`` start tag, and every other start tag, whose
attributes are passed over so that mark-up quoted in them is not read.  The
repeated groups are possessive, so a tag of any length is matched without
recursion.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)"""
# White space, attributes with or without a value, and what cannot be read as either.
_ATTRIBUTES = rf"""(?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+{_VALUE})?+|=)*+"""
_ANCHORS = (
    r"(?is)<(?:!--.*?(?:-->|\z)"
    rf"|(script|style)(?=[\s/>]){_ATTRIBUTES}.*?(?:</\1(?=[\s/>])|\z)"
    rf"|a(?=[\s/])({_ATTRIBUTES})"
    rf"|[a-z][^\s/>]*+{_ATTRIBUTES})"
)
_HREF = rf"(?is)href(?![^\s/>=])(?:\s*+=\s*+({_VALUE}))?+|[^\s/>=]++(?:\s*+=\s*+{_VALUE})?+"

# The references that HTML gives a name, without their closing semicolon.
_NAMED = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
_PAIR, _ENTRY = "\x1f", "\x1e"


def _named(name: Column) -> Column:
    table = F.str_to_map(
        F.lit(_ENTRY.join(f"{known}{_PAIR}{text}" for known, text in _NAMED.items())), F.lit(_ENTRY), F.lit(_PAIR)
    )
    return F.try_element_at(table, name)


def _character(name: Column) -> Column:
    """The character of a reference's name (``amp``, ``#38``, ``#x26``), or null; leading zeros do not count."""
    decimal = F.regexp_extract(name, r"^#0*+([0-9]{1,7})\z", 1)
    hexadecimal = F.regexp_extract(name, r"^#[xX]0*+([0-9A-Fa-f]{1,6})\z", 1)
    code = F.when(decimal != "", decimal.cast("int")).when(hexadecimal != "", F.conv(hexadecimal, 16, 10).cast("int"))
    character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    found = F.when(code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF), character)
    return F.coalesce(found, F.when(name.rlike("^[A-Za-z][A-Za-z0-9]*+\\z"), _named(name)))


def _decoded(text: Column) -> Column:
    """Named and numeric character references, each decoded once."""

    def piece(after: Column) -> Column:
        name = F.substring_index(after, ";", 1)
        character = F.when(after.contains(";"), _character(name))
        rest = F.substring(after, F.length(name) + 2, F.length(after))
        return F.coalesce(F.concat(character, rest), F.concat(F.lit("&"), after))

    pieces = F.split(text, "&", -1)
    return F.concat(
        F.element_at(pieces, 1),
        F.concat_ws("", F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), piece)),
    )


def _unquoted(value: Column) -> Column:
    quoted = value.startswith('"') | value.startswith("'")
    return F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def page_hrefs(html: Column) -> Column:
    """``array<string>``: the ``href`` of every anchor that has one, in document order."""
    tags = F.filter(F.regexp_extract_all(html, F.lit(_ANCHORS), F.lit(2)), lambda tag: tag != "")

    def written(tag: Column) -> Column:
        values = F.filter(F.regexp_extract_all(tag, F.lit(_HREF), F.lit(1)), lambda value: value != "")
        # A repeated attribute overrides the earlier one.
        return F.try_element_at(values, F.lit(-1))

    found = F.filter(F.transform(tags, written), lambda value: value.isNotNull())
    return F.transform(
        F.transform(found, _unquoted),
        lambda value: F.when(value.contains("&"), _decoded(value)).otherwise(value),
    )
