"""From pages to link pairs.

Extraction, resolution and the page-level error policy are one narrow
projection over the page table: no shuffle, and only ``html`` and the page's
keys are read.  The same code serves batch and streaming frames.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.html import page_hrefs
from linkloom.functions.urls import OTHER, PROTOCOL, base_of, bind, can_parse, resolve_against
from linkloom.operators.policy import Forgiveness, first_failure, surviving


def _one_row_each(pages: DataFrame, links: str) -> DataFrame:
    """Explode an array of links into rows with their position.

    The outer form keeps the optimizer from testing the array's size below the
    projection, which would compute the extraction twice.
    """
    return (
        pages.select("page_id", F.col("url").alias("src"), F.posexplode_outer(links).alias("pos", "link"))
        .filter(F.col("pos").isNotNull())
    )


@cache
def _outcomes() -> Column:
    """``hrefs`` of a page at ``url``, each resolved or classed as failed.

    A page whose content could not be read has one outcome, a failure of class
    ``other`` without an href.  Built once per process: the expression is long,
    and its names are fixed.
    """
    nothing = F.lit(None).cast("string")
    unread = F.array(F.struct(nothing.alias("href"), nothing.alias("dst"), F.lit(OTHER).alias("error_class")))

    def resolved(page: Column) -> Column:
        return F.transform(
            F.col("hrefs"),
            lambda href: bind(
                resolve_against(page, href),
                lambda r: F.struct(href.alias("href"), r["dst"].alias("dst"), r["error_class"].alias("error_class")),
            ),
        )

    read = bind(base_of(F.col("url")), resolved)
    return F.when(F.col("hrefs").isNull(), unread).otherwise(read).alias("outcomes")


def page_outcomes(pages: DataFrame) -> DataFrame:
    """One row per page with ``outcomes``: its hrefs in order, each resolved or classed as failed."""
    others = [name for name in pages.columns if name != "html"]
    return pages.select(*others, page_hrefs(F.col("html")).alias("hrefs")).select(*others, _outcomes())


def link_outcomes(pages: DataFrame) -> DataFrame:
    """Every link as it was found: ``(page_id, pos, src, href, dst, error_class)``."""
    return _one_row_each(page_outcomes(pages), "outcomes").select(
        "page_id", "pos", "src", "link.href", "link.dst", "link.error_class"
    )


def kept_links(
    pages: DataFrame,
    policy: str = "lax",
    forgive: Forgiveness = (PROTOCOL,),
    parseable_only: bool = False,
) -> DataFrame:
    """One row per page with ``kept``: the links that survive the page's policy."""
    if parseable_only:
        pages = pages.filter(can_parse(F.col("url")))
    found = page_outcomes(pages)
    return found.select(
        *[name for name in found.columns if name != "outcomes"],
        surviving(F.col("outcomes"), policy, forgive).alias("kept"),
    )


def extract_links(
    pages: DataFrame,
    policy: str = "lax",
    forgive: Forgiveness = (PROTOCOL,),
    parseable_only: bool = False,
) -> DataFrame:
    """Surviving links ``(page_id, pos, src, href, dst)``, ``pos`` counted among the survivors."""
    return _one_row_each(kept_links(pages, policy, forgive, parseable_only), "kept").select(
        "page_id", "pos", "src", "link.href", "link.dst"
    )


def page_verdicts(pages: DataFrame, policy: str = "strict", forgive: Forgiveness = (PROTOCOL,)) -> DataFrame:
    """``(page_id, url, error_class)``: the failure that fails the page, or null."""
    return page_outcomes(pages).select(
        "page_id", "url", first_failure(F.col("outcomes"), policy, forgive).alias("error_class")
    )


def links_per_page(
    pages: DataFrame, policy: str = "lax", forgive: Forgiveness = (PROTOCOL,)
) -> DataFrame:
    """``(page_id, links)``; a page without links counts zero."""
    return kept_links(pages, policy, forgive).select("page_id", F.size("kept").cast("bigint").alias("links"))
