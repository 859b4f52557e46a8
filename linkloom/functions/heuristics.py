"""Pluggable filtering and scoring of URLs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import urls


@dataclass(frozen=True)
class Heuristics:
    """How a crawl scores URLs and which it leaves out.

    ``priority`` maps a URL column to an integer, smaller first.  ``ignore``
    maps it to a reason, or null for an admitted URL.  Both may be any Column
    expression, a vectorised Pandas UDF included.
    """

    priority: Callable[[Column], Column] = urls.url_priority
    ignore: Callable[[Column], Column] = urls.ignore_reason

    def admit(self, df: DataFrame, url: str = "url") -> DataFrame:
        """Only the rows whose URL is not ignored."""
        return df.filter(self.ignore(F.col(url)).isNull())


DEFAULT = Heuristics()


def blocking(hosts: Sequence[str], extensions: Sequence[str] = urls.BLOCKED_EXTENSIONS) -> Heuristics:
    """The default scoring with other block lists."""
    return Heuristics(ignore=lambda url: urls.ignore_reason(url, hosts, extensions))


def constant(priority: int = 0) -> Heuristics:
    """One priority for every URL, and nothing ignored."""
    return Heuristics(
        priority=lambda url: F.lit(priority),
        ignore=lambda url: F.lit(None).cast("string"),
    )
