"""The pending-URL queue: a frame with one row per URL, smallest priority first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.operators.ordering import head_cut, up_to

ORDER = ("priority", "url")


def queue_order(frontier: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    return frontier.orderBy(*order)


def dequeue_n(frontier: DataFrame, n: int, order: Sequence[str] = ORDER) -> tuple[DataFrame, DataFrame]:
    """The ``n`` first entries and the rest; all and none if there are fewer than ``n``.

    ``order`` must identify an entry.  One cut-off row is looked up, then both
    parts are plain filters: no join and no second sort.
    """
    cut, _ = head_cut(frontier, order, n)
    if cut is None:
        return frontier.filter(F.lit(False)), frontier
    taken = up_to(cut, order, frontier)
    return frontier.filter(taken), frontier.filter(~taken)


def queue_size(frontier: DataFrame) -> DataFrame:
    return frontier.agg(F.count("*").alias("queue_size"))


def top_linked(in_degrees: DataFrame, k: int = 1) -> DataFrame:
    """The ``k`` URLs with the highest in-degree."""
    return in_degrees.orderBy(F.desc("in_degree"), "url").limit(k)
