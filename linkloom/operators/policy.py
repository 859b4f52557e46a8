"""What a failed row means for its group.

``strict``   any failed row fails the group
``forgive``  rows that failed with a forgiven class are dropped, any other failure fails the group
``lax``      failed rows are dropped, the group survives

A page's links sit in one row until they are exploded, so the page-level
policies (:func:`surviving`, :func:`first_failure`) need no shuffle.  For any
other group :func:`apply_policy` first reduces the failures to one row per
group and then removes the groups by an anti-join; no group is gathered.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.urls import PROTOCOL
from linkloom.operators.keys import without_keys

POLICIES = ("strict", "forgive", "lax")
Forgiveness = Sequence[str] | Callable[[Column], Column]


def _blocks(error_class: Column, policy: str, forgive: Forgiveness) -> Column:
    """True for a failure that fails its group."""
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}; one of {POLICIES}")
    failed = error_class.isNotNull()
    if policy == "lax":
        return F.lit(False)
    if policy == "strict":
        return failed
    pardoned = forgive(error_class) if callable(forgive) else error_class.isin(*forgive)
    return failed & ~F.coalesce(pardoned, F.lit(False))


def surviving(outcomes: Column, policy: str = "lax", forgive: Forgiveness = (PROTOCOL,)) -> Column:
    """The links a page keeps, from its array of outcomes."""
    kept = F.filter(outcomes, lambda o: o["error_class"].isNull())
    if policy == "lax":
        return kept
    failing = F.exists(outcomes, lambda o: _blocks(o["error_class"], policy, forgive))
    return F.when(failing, F.slice(outcomes, 1, 0)).otherwise(kept)


def first_failure(outcomes: Column, policy: str = "strict", forgive: Forgiveness = (PROTOCOL,)) -> Column:
    """Class of the first failure that fails the page, or null if the page survives."""
    blocking = F.filter(outcomes, lambda o: _blocks(o["error_class"], policy, forgive))
    return F.try_element_at(blocking, F.lit(1))["error_class"]


def failed_groups(
    rows: DataFrame,
    key: str,
    policy: str = "strict",
    forgive: Forgiveness = (PROTOCOL,),
    order: str | Sequence[str] = "pos",
) -> DataFrame:
    """One row per failed group: its key and the first failure, ``error_class``."""
    columns = [order] if isinstance(order, str) else list(order)
    return (
        rows.filter(_blocks(F.col("error_class"), policy, forgive))
        .groupBy(key)
        .agg(F.min_by("error_class", F.struct(*columns)).alias("error_class"))
    )


def apply_policy(
    rows: DataFrame,
    key: str | None,
    policy: str = "lax",
    forgive: Forgiveness = (PROTOCOL,),
) -> DataFrame:
    """The rows that survive ``policy`` with ``key`` as the group.

    Without a key all rows are one group.  ``rows`` is read twice, for the
    failures and for the survivors: pass a stage table if it is costly to make.
    """
    kept = rows.filter(F.col("error_class").isNull())
    if policy == "lax":
        return kept
    blocking = rows.filter(_blocks(F.col("error_class"), policy, forgive))
    if key is None:
        return kept.filter(~blocking.exists())
    return without_keys(kept, blocking, key)


def failure_log(rows: DataFrame) -> DataFrame:
    """The rows that failed, and why."""
    return rows.filter(F.col("error_class").isNotNull())


def failure_counts(rows: DataFrame) -> DataFrame:
    return failure_log(rows).groupBy("error_class").agg(F.count("*").alias("failures"))
