"""Lists of row outcomes held in an array column.

An outcome that failed is a null element.  The list stays where it is, in its
row: nothing is gathered from other rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_or_null(values: Column) -> Column:
    """The list itself, or null if any element is null."""
    return F.when(~F.exists(values, lambda value: value.isNull()), values)


def present_only(values: Column) -> Column:
    """The list without its null elements."""
    return F.filter(values, lambda value: value.isNotNull())
