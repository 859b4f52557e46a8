"""Keeping or dropping rows by a set of keys, where one key may own very many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_side(few: DataFrame, key: str) -> DataFrame:
    """``few`` rows, unique on ``key``, made ready to meet many rows in a join.

    Adaptive execution splits a hot partition of the many rows only if both
    sides of the join are plain shuffles.  A side that was aggregated or laid
    out by ``key`` before would be used as it is and rule that out, so it is
    placed by another hash first; only the few rows move once more.
    """
    return few.repartition(F.xxhash64(key))


def only_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is among ``keys``."""
    return rows.join(join_side(keys.select(key).distinct(), key), key, "left_semi")


def without_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is not among ``keys``."""
    return rows.join(join_side(keys.select(key).distinct(), key), key, "left_anti")
