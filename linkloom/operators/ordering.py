"""Positions and cut-offs in a total order, without gathering the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from linkloom.session import stage_table

# Up to this many rows a top-k heap per task is cheaper than a distributed sort.
TOP_ROWS = 10_000
_INDEX_BITS = 33


def with_position(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in the order of ``order``.

    ``order`` must identify a row.  Rows are range-partitioned and sorted in
    parallel; only the partition sizes, one small row per partition, go through
    a running sum.
    """
    # The sorted frame is stored so that slots and sizes come from one and the same sort.
    placed = stage_table(df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()), "sorted")
    part = F.shiftrightunsigned(F.col("_slot"), _INDEX_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_slot").bitwiseAND((1 << _INDEX_BITS) - 1))
        .drop("_part", "_slot", "_start")
    )


def head_cut(df: DataFrame, order: Sequence[str], n: int) -> tuple[Row | None, int]:
    """The last order key among the ``n`` first rows, and how many rows those are."""
    if n < 1:
        return None, 0
    head = df.select(*order)
    if n <= TOP_ROWS:
        head = head.orderBy(*order).limit(n)
    else:
        head = with_position(head, order).filter(F.col("position") < n)
    found = head.agg(F.max(F.struct(*order)).alias("cut"), F.count("*").alias("rows")).first()
    return found["cut"], found["rows"]


def up_to(row: Row, order: Sequence[str], schema: DataFrame) -> Column:
    """True for rows at or before ``row`` in the order."""
    types = {field.name: field.dataType for field in schema.schema.fields}
    limit = F.struct(*[F.lit(row[name]).cast(types[name]).alias(name) for name in order])
    return F.struct(*order) <= limit
