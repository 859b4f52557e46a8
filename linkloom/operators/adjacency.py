"""Edges laid out once for a loop that follows them many times.

Edges are hash-partitioned and sorted by source, so a round joins them with a
frame of per-source values that is partitioned alike: the edges never move
again, and the only shuffle of a round carries the partially aggregated
messages.  Sources with more than ``edges / (HOT_SHARE * width)`` edges would
make one partition too large.  Their edges are spread by a salt (a hash of
the target modulo the source's number of salts, one per ``bound`` edges), and
each round replicates the values of those sources once per salt, so a hot
source is read by as many tasks as it has salts.  Nothing is broadcast: the
replicated values number at most ``edges / bound + hot sources``, whatever the
width.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.session import bucketed_table, drop_stage, iterating, loop_width, settle, stage_table

HOT_SHARE = 4
# A source below this many edges is never hot, whatever its share.
HOT_EDGES = 100_000
# Edges that are shuffled at a time when they are laid out in tables.
EDGES_PER_SLICE = 100_000_000


@dataclass(frozen=True)
class Adjacency:
    cold: DataFrame
    hot: DataFrame | None
    hot_sources: DataFrame | None
    width: int
    # Whether the edges lie in tables of their own instead of a cache.
    stored: bool = False

    def release(self) -> None:
        """Free the edges laid out, once nothing follows them any more."""
        for frame in (self.cold, self.hot):
            if frame is not None:
                drop_stage(frame) if self.stored else frame.unpersist()

    def follow(self, values: DataFrame) -> DataFrame:
        """Each edge joined with its source's row of ``values`` (unique on ``src``)."""
        reached = self.cold.join(values, "src")
        if self.hot is None:
            return reached
        # The values of hot sources, once per salt; the salted edges stay where they lie.
        salted = values.join(self.hot_sources, "src").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
        return reached.unionByName(self.hot.join(salted, ["src", "salt"]).drop("salt"))


def lay_out(edges: DataFrame, hot_edges: int = HOT_EDGES, companions: int = 0) -> Adjacency:
    """Lay out edges ``(src, dst, ...)`` for :meth:`Adjacency.follow`.

    ``edges`` is a stage table.  Its layout is only cached: what a lost
    executor held of it is laid out again from the table.  ``companions`` is the
    number of rows of the largest frame to be partitioned alike.
    """
    spark = edges.sparkSession
    degrees = edges.groupBy("src").agg(F.count("*").alias("edges"))
    total = edges.count()
    width = loop_width(spark, max(total, companions))
    bound = max(hot_edges, total // (HOT_SHARE * width))
    hot = hot_sources = None
    cold = edges
    if total > bound:
        crowded = settle(
            degrees.filter(F.col("edges") > bound).select("src", F.ceil(F.col("edges") / F.lit(bound)).cast("int").alias("salts"))
        )
        if not crowded.isEmpty():
            hot_sources = crowded
            cold = edges.join(crowded.select("src"), "src", "left_anti")
            hot = edges.join(crowded, "src").withColumn("salt", F.pmod(F.xxhash64("dst"), F.col("salts")).cast("int")).drop("salts")
    with iterating(spark, width):
        cold = cold.repartition(width, "src").sortWithinPartitions("src").persist()
        if hot is not None:
            hot = hot.repartition(width, "src", "salt").persist()
    return Adjacency(cold, hot, hot_sources, width)


def merged(edges: DataFrame) -> DataFrame:
    """Parallel edges as one, with the number of its ``copies``."""
    return edges.groupBy(*edges.columns).agg(F.count("*").alias("copies"))


def lay_out_stored(edges: DataFrame, nodes: DataFrame, rows: int, width: int, hot_edges: int = HOT_EDGES) -> Adjacency:
    """The :func:`merged` ``edges(src, dst)`` as :func:`lay_out` lays them out, in tables instead of a cache.

    The tables take little more disk than the edges' targets, and are dealt in slices of
    buckets, so that the shuffle files of ``EDGES_PER_SLICE`` edges lie on disk at a time.
    ``edges`` are ``rows`` in number, cheap to read again, and no longer needed afterwards.
    ``nodes(id, out_degree)`` counts the edges of each source, copies included.
    """
    slices = max(1, math.ceil(rows / EDGES_PER_SLICE))
    bound = max(hot_edges, rows // (HOT_SHARE * width))

    def dealt(edges: DataFrame, *keys: str) -> Iterator[DataFrame]:
        bucket = F.pmod(F.hash(*keys), F.lit(width))  # as Spark's hash partitioning has it
        for at in range(slices):
            some = edges if slices == 1 else edges.filter(F.pmod(bucket, F.lit(slices)) == at)
            piece = stage_table(merged(some), "weights")
            yield piece.repartition(width, *keys).sortWithinPartitions(*keys)
            drop_stage(piece)

    crowded = stage_table(
        nodes.filter(F.col("out_degree") > bound).select(
            F.col("id").alias("src"), F.ceil(F.col("out_degree") / F.lit(bound)).cast("int").alias("salts")
        ),
        "crowded",
    )
    if crowded.isEmpty():
        return Adjacency(bucketed_table(dealt(edges, "src"), "cold-edges", width, "src"), None, None, width, True)
    cold = edges.join(crowded.select("src"), "src", "left_anti")
    hot = edges.join(crowded, "src").withColumn("salt", F.pmod(F.xxhash64("dst"), F.col("salts")).cast("int")).drop("salts")
    return Adjacency(
        bucketed_table(dealt(cold, "src"), "cold-edges", width, "src"),
        bucketed_table(dealt(hot, "src", "salt"), "hot-edges", width, "src", "salt"),
        crowded,
        width,
        True,
    )
