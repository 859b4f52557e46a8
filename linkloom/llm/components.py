"""Connected components of a table of links, as rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.session import settle

MOST_ROUNDS = 200


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every end of ``links(a, b)``; the component is its smallest node.

    Every round lets each node take the smallest label among its neighbours and
    then the label of its label, so labels travel twice as far each round.
    Labels are stored in a checkpoint in each round; a hub's neighbours are
    partially aggregated before they are shuffled.
    """
    both = settle(
        links.where("a <> b").select("a", "b").unionByName(links.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    for _ in range(MOST_ROUNDS):
        heard = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("heard"))
        )
        known = labels.join(heard, "node").select(
            "node", F.least("component", "heard").alias("lower"), F.col("component").alias("before")
        )
        jump = labels.select(F.col("node").alias("lower"), F.col("component").alias("beyond"))
        new = settle(
            known.join(jump, "lower", "left").select(
                "node", F.least("lower", F.coalesce("beyond", "lower")).alias("component"), "before"
            )
        )
        changed = new.where("component <> before").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels
    raise RuntimeError("components did not settle")
