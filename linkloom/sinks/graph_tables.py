"""The graph as two Parquet tables below one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators.graph import graph_stats, resolve_edges

NODES = "page"
RELATIONS = "links_to"


def write_nodes(vertices: DataFrame, path: str) -> None:
    """Replace the stored nodes ``page(id, url)``."""
    vertices.select("id", "url").write.mode("overwrite").parquet(f"{path}/{NODES}")


def write_relations(edges: DataFrame, path: str) -> None:
    """Replace the stored relations by the edges whose ends are both stored nodes."""
    nodes = read_nodes(edges.sparkSession, path)
    resolved = resolve_edges(nodes, edges).select("src", "dst", "type")
    resolved.write.mode("overwrite").parquet(f"{path}/{RELATIONS}")


def write_graph(vertices: DataFrame, edges: DataFrame, path: str) -> None:
    """Clear and store a graph: nodes first, then the relations between stored nodes."""
    write_nodes(vertices, path)
    write_relations(edges, path)


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{NODES}")


def read_relations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{RELATIONS}")


def verify_graph(spark: SparkSession, path: str) -> DataFrame:
    """``(nodes, edges)`` as stored."""
    counts = graph_stats(read_nodes(spark, path), read_relations(spark, path))
    return counts.select(F.col("vertices").alias("nodes"), "edges")
