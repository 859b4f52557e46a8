"""The physical plans that make the jobs scale."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from linkloom import session
from linkloom.operators import adjacency as adjacency_module
from linkloom.operators import graph, links, policy
from linkloom.operators.adjacency import lay_out
from linkloom.plans import corpora

from linkloom.session import iterating, settle


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def without_cached(text):
    """The plan's lines that are not part of how a cached frame was once made."""
    kept, cached = [], None
    for line in text.splitlines():
        depth = re.search(r"[*A-Za-z]", line).start() if re.search(r"[*A-Za-z]", line) else 0
        if cached is not None and depth > cached:
            continue
        cached = depth if "InMemoryRelation" in line else None
        kept.append(line)
    return "\n".join(kept)


@contextmanager
def skewed(spark):
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512KB",
    }
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("name", policy.POLICIES)
def test_extraction_is_one_narrow_pass(spark, name):
    text = plan(links.extract_links(corpora.pages(spark, entry.SMALL), name))
    assert "Exchange" not in text and "Python" not in text
    assert text.count("regexp_extract_all(html") == 1


def test_counting_links_reads_no_page_ids(spark):
    text = plan(graph.in_degree(links.extract_links(corpora.pages(spark, entry.SMALL))))
    assert "ReadSchema: struct<url:string,html:string>" in text
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_a_round_shuffles_messages_only(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    pairs = settle(spark.range(1000).select((F.col("id") % 50).alias("src"), (F.col("id") % 70).alias("dst")))
    adjacency = lay_out(pairs)
    with iterating(spark, adjacency.width):
        values = settle(
            spark.range(50).select(F.col("id").alias("src"), F.lit(1.0).alias("x")).repartition(adjacency.width, "src")
        )
        text = plan(adjacency.follow(values).groupBy("dst").agg(F.sum("x")))
    text = without_cached(text)
    assert re.findall(r"Exchange \w+\((\w+)", text) == ["dst"]
    assert text.count("Sort [src") == 1, "the edges are in order already"
    assert "partial_sum" in text


def test_a_round_over_stored_edges_shuffles_messages_only(spark, monkeypatch):
    """Tables of edges and states are read bucket by bucket, in the order they were written in."""
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(adjacency_module, "EDGES_PER_SLICE", 300)
    pairs = settle(spark.range(1000).select((F.col("id") % 50).alias("src"), (F.col("id") % 70).alias("dst")))
    with iterating(spark, 6):
        nodes = pairs.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("out_degree")).sortWithinPartitions("id")
        nodes = session.bucketed_table([nodes], "nodes", 6, "id")
    adjacency = adjacency_module.lay_out_stored(pairs, nodes, 1000, 6)
    with iterating(spark, 6):
        values = nodes.select(F.col("id").alias("src"), F.lit(1.0).alias("x"))
        followed = adjacency.follow(values)
        summed = followed.groupBy("dst").agg(F.sum("x"))
        text = plan(nodes.select(F.col("id").alias("dst")).join(summed, "dst"))
    assert re.findall(r"Exchange \w+\((\w+)", text) == ["dst"]
    assert re.findall(r"Sort \[(\w+)", text) == ["dst"], "edges and nodes are in order already"
    assert text.count("Bucketed: true") == 3
    assert sorted(map(tuple, followed.select("src", "dst", "copies").collect())) == sorted(
        map(tuple, adjacency_module.merged(pairs).collect())
    )
    adjacency.release()


def test_a_hot_batch_is_split(spark):
    """Two thirds of the rows share one key; adaptive execution must not leave them to one task."""
    found = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 5000).otherwise(-1).alias("batch"),
        F.when(F.col("id") % 7 == 1, "malformed").alias("error_class"),
        F.col("id").alias("pos"),
        F.md5(F.col("id").cast("string")).alias("dst"),
    )
    with skewed(spark):
        kept = policy.apply_policy(found, "batch", "strict")
        kept.collect()
        assert "skew=true" in plan(kept)


def test_a_hub_is_split_in_lookups(spark):
    edges = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 5000).otherwise(0).alias("src"),
        (F.col("id") % 5000).alias("dst"),
        F.md5(F.col("id").cast("string")).alias("type"),
    )
    vertices = settle(spark.range(5000).select("id", F.col("id").cast("string").alias("url")))
    with skewed(spark):
        for look_up in (graph.resolve_edges, graph.labelled_edges):
            found = look_up(vertices, edges)
            found.collect()
            assert "skew=true" in plan(found)


def test_hot_sources_are_salted_not_broadcast(spark):
    from linkloom.session import iterating

    edges = spark.createDataFrame(
        [("hub", f"d{i}") for i in range(3000)] + [(f"s{i}", f"d{i}") for i in range(300)] + [("mid", f"d{i}") for i in range(150)],
        "src string, dst string",
    )
    adjacency = lay_out(edges, hot_edges=100)
    assert adjacency.hot is not None
    salts = {r["src"]: r["salts"] for r in adjacency.hot_sources.collect()}
    assert set(salts) == {"hub"} and salts["hub"] > 1  # one salt per bound of edges
    values = spark.createDataFrame([("hub", 1), ("s1", 2), ("mid", 3), ("none", 4)], "src string, v int")
    with iterating(spark, adjacency.width):
        followed = adjacency.follow(values)
        plan = followed._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, followed.select("src", "dst", "v").collect()))
    assert "Broadcast" not in plan
    expected = sorted(map(tuple, edges.join(values, "src").select("src", "dst", "v").collect()))
    assert got == expected
    adjacency.release()
