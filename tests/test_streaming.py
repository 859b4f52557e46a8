"""Streams fed by several micro-batches end where the batch jobs do."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from linkloom.functions import heuristics
from linkloom.operators import graph, links
from linkloom.sources.pages import PAGE_SCHEMA
from linkloom.streaming import accumulate

PARTS = [
    [(1, "http://h/a", '<a href="/x"><a href="/y"><a href="/x">'), (2, "http://h/b", '<a href="mailto:m"><a href="/b">')],
    [(3, "http://h/c", '<a href="/x"><a href="/z"><a href="/p.jpg">')],
    [(4, "http://h/d", "<p>none</p>"), (5, "http://h/e", '<a href="tel:1"><a href="/x"><a href="/new">')],
]


@pytest.fixture(scope="module")
def arrivals(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("arrivals")
    for i, part in enumerate(PARTS):
        spark.createDataFrame(part, PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder)


@pytest.fixture
def stream(spark, arrivals):
    return accumulate.page_stream(spark, arrivals, files_per_batch=1)


@pytest.fixture(scope="module")
def batch(spark, arrivals):
    return spark.read.schema(PAGE_SCHEMA).parquet(arrivals)


@pytest.mark.parametrize("policy", ["lax", "forgive", "strict"])
def test_links(stream, batch, rows, policy):
    stored = accumulate.accumulate_links(accumulate.stream_links(stream, policy))
    assert rows(stored.drop("batch_id")) == rows(links.extract_links(batch, policy))
    if policy == "lax":
        assert stored.select("batch_id").distinct().count() == len(PARTS)


def test_in_degree(stream, batch, rows):
    running = accumulate.running_in_degree(accumulate.stream_links(stream))
    assert rows(running) == rows(graph.in_degree(links.extract_links(batch)))


def test_first_seen(stream, batch, rows, arrivals):
    seen = accumulate.first_seen(accumulate.stream_links(stream))
    assert rows(seen, "url") == rows(links.extract_links(batch).select(F.col("dst").alias("url")).distinct())
    by_batch = {r.url: r.batch_id for r in seen.collect()}
    assert len(set(by_batch.values())) == len(PARTS)


def test_sizes(stream, batch, rows):
    found = links.extract_links(batch)
    expected = (5, found.count(), graph.page_edges(batch).count(), heuristics.DEFAULT.admit(found, "dst").count())
    assert rows(accumulate.running_sizes(stream)) == [expected]


def test_a_second_run_continues(spark, tmp_path, rows):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    totals = []
    for part in PARTS:
        spark.createDataFrame(part, PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        arriving = accumulate.stream_links(accumulate.page_stream(spark, folder))
        totals.append(dict(rows(accumulate.running_in_degree(arriving, target))))
    assert [total["http://h/x"] for total in totals] == [2, 3, 4]
