"""Vertex and edge tables, lookups, counts and stored graphs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from linkloom.functions import heuristics
from linkloom.operators import graph, links
from linkloom.sinks import graph_tables
from linkloom.sources.pages import PAGE_SCHEMA


def page(page_id, url, *hrefs):
    return page_id, url, "".join(f'<a href="{href}">' for href in hrefs)


@pytest.fixture(scope="module")
def looped(spark):
    return spark.createDataFrame([page(7, "http://h/a", "/b", "/a", "/b", "/c")], PAGE_SCHEMA)


def test_page_local_graph(looped, rows):
    vertices = graph.page_vertices(links.extract_links(looped))
    assert rows(vertices) == [(7, 0, "http://h/b"), (7, 1, "http://h/a"), (7, 2, "http://h/b"), (7, 3, "http://h/c")]
    assert rows(graph.page_edges(looped)) == [(7, 1, 1, "link"), (7, 1, 2, "link"), (7, 1, 2, "link"), (7, 1, 3, "link")]


def test_a_page_without_a_link_to_itself_has_no_edges(spark, rows):
    plain = spark.createDataFrame([page(7, "http://h/a", "/b", "/b", "/c")], PAGE_SCHEMA)
    assert len(rows(graph.page_vertices(links.extract_links(plain)))) == 3
    assert rows(graph.page_edges(plain)) == []


LINKS = [("a", "b"), ("a", "b"), ("b", "c"), ("c", "a"), ("d", "d")]


def squeezed(url, attempt):
    """A hash with so few values that URLs must collide again and again."""
    return F.pmod(graph.url_hash(url, attempt), F.lit(6)) + F.lit(6 * attempt)


@pytest.mark.parametrize("hash_of", [graph.url_hash, squeezed])
def test_global_graph_keeps_every_link(spark, rows, hash_of):
    pairs = LINKS + [(f"n{i}", f"n{i + 1}") for i in range(20)]
    frame = spark.createDataFrame(pairs, "src string, dst string")
    vertices, edges = graph.global_graph(frame, hash_of)
    found = vertices.collect()
    assert sorted(v.url for v in found) == sorted({url for pair in pairs for url in pair})
    assert len({v.id for v in found}) == len(found)
    by_url = rows(graph.resolve_edges(vertices, edges), "src_url", "dst_url")
    assert by_url == sorted(pairs)
    assert rows(graph.edges_by_url(frame, vertices)) == rows(edges)
    assert rows(graph.graph_stats(vertices, edges)) == [(len(found), len(pairs))]


def test_lookup_drops_unknown_ends(spark, rows):
    frame = spark.createDataFrame(LINKS, "src string, dst string")
    known = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, url string")
    assert rows(graph.edges_by_url(frame, known)) == [(1, 2, "link"), (1, 2, "link")]


def test_labels_and_stored_ends(spark, rows):
    vertices = spark.createDataFrame([(0, "a"), (1, "c")], "id bigint, url string")
    edges = spark.createDataFrame([(0, 1, "link"), (0, 9, "link")], "src bigint, dst bigint, type string")
    assert rows(graph.labelled_edges(vertices, edges)) == [("a", "c", "link"), ("a", "unknown-9", "link")]
    doubled = vertices.unionAll(spark.createDataFrame([(0, "b")], "id bigint, url string"))
    assert rows(graph.resolve_edges(doubled, edges), "src_url", "dst_url") == [("a", "c"), ("b", "c")]


def test_property_graph_collapses_ids(spark, rows):
    vertices = spark.createDataFrame([(0, "b"), (0, "a"), (1, "c")], "id bigint, url string")
    edges = spark.createDataFrame([(0, 1, "link"), (0, 7, "link")], "src bigint, dst bigint, type string")
    assert rows(graph.property_graph(vertices, edges)[0]) == [(0, "a"), (1, "c"), (7, None)]


def test_counts(spark, rows):
    frame = spark.createDataFrame(LINKS, "src string, dst string")
    assert rows(graph.in_degree(frame)) == [("a", 1), ("b", 2), ("c", 1), ("d", 1)]
    crawled = spark.createDataFrame([("a",), ("d",)], "url string")
    assert rows(graph.in_degree(graph.crawled_links(frame, crawled))) == [("b", 2), ("d", 1)]
    assert rows(graph.crawl_size(frame)) == [(4,)]
    vertices, edges = graph.global_graph(frame)
    assert rows(graph.summary(frame, vertices, edges)) == [("b", 2, 4, 4, 5)]
    assert graph.append(frame, frame).count() == 2 * len(LINKS)


def test_in_degrees_add_up_to_the_admitted_links(spark):
    frame = spark.createDataFrame(
        [("a", f"http://h/{i % 7}{'.jpg' if i % 5 == 0 else ''}") for i in range(40)], "src string, dst string"
    )
    admitted = heuristics.DEFAULT.admit(frame, "dst")
    total = graph.in_degree(admitted).agg(F.sum("in_degree")).first()[0]
    assert total == admitted.count() == 32


def test_empty_graph_counts_zero(spark, rows):
    nothing = spark.createDataFrame([], "src string, dst string")
    vertices, edges = graph.global_graph(nothing)
    assert rows(graph.graph_stats(vertices, edges)) == [(0, 0)]
    assert rows(graph.summary(nothing, vertices, edges)) == [(None, None, 0, 0, 0)]


def test_stored_graph_is_replaced(spark, rows, tmp_path):
    path = str(tmp_path)
    first = spark.createDataFrame([(5, "old")], "id bigint, url string")
    edges = spark.createDataFrame([(0, 1, "link"), (0, 9, "link")], "src bigint, dst bigint, type string")
    graph_tables.write_graph(first, edges, path)
    assert rows(graph_tables.verify_graph(spark, path)) == [(1, 0)]
    vertices = spark.createDataFrame([(0, "a"), (1, "c")], "id bigint, url string")
    graph_tables.write_graph(vertices, edges, path)
    assert rows(graph_tables.verify_graph(spark, path)) == [(2, 1)]
    assert rows(graph_tables.read_relations(spark, path)) == [(0, 1, "link")]
