"""Vertex and edge tables, lookups between them, and their counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions.urls import PROTOCOL
from linkloom.operators.keys import only_keys
from linkloom.operators.links import kept_links
from linkloom.operators.policy import Forgiveness
from linkloom.session import stage_table

LINK = "link"


# Page-local graphs: ids are positions in one page's list of links.


def page_vertices(links: DataFrame) -> DataFrame:
    """``(page_id, id, url)``: one vertex per surviving link of a page."""
    return links.select("page_id", F.col("pos").cast("bigint").alias("id"), F.col("dst").alias("url"))


def page_edges(
    pages: DataFrame, policy: str = "lax", forgive: Forgiveness = (PROTOCOL,)
) -> DataFrame:
    """``(page_id, src, dst, type)`` between vertices of the same page.

    A page has edges only if it links to itself: its own URL then has a vertex,
    and every one of its links is an edge.  A URL linked more than once is
    represented by its last vertex.  Other pages are dropped before any shuffle.
    """
    targets = kept_links(pages, policy, forgive).select(
        "page_id", "url", F.transform("kept", lambda link: link["dst"]).alias("targets")
    )
    own = (F.size("targets") - F.array_position(F.reverse("targets"), F.col("url"))).cast("bigint")
    looped = targets.filter(F.array_contains("targets", F.col("url"))).select(
        "page_id", own.alias("src"), F.posexplode_outer("targets").alias("pos", "target")
    )
    per_target = looped.groupBy("page_id", "src", "target").agg(
        F.max("pos").cast("bigint").alias("dst"), F.count("*").cast("int").alias("copies")
    )
    return per_target.select(
        "page_id", "src", "dst", F.explode(F.array_repeat(F.lit(LINK), F.col("copies"))).alias("type")
    )


# The global graph: one vertex per URL.


def url_hash(url: Column, attempt: int) -> Column:
    return F.xxhash64(url) if attempt == 0 else F.xxhash64(url, F.lit(attempt))


def number_urls(
    urls: DataFrame, hash_of: Callable[[Column, int], Column] = url_hash
) -> tuple[DataFrame, DataFrame | None]:
    """Give each distinct URL a 64-bit id: ``vertices(id, url)``, and the URLs that were re-numbered.

    The id is a hash, so most rows of other tables can be numbered without a
    join.  At ten billion URLs a few hashes do coincide; those URLs get a hash
    with another seed until all ids differ, and are returned as the second
    frame (null if there are none).
    """
    vertices = stage_table(urls.select(hash_of(F.col("url"), 0).alias("id"), "url"), "vertices")
    moved: DataFrame | None = None
    attempt = 0
    while True:
        shared = vertices.groupBy("id").agg(F.count("*").alias("urls")).filter("urls > 1").select("id")
        clashing = stage_table(vertices.join(shared, "id", "left_semi").select("url"), "clashing")
        if clashing.isEmpty():
            return vertices, moved
        attempt += 1
        again = clashing.select(hash_of(F.col("url"), attempt).alias("id"), "url")
        others = vertices.join(clashing, "url", "left_anti").select("id", "url")
        vertices = stage_table(others.unionByName(again), "vertices")
        earlier = [] if moved is None else [moved.join(clashing, "url", "left_anti").select("id", "url")]
        moved = again
        for frame in earlier:
            moved = moved.unionByName(frame)


def link_urls(links: DataFrame) -> DataFrame:
    """Distinct URLs at either end of ``links(src, dst)``."""
    return links.select(F.explode(F.array("src", "dst")).alias("url")).distinct()


def numbered_ends(
    links: DataFrame, moved: DataFrame | None, hash_of: Callable[[Column, int], Column] = url_hash
) -> DataFrame:
    """``links`` with the ids of :func:`number_urls` as ``src`` and ``dst``; ``moved`` are the URLs it re-numbered."""
    for end in ("src", "dst"):
        plain = hash_of(F.col(end), 0)
        if moved is None:
            links = links.withColumn(end, plain)
        else:
            other = moved.select(F.col("url").alias(end), F.col("id").alias("_id"))
            links = links.join(other, end, "left").withColumn(end, F.coalesce("_id", plain)).drop("_id")
    return links


def global_graph(
    links: DataFrame, hash_of: Callable[[Column, int], Column] = url_hash
) -> tuple[DataFrame, DataFrame]:
    """``vertices(id, url)`` and ``edges(src, dst, type)`` of every link, multiplicity kept.

    Edge ids are computed in place; only re-numbered URLs are looked up.
    """
    vertices, moved = number_urls(link_urls(links), hash_of)
    edges = numbered_ends(links.select("src", "dst"), moved, hash_of)
    return vertices, edges.select("src", "dst", F.lit(LINK).alias("type"))


def edges_by_url(links: DataFrame, vertices: DataFrame) -> DataFrame:
    """``edges(src, dst, type)`` by looking both ends up; links with an unknown end are dropped.

    ``vertices`` is a stored or settled table (as here and in the lookups
    below): both sides of a join are then plain shuffles, and adaptive
    execution splits the partition of a hub.
    """
    source = vertices.select(F.col("url").alias("src"), F.col("id").alias("src_id"))
    target = vertices.select(F.col("url").alias("dst"), F.col("id").alias("dst_id"))
    return (
        links.select("src", "dst")
        .join(source, "src")
        .join(target, "dst")
        .select(F.col("src_id").alias("src"), F.col("dst_id").alias("dst"), F.lit(LINK).alias("type"))
    )


def property_graph(vertices: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One vertex per id, edge end-points included (without URL); of several URLs the smallest stays."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    every = vertices.select("id", "url").unionByName(ends.withColumn("url", F.lit(None).cast("string")))
    return stage_table(every.groupBy("id").agg(F.min("url").alias("url")), "vertices"), edges


def labelled_edges(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``(src_label, dst_label, type)``; an id without a vertex becomes ``unknown-<id>``.

    ``vertices`` has one row per id, as :func:`property_graph` gives.
    """
    for end in ("src", "dst"):
        labels = vertices.select(F.col("id").alias(end), F.col("url").alias(f"{end}_url"))
        edges = edges.join(labels, end, "left")

    def label(end: str) -> Column:
        return F.coalesce(f"{end}_url", F.concat(F.lit("unknown-"), F.col(end).cast("string"))).alias(f"{end}_label")

    return edges.select(label("src"), label("dst"), "type")


def resolve_edges(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges matched with stored vertices at both ends: ``(src, dst, src_url, dst_url, type)``.

    Unmatched edges vanish and an id stored twice doubles its edges.
    """
    for end in ("src", "dst"):
        stored = vertices.select(F.col("id").alias(end), F.col("url").alias(f"{end}_url"))
        edges = edges.join(stored, end)
    return edges.select("src", "dst", "src_url", "dst_url", "type")


def append(accumulated: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both; nothing is merged."""
    return accumulated.unionByName(new)


# Counts.


def in_degree(links: DataFrame) -> DataFrame:
    """``(url, in_degree)``: how often each URL is linked, repeats included."""
    return links.groupBy(F.col("dst").alias("url")).agg(F.count("*").alias("in_degree"))


def crawled_links(links: DataFrame, crawled: DataFrame) -> DataFrame:
    """The links of crawled pages only."""
    return only_keys(links, crawled.select(F.col("url").alias("src")), "src")


def crawl_size(links: DataFrame) -> DataFrame:
    return links.agg(F.countDistinct("dst").alias("crawl_size"))


def graph_stats(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``(vertices, edges)``: both counts in one row."""
    both = vertices.select(F.lit(1).alias("v"), F.lit(0).alias("e")).unionByName(
        edges.select(F.lit(0).alias("v"), F.lit(1).alias("e"))
    )
    return both.agg(
        F.coalesce(F.sum("v"), F.lit(0)).cast("bigint").alias("vertices"),
        F.coalesce(F.sum("e"), F.lit(0)).cast("bigint").alias("edges"),
    )


def summary(links: DataFrame, vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: most linked URL, its in-degree, crawl size, vertices and edges."""
    top = in_degree(links).agg(
        F.min(F.struct((-F.col("in_degree")).alias("rank"), "url")).alias("top"), F.count("*").alias("crawl_size")
    )
    return top.select(
        F.col("top.url").alias("top_url"),
        (-F.col("top.rank")).alias("top_in_degree"),
        "crawl_size",
        vertices.agg(F.count("*")).scalar().alias("vertices"),
        edges.agg(F.count("*")).scalar().alias("edges"),
    )
