"""The named queries: each takes a session and the folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions import heuristics, outcomes, urls
from linkloom.operators import frontier, graph, links, policy, queue
from linkloom.operators.ordering import with_position
from linkloom.operators.pagerank import label_ranks, pagerank
from linkloom.plans import corpora
from linkloom.session import delete_at_exit, settle, stage_path, stage_table
from linkloom.sinks import graph_tables
from linkloom.sources import page_store
from linkloom.sources import pages as sources
from linkloom.streaming import accumulate

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOP_K = 10
DEQUEUED = 100
WAVES = (3, 10)
CRAWL_DEPTH = 3
BEST_FIRST = {"wave_size": 400, "max_pages": 1500, "max_depth": 3}
ROUNDS = 10
ARRIVALS = 3
SPAM_HOSTS = ("spam", "casino", "pills")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def admitted_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the given pages to admitted URLs."""
    found = links.extract_links(corpora.pages(spark, sf_dir))
    return heuristics.DEFAULT.admit(found, "dst")


def page_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = admitted_targets(spark, sf_dir).select(F.col("dst").alias("url"))
    return frontier.seed_frontier(targets)


def every_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All URLs of the mixed pages and of their links."""
    return graph.link_urls(links.extract_links(corpora.mixed_pages(spark, sf_dir)))


def rounded(ranks: DataFrame, key: str = "id") -> DataFrame:
    return ranks.select(key, F.round("rank", 4).alias("rank"))


# Extraction and error policies.


@query
def top_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue.top_linked(graph.in_degree(admitted_targets(spark, sf_dir)), TOP_K)


@query
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.pages(spark, sf_dir).select("page_id", "url", F.md5("html").alias("html_md5"))


@query
def page_hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.link_outcomes(corpora.mixed_pages(spark, sf_dir)).select("page_id", "pos", "href")


@query
def link_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.link_outcomes(corpora.mixed_pages(spark, sf_dir)).select("page_id", "pos", "dst", "error_class")


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.extract_links(corpora.pages(spark, sf_dir)).select("page_id", "pos", "src", "dst")


QUERIES["links"] = page_links


@query
def link_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.extract_links(corpora.mixed_pages(spark, sf_dir)).select("page_id", "pos", "dst")


@query
def links_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = links.extract_links(corpora.mixed_pages(spark, sf_dir), "strict")
    return kept.select("page_id", "pos", "src", "dst")


@query
def links_forgive(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = links.extract_links(corpora.mixed_pages(spark, sf_dir), "forgive")
    return kept.select("page_id", "pos", "src", "dst")


@query
def links_forgive_pluggable(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = links.extract_links(
        corpora.mixed_pages(spark, sf_dir), "forgive", lambda error_class: error_class == urls.MALFORMED
    )
    return kept.select("page_id", "pos", "src", "dst")


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes with the page's host as its batch."""
    rows = links.link_outcomes(corpora.mixed_pages(spark, sf_dir))
    return rows.withColumn("batch", urls.host_of(F.col("src")))


@query
def links_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stage_table(_batches(spark, sf_dir), "outcomes")
    kept = policy.apply_policy(found, "batch", "forgive")
    return kept.select("batch", "page_id", "pos", "dst")


@query
def batch_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy.failed_groups(_batches(spark, sf_dir), "batch", "strict", order=("page_id", "pos"))


@query
def page_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    strict = links.page_verdicts(corpora.mixed_pages(spark, sf_dir), "strict")
    return strict.select("page_id", "error_class")


@query
def page_verdicts_forgive(spark: SparkSession, sf_dir: str) -> DataFrame:
    forgiving = links.page_verdicts(corpora.mixed_pages(spark, sf_dir), "forgive")
    return forgiving.select("page_id", "error_class")


@query
def link_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = policy.failure_log(links.link_outcomes(corpora.mixed_pages(spark, sf_dir)))
    return log.select("page_id", "pos", "href", "error_class")


@query
def error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy.failure_counts(links.link_outcomes(corpora.mixed_pages(spark, sf_dir)))


@query
def collect_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.page_outcomes(corpora.mixed_pages(spark, sf_dir)).select(
        "page_id", F.transform("outcomes", lambda o: o["dst"]).alias("targets")
    )
    return found.select(
        "page_id",
        F.array_join(outcomes.all_or_null(F.col("targets")), "|").alias("all_or_null"),
        F.array_join(outcomes.present_only(F.col("targets")), "|").alias("present_only"),
    )


@query
def links_per_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.links_per_page(corpora.mixed_pages(spark, sf_dir), "forgive")


@query
def seed_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many seeds each policy reads from all hrefs of the mixed pages."""
    found = links.link_outcomes(corpora.mixed_pages(spark, sf_dir)).where("href IS NOT NULL")
    hrefs = found.select(F.col("href").alias("url"))
    texts = stage_table(hrefs.distinct(), "texts")
    counted = [
        sources.seeds(texts, "url", name, (urls.MALFORMED,)).agg(F.count("*").alias("seeds")).select(
            F.lit(name).alias("policy"), "seeds"
        )
        for name in policy.POLICIES
    ]
    return reduce(DataFrame.unionByName, counted)


@query
def parse_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All URLs of the mixed pages, gated by host."""
    found = every_url(spark, sf_dir).withColumn("batch", urls.host_of(F.col("url")))
    return sources.parse_gate(stage_table(found, "urls"), "batch").select("batch", "url")


# URL functions.


@query
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return every_url(spark, sf_dir).select(urls.url_parts(F.col("url")).alias("part")).select("part.*")


@query
def can_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return every_url(spark, sf_dir).select("url", urls.can_parse(F.col("url")).alias("can_parse"))


@query
def ignored_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return every_url(spark, sf_dir).select("url", urls.ignore_reason(F.col("url")).alias("ignore_reason"))


@query
def ignore_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = urls.ignore_reason(F.col("url"), SPAM_HOSTS, ("zip", "html"))
    return every_url(spark, sf_dir).groupBy(reason.alias("ignore_reason")).agg(F.count("*").alias("urls"))


@query
def admitted_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.extract_links(corpora.mixed_pages(spark, sf_dir))
    return heuristics.blocking(SPAM_HOSTS).admit(found, "dst").select("page_id", "pos", "dst")


@query
def url_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return every_url(spark, sf_dir).select("url", urls.url_priority(F.col("url")).alias("priority"))


@query
def display_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return every_url(spark, sf_dir).select("url", urls.display_label(F.col("url")).alias("label"))


# Queue.


@query
def queue_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_position(page_frontier(spark, sf_dir), queue.ORDER).select("position", "url", "priority")


@query
def dequeue_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue.dequeue_n(page_frontier(spark, sf_dir), DEQUEUED)[0].select("url", "priority")


@query
def dequeue_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue.dequeue_n(page_frontier(spark, sf_dir), DEQUEUED)[1].select("url", "priority")


@query
def queue_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue.queue_size(page_frontier(spark, sf_dir))


# Graphs and counts.


@query
def in_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.in_degree(admitted_targets(spark, sf_dir))


def _crawled_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admitted links, repeats included, of the parseable pages that a crawl of the shop visits."""
    pages = corpora.shop_pages(spark, sf_dir)
    found = heuristics.DEFAULT.admit(links.extract_links(pages, parseable_only=True).select("src", "dst"), "dst")
    found = stage_table(found, "shop-links")
    crawled = frontier.crawl(pages, corpora.shop_seeds(spark, sf_dir), max_depth=1, links=found)
    return graph.crawled_links(found, crawled)


@query
def in_degree_crawled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.in_degree(_crawled_links(spark, sf_dir))


@query
def crawl_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.crawl_size(admitted_targets(spark, sf_dir))


@query
def page_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.page_vertices(links.extract_links(corpora.mixed_pages(spark, sf_dir)))


@query
def page_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.page_edges(corpora.mixed_pages(spark, sf_dir))


def _page_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links of the given pages, as a stage table, with their global vertices and edges."""
    found = stage_table(links.extract_links(corpora.pages(spark, sf_dir)).select("src", "dst"), "links")
    return (found, *graph.global_graph(found))


@query
def global_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, vertices, _ = _page_graph(spark, sf_dir)
    return vertices.groupBy("url").agg(F.count("*").alias("vertices"), F.countDistinct("id").alias("ids"))


def _by_url(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    return graph.resolve_edges(vertices, edges).select("src_url", "dst_url", "type")


@query
def global_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, vertices, edges = _page_graph(spark, sf_dir)
    return _by_url(vertices, edges)


@query
def edges_by_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges among the targets alone: sources without a vertex drop out unless they are targets too."""
    found = stage_table(links.extract_links(corpora.mixed_pages(spark, sf_dir)).select("src", "dst"), "links")
    targets, _ = graph.number_urls(found.select(F.col("dst").alias("url")).distinct())
    return _by_url(targets, graph.edges_by_url(found, targets))


@query
def property_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page-local vertices and edges of all pages put together: ids collide and collapse."""
    pages = corpora.mixed_pages(spark, sf_dir)
    vertices = graph.page_vertices(links.extract_links(pages))
    return graph.property_graph(vertices, graph.page_edges(pages))[0]


def _debt_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Edges from every customer to their orders; only customers in debt and open orders are vertices."""
    customers = corpora.table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    orders = corpora.table(spark, sf_dir, "orders")
    vertices = customers.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("url")).unionByName(
        orders.filter("o_orderstatus = 'O'").select(
            (-1 - F.col("o_orderkey")).alias("id"), F.concat(F.lit("order-"), "o_orderkey").alias("url")
        )
    )
    edges = orders.select(
        F.col("o_custkey").alias("src"), (-1 - F.col("o_orderkey")).alias("dst"), F.lit(graph.LINK).alias("type")
    )
    return vertices, edges


@query
def resolved_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.resolve_edges(*_debt_graph(spark, sf_dir))


@query
def labelled_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.labelled_edges(*_debt_graph(spark, sf_dir))


@query
def appended_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the given and of the mixed pages, nothing merged, counted by end."""
    given = links.extract_links(corpora.pages(spark, sf_dir)).select("src", "dst")
    mixed = links.extract_links(corpora.mixed_pages(spark, sf_dir)).select("src", "dst")
    return graph.append(given, mixed).groupBy("src", "dst").agg(F.count("*").alias("links"))


@query
def graph_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, vertices, edges = _page_graph(spark, sf_dir)
    return graph.graph_stats(vertices, edges)


@query
def crawl_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, vertices, edges = _page_graph(spark, sf_dir)
    return graph.summary(heuristics.DEFAULT.admit(found, "dst"), vertices, edges)


# What a crawl reports, ranks and stores of the pages it visited.


@query
def crawl_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stage_table(_crawled_links(spark, sf_dir), "crawled-links")
    return graph.summary(found, *graph.global_graph(found))


@query
def crawl_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stage_table(_crawled_links(spark, sf_dir), "crawled-links")
    vertices, edges = graph.global_graph(found)
    return rounded(label_ranks(pagerank(edges, vertices, iterations=ROUNDS), vertices), "url")


@query
def crawl_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stage_table(_crawled_links(spark, sf_dir), "crawled-links")
    path = stage_path(spark, "graph")
    graph_tables.write_graph(*graph.global_graph(found), path)
    delete_at_exit(spark, path)
    return _by_url(graph_tables.read_nodes(spark, path), graph_tables.read_relations(spark, path))


# Frontier and crawl.


@query
def frontier_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.seed_frontier(sources.seeds(corpora.pages(spark, sf_dir)))


@query
def unvisited_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of the mixed pages that are no page themselves."""
    targets = links.extract_links(corpora.mixed_pages(spark, sf_dir)).select(F.col("dst").alias("url")).distinct()
    return frontier.unvisited(targets, corpora.pages(spark, sf_dir))


@query
def fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every URL the mixed pages name, with the html of its pages from a store laid out by URL."""
    wanted = stage_table(every_url(spark, sf_dir), "wanted")
    found = page_store.fetch_stored(wanted, page_store.store_pages(corpora.pages(spark, sf_dir)))
    return found.select("url", F.md5("html").alias("html_md5"), "error_class")


@query
def frontier_wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stage_table(frontier.admitted_links(corpora.shop_pages(spark, sf_dir)), "links")
    pending = frontier.seed_frontier(corpora.shop_seeds(spark, sf_dir))
    visited = pending.select("url").filter(F.lit(False))
    for size in WAVES:
        wave, pending = frontier.expand_wave(pending, visited, found, size)
        wave, pending = settle(wave), settle(pending)
        visited = visited.unionByName(wave.select("url"))
    return pending


def _shop_crawl(spark: SparkSession, sf_dir: str, **options: object) -> DataFrame:
    return frontier.crawl(corpora.shop_pages(spark, sf_dir), corpora.shop_seeds(spark, sf_dir), **options)


@query
def crawl_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shop_crawl(spark, sf_dir, max_depth=CRAWL_DEPTH)


@query
def crawl_best_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shop_crawl(spark, sf_dir, mode="best_first", **BEST_FIRST)


@query
def crawl_custom_heuristics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations first and orders ignored."""

    def priority(url: Column) -> Column:
        return F.when(url.contains("/nation/"), 0).otherwise(F.length(url))

    def ignore(url: Column) -> Column:
        return F.when(url.contains("/order/"), "order")

    return _shop_crawl(
        spark, sf_dir, max_depth=CRAWL_DEPTH, heuristics=heuristics.Heuristics(priority, ignore)
    )


@query
def crawl_constant_heuristics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shop_crawl(spark, sf_dir, max_depth=CRAWL_DEPTH, heuristics=heuristics.constant())


# PageRank.


@query
def pagerank_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pagerank(corpora.hop_edges(spark, sf_dir), iterations=ROUNDS))


@query
def pagerank_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pagerank(corpora.hop_edges(spark, sf_dir)))


@query
def pagerank_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pagerank(corpora.part_edges(spark, sf_dir), iterations=ROUNDS))


@query
def pagerank_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, vertices, edges = _page_graph(spark, sf_dir)
    return rounded(label_ranks(pagerank(edges, vertices), vertices), "url")


# Sinks.


def _stored_graph(spark: SparkSession, sf_dir: str) -> str:
    _, vertices, edges = _page_graph(spark, sf_dir)
    path = stage_path(spark, "graph")
    graph_tables.write_graph(vertices, edges, path)
    delete_at_exit(spark, path)
    return path


@query
def graph_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_tables.verify_graph(spark, _stored_graph(spark, sf_dir))


@query
def stored_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_tables.read_nodes(spark, _stored_graph(spark, sf_dir)).select("url")


@query
def stored_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored_graph(spark, sf_dir)
    return _by_url(graph_tables.read_nodes(spark, path), graph_tables.read_relations(spark, path))


# Streaming.


def _page_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages, spread over files that arrive one by one."""
    folder = stage_path(spark, "arriving")
    corpora.pages(spark, sf_dir).repartition(ARRIVALS, "page_id").write.parquet(folder)
    delete_at_exit(spark, folder)
    return accumulate.page_stream(spark, folder, files_per_batch=1)


@query
def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many micro-batches brought links."""
    arriving = accumulate.stream_links(_page_stream(spark, sf_dir))
    return accumulate.accumulate_links(arriving).agg(F.countDistinct("batch_id").alias("batches"))


@query
def stream_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    arriving = accumulate.stream_links(_page_stream(spark, sf_dir), "strict")
    return accumulate.accumulate_links(arriving).select("page_id", "pos", "src", "dst")


@query
def stream_in_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    arriving = heuristics.DEFAULT.admit(accumulate.stream_links(_page_stream(spark, sf_dir)), "dst")
    return accumulate.running_in_degree(arriving)


@query
def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accumulate.first_seen(accumulate.stream_links(_page_stream(spark, sf_dir))).select("url")


@query
def stream_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    arriving = accumulate.stream_links(_page_stream(spark, sf_dir)).select("src", "dst")
    return accumulate.accumulate_links(arriving).groupBy("src", "dst").agg(F.count("*").alias("edges"))


@query
def stream_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accumulate.running_sizes(_page_stream(spark, sf_dir))
