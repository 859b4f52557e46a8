"""Queue order and crawls against brute force."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from linkloom.functions import heuristics
from linkloom.operators import frontier, ordering, queue
from linkloom.sources.pages import PAGE_SCHEMA

ENTRIES = [("e", 1), ("a", 3), ("d", 1), ("b", 2), ("c", 2)]
IN_ORDER = ["d", "e", "b", "c", "a"]


@pytest.fixture(params=[10_000, 0], ids=["top-k", "distributed sort"])
def either_way(request, monkeypatch):
    monkeypatch.setattr(ordering, "TOP_ROWS", request.param)


@pytest.mark.parametrize("n", [0, 3, 5, 9])
def test_dequeue(spark, either_way, n):
    pending = spark.createDataFrame(ENTRIES, "url string, priority int")
    taken, rest = queue.dequeue_n(pending, n)
    assert {r.url for r in taken.collect()} == set(IN_ORDER[:n])
    assert {r.url for r in rest.collect()} == set(IN_ORDER[n:])


def test_queue_order_and_size(spark):
    pending = spark.createDataFrame(ENTRIES, "url string, priority int")
    assert [r.url for r in queue.queue_order(pending).collect()] == IN_ORDER
    assert queue.queue_size(pending).first()[0] == 5


def test_positions_over_many_partitions(spark):
    numbers = random.Random(1).sample(range(10**6), 5000)
    frame = spark.createDataFrame([(n,) for n in numbers], "n int").repartition(13)
    got = {r.n: r.position for r in ordering.with_position(frame, ["n"]).collect()}
    assert got == {n: i for i, n in enumerate(sorted(numbers))}


def test_top_linked_breaks_ties_by_url(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "url string, in_degree bigint")
    assert [r.url for r in queue.top_linked(counts).collect()] == ["a"]


# Crawls over a random web in which one page links to every other.


@pytest.fixture(scope="module")
def web():
    pick = random.Random(11)
    urls = [f"http{'s' * (i % 2)}://h/{'d/' * (i % 3)}{i}" for i in range(80)]
    web = {url: pick.sample(urls, 3) for url in urls[:60]}
    web[urls[5]] = list(urls)
    web[urls[6]] = [urls[7], "http://h/picture.jpg", "http://hack.example/x", "mailto:a@b"]
    return urls, web


@pytest.fixture(scope="module")
def pages(spark, web):
    rows = [(i, url, "".join(f'<a href="{to}">' for to in targets)) for i, (url, targets) in enumerate(web[1].items())]
    return spark.createDataFrame(rows, PAGE_SCHEMA)


def score(url):
    path = url.split("//h", 1)[1]
    return (0 if url.startswith("https") else 10) + path.count("/")


def targets(web, url):
    return {to for to in web.get(url, []) if to.startswith("http") and "://h/" in to and not to.endswith(".jpg")}


def levels(web, seeds, max_depth):
    depth = dict.fromkeys(seeds, 0)
    level = list(seeds)
    d = 0
    while level and (max_depth is None or d < max_depth):
        d += 1
        level = sorted({to for url in level for to in targets(web, url)} - depth.keys())
        depth.update(dict.fromkeys(level, d))
    return depth


def best_first(web, seeds, max_depth, wave_size, max_pages):
    pending, visited = dict.fromkeys(seeds, 0), {}
    wave = 0
    while pending and (max_pages is None or len(visited) < max_pages):
        room = wave_size if max_pages is None else min(wave_size, max_pages - len(visited))
        taken = sorted(pending, key=lambda url: (score(url), url))[:room]
        for url in taken:
            visited[url] = (pending.pop(url), wave)
        for url in taken:
            depth = visited[url][0] + 1
            if max_depth is not None and depth > max_depth:
                continue
            for to in targets(web, url) - visited.keys():
                pending[to] = min(depth, pending.get(to, depth))
        wave += 1
    return visited


@pytest.fixture(scope="module")
def seeds(spark, web):
    chosen = [web[0][0], web[0][6]]
    return chosen, spark.createDataFrame([(url,) for url in chosen], "url string")


@pytest.mark.parametrize("max_depth, hot_edges", [(0, 100), (2, 100_000), (2, 10), (None, 10)])
def test_levels(web, pages, seeds, max_depth, hot_edges):
    crawled = frontier.crawl(pages, seeds[1], max_depth=max_depth, hot_edges=hot_edges).collect()
    assert {r.url: r.depth for r in crawled} == levels(web[1], seeds[0], max_depth)
    assert len(crawled) == len({r.url for r in crawled})
    assert all(r.priority == score(r.url) and r.wave == r.depth for r in crawled)


def test_levels_with_a_page_budget(web, pages, seeds):
    crawled = frontier.crawl(pages, seeds[1], max_depth=None, max_pages=20).collect()
    order = sorted(levels(web[1], seeds[0], None).items(), key=lambda e: (e[1], score(e[0]), e[0]))
    assert {r.url for r in crawled} == {url for url, _ in order[:20]}


@pytest.mark.parametrize("max_depth, max_pages, hot_edges", [(2, None, 10), (None, 25, 100_000)])
def test_best_first(web, pages, seeds, max_depth, max_pages, hot_edges):
    crawled = frontier.crawl(
        pages, seeds[1], max_depth, 7, max_pages, mode="best_first", hot_edges=hot_edges
    ).collect()
    expected = best_first(web[1], seeds[0], max_depth, 7, max_pages)
    assert {r.url: (r.depth, r.wave) for r in crawled} == expected


def test_modes_visit_the_same_pages(web, pages, seeds):
    best = frontier.crawl(pages, seeds[1], None, 30, mode="best_first")
    level = frontier.crawl(pages, seeds[1], None)
    assert {r.url for r in best.collect()} == {r.url for r in level.collect()}


def test_pages_that_do_not_look_like_html_are_not_followed(spark):
    rows = [(1, "http://h/a.pdf", '<a href="/b">'), (2, "http://h/c", '<a href="/a.pdf">'), (3, "http://h/x.jpg", "")]
    pages = spark.createDataFrame(rows, PAGE_SCHEMA)
    start = spark.createDataFrame([("http://h/a.pdf",), ("http://h/c",), ("http://h/c",)], "url string")
    admit_all = heuristics.constant()
    crawled = frontier.crawl(pages, start, heuristics=admit_all).collect()
    assert sorted((r.url, r.depth) for r in crawled) == [("http://h/a.pdf", 0), ("http://h/c", 0)]


def test_heuristics_are_pluggable(spark, pages, seeds):
    @F.pandas_udf("int")
    def shortest(url: pd.Series) -> pd.Series:
        return url.str.len().astype("int32")

    chosen = heuristics.Heuristics(shortest, lambda url: F.when(url.startswith("https"), "https"))
    crawled = frontier.crawl(pages, seeds[1], max_depth=2, heuristics=chosen).collect()
    assert crawled and all(r.priority == len(r.url) and not r.url.startswith("https") for r in crawled)


def test_waves(spark, web, pages, seeds):
    links = frontier.admitted_links(pages)
    pending = frontier.seed_frontier(seeds[1])
    nothing = pending.select("url").limit(0)
    wave, after = frontier.expand_wave(pending, nothing, links, 1)
    first = min(seeds[0], key=lambda url: (score(url), url))
    assert [r.url for r in wave.collect()] == [first]
    reached = targets(web[1], first) | set(seeds[0])
    assert {r.url for r in after.collect()} == reached - {first}


def test_unknown_mode(pages, seeds):
    with pytest.raises(ValueError):
        frontier.crawl(pages, seeds[1], mode="random")


def test_a_deep_chain_is_followed_to_its_end(spark):
    chain = [(k, f"http://h/{k}", f'<a href="/{k + 1}">') for k in range(20)]
    pages = spark.createDataFrame(chain, "page_id long, url string, html string")
    seeds = spark.createDataFrame([("http://h/0",)], "url string")
    found = {r["url"]: r["depth"] for r in frontier.crawl(pages, seeds, max_depth=None).collect()}
    assert found == {f"http://h/{k}": k for k in range(21)}


def test_a_crawl_leaves_only_its_result(spark):
    from pathlib import Path

    from linkloom.session import checkpoint_root

    folder = Path(checkpoint_root(spark).removeprefix("file:")) / "linkloom"
    before = {p.name for p in folder.glob("links-*")}
    pages = spark.createDataFrame([(1, "http://h/", '<a href="/a">')], "page_id long, url string, html string")
    assert frontier.crawl(pages, spark.createDataFrame([("http://h/",)], "url string")).count() == 2
    assert {p.name for p in folder.glob("links-*")} == before


def test_priority_queue_reads_only_the_lowest_priorities(spark):
    from linkloom.operators.frontier import PriorityQueue

    start = spark.createDataFrame([(f"http://q.example/{i}", i % 5, 0) for i in range(50)], "url string, priority int, depth int")
    queue = PriorityQueue(start)
    live, alive = queue.best(4)
    assert alive == 10 and {r["priority"] for r in live.collect()} == {0}
    plan = queue.live([0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(priority" in plan and "priority#" in plan
    queue.visit(live.where("url < 'http://q.example/3'"))  # 0, 10, 15, 20, 25
    live, alive = queue.best(9)
    assert alive == 5 + 10 and {r["priority"] for r in live.collect()} == {0, 1}
    assert queue.visited_rows().count() == 5
