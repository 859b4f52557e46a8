"""Frontier expansion from seeds over a table of pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.heuristics import DEFAULT, Heuristics
from linkloom.functions.urls import PROTOCOL
from linkloom.operators.adjacency import HOT_EDGES, Adjacency, lay_out
from linkloom.operators.keys import join_side
from linkloom.operators.links import extract_links
from linkloom.operators.ordering import head_cut, up_to
from linkloom.operators.policy import Forgiveness
from linkloom.operators.queue import ORDER, dequeue_n
from linkloom.session import delete_at_exit, drop_stage, iterating, settle, stage_path, stage_table

MODES = ("level", "best_first")
# Levels of a crawl after which the visited URLs become one frame.
FOLDED = 8


def seed_frontier(seeds: DataFrame, heuristics: Heuristics = DEFAULT) -> DataFrame:
    """Admitted seeds as ``frontier(url, priority, depth)`` at depth 0, one row per URL."""
    return (
        heuristics.admit(seeds.select("url").distinct())
        .select("url", heuristics.priority(F.col("url")).cast("int").alias("priority"), F.lit(0).alias("depth"))
    )


def unvisited(frontier: DataFrame, visited: DataFrame) -> DataFrame:
    return frontier.join(visited.select("url"), "url", "left_anti")


def admitted_links(
    pages: DataFrame,
    heuristics: Heuristics = DEFAULT,
    policy: str = "lax",
    forgive: Forgiveness = (PROTOCOL,),
) -> DataFrame:
    """Distinct ``(src, dst)`` pairs a crawl may follow: from parseable pages, to admitted URLs."""
    links = extract_links(pages, policy, forgive, parseable_only=True).select("src", "dst")
    return heuristics.admit(links.distinct(), "dst")


def next_urls(reached: DataFrame) -> DataFrame:
    """Reached ends ``(dst, depth)`` as one row per URL with its smallest depth."""
    return reached.groupBy(F.col("dst").alias("url")).agg(F.min("depth").alias("depth"))


def scored(urls: DataFrame, heuristics: Heuristics) -> DataFrame:
    return urls.select("url", heuristics.priority(F.col("url")).cast("int").alias("priority"), "depth")


def expand_wave(
    frontier: DataFrame,
    visited: DataFrame,
    links: DataFrame,
    n: int,
    heuristics: Heuristics = DEFAULT,
) -> tuple[DataFrame, DataFrame]:
    """One wave: visit the ``n`` best URLs, enqueue what their pages link to.

    ``links`` are :func:`admitted_links`.  Gives the visited URLs of this wave
    and the new frontier; a pending URL that is reached again keeps its
    smallest depth.
    """
    wave, rest = dequeue_n(frontier, n)
    sources = wave.select(F.col("url").alias("src"), (F.col("depth") + 1).alias("depth"))
    reached = links.join(join_side(sources, "src"), "src")
    fresh = unvisited(unvisited(next_urls(reached), visited), wave)
    pending = (
        rest.select("url", "depth").unionByName(fresh).groupBy("url").agg(F.min("depth").alias("depth"))
    )
    return wave, scored(pending, heuristics)


def crawl(
    pages: DataFrame,
    seeds: DataFrame,
    max_depth: int | None = 2,
    wave_size: int = 4,
    max_pages: int | None = None,
    mode: str = "level",
    heuristics: Heuristics = DEFAULT,
    policy: str = "lax",
    forgive: Forgiveness = (PROTOCOL,),
    hot_edges: int = HOT_EDGES,
    links: DataFrame | None = None,
) -> DataFrame:
    """Every URL a crawl visits: ``(url, depth, priority, wave)``.

    ``level`` visits depth by depth; a wave is a level.  ``best_first`` visits
    the ``wave_size`` best pending URLs per wave, so its number of jobs is the
    number of visited URLs over ``wave_size``; a URL's depth is the smallest
    one known when it is visited.  ``max_depth`` and ``max_pages`` bound both;
    ties of the page bound go to the better (priority, url).

    Pages are read once: their distinct admitted links are laid out first, and
    the waves then move URLs only.  A stage table of admitted ``links(src, dst)``
    from parseable pages, repeats included, may be given instead of reading
    ``pages`` again.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; one of {MODES}")
    found = admitted_links(pages, heuristics, policy, forgive) if links is None else links.select("src", "dst").distinct()
    links = stage_table(found, "links")
    start = stage_table(seed_frontier(seeds, heuristics), "seeds")
    adjacency = lay_out(links, hot_edges, start.count())
    with iterating(pages.sparkSession, adjacency.width):
        start = settle(start.repartition(adjacency.width, "url"))
        if mode == "level":
            visited = _by_level(adjacency, start, max_depth, max_pages, heuristics)
        else:
            visited = _best_first(adjacency, start, max_depth, wave_size, max_pages, heuristics)
        visited = settle(visited)
        adjacency.release()
    drop_stage(links)
    return visited


def _by_level(
    adjacency: Adjacency,
    start: DataFrame,
    max_depth: int | None,
    max_pages: int | None,
    heuristics: Heuristics,
) -> DataFrame:
    # Levels since the visited ones were last put together; a plan never holds more than FOLDED of them.
    levels: list[DataFrame] = []
    settled: DataFrame | None = None
    level, seen, depth = start, 0, 0

    def together() -> DataFrame:
        return reduce(DataFrame.unionByName, levels if settled is None else [settled, *levels])

    while True:
        found = level.count()
        if max_pages is not None and seen + found > max_pages:
            levels.append(dequeue_n(level, max_pages - seen)[0])
            break
        levels.append(level)
        seen += found
        depth += 1
        if found == 0 or (max_depth is not None and depth > max_depth):
            break
        if len(levels) >= FOLDED:
            settled, levels = settle(together().repartition(adjacency.width, "url")), []
        reached = adjacency.follow(level.select(F.col("url").alias("src")))
        fresh = unvisited(reached.select(F.col("dst").alias("url")).distinct(), together().select("url"))
        level = settle(scored(fresh.withColumn("depth", F.lit(depth)), heuristics))
    return together().select("url", "depth", "priority", F.col("depth").alias("wave"))


class PriorityQueue:
    """Pending URLs in a folder partitioned by their small integer priority; visited ones in waves beside it.

    Discoveries are appended, never merged in place; the driver keeps, per
    priority, how many entries were appended (one number per priority value).
    A wave reads only the lowest priorities that can fill it: partition
    pruning skips the others, and visited URLs are looked up in the same
    priorities only, since a URL's priority follows from the URL.  Visited
    waves are appended too and folded into one table every ``FOLDED`` waves,
    so the bytes one wave writes follow the wave, not what was visited before.
    """

    def __init__(self, start: DataFrame) -> None:
        self.spark = start.sparkSession
        root = stage_path(self.spark, "best-first")
        delete_at_exit(self.spark, root)
        self.pending, self.visited, self.root = f"{root}/pending", f"{root}/visited", root
        self.counts: dict[int, int] = {}
        self.waves = 0
        self.push(start)

    def push(self, found: DataFrame) -> None:
        """Append ``(url, priority, depth)`` rows and count them by priority."""
        found = settle(found.select("url", "priority", "depth"))
        for row in found.groupBy("priority").count().collect():
            self.counts[row["priority"]] = self.counts.get(row["priority"], 0) + row["count"]
        found.write.mode("append").partitionBy("priority").parquet(self.pending)

    def _read(self, path: str, chosen: list[int]) -> DataFrame:
        nulls = None in chosen
        values = [p for p in chosen if p is not None]
        keep = F.col("priority").isin(values) if values else F.lit(False)
        return self.spark.read.parquet(path).where(keep | F.col("priority").isNull() if nulls else keep)

    def live(self, chosen: list[int]) -> DataFrame:
        """Pending URLs of the ``chosen`` priorities not visited yet, each once with its smallest depth."""
        pending = self._read(self.pending, chosen)
        if self.waves:
            pending = pending.join(self._read(self.visited, chosen).select("url"), "url", "left_anti")
        return pending.groupBy("url", "priority").agg(F.min("depth").alias("depth"))

    def best(self, room: int) -> tuple[DataFrame, int]:
        """The live pending rows that fill a wave of ``room``: lowest priorities first, as few as will do."""
        order = sorted(self.counts, key=lambda p: (p is not None, p))  # null priorities sort first, as in ORDER
        chosen: list[int] = []
        need = room
        while True:
            total = 0
            while order and total < need:  # the appended counts bound what is alive from above
                chosen.append(order.pop(0))
                total += self.counts[chosen[-1]]
            live = settle(self.live(chosen))
            found = {row["priority"]: row["count"] for row in live.groupBy("priority").count().collect()}
            for p in chosen:
                if p not in found:
                    self.counts.pop(p, None)  # all its entries were visited: never read again
            alive = sum(found.values())
            if alive >= room or not order:
                return live, alive
            need = room - alive

    def visit(self, picked: DataFrame) -> None:
        picked.select("url", "priority", "depth", F.lit(self.waves).alias("wave")).write.mode("append").partitionBy("priority").parquet(self.visited)
        self.waves += 1
        if self.waves % FOLDED == 0:
            folded = f"{self.root}/visited-{self.waves}"
            self.spark.read.parquet(self.visited).repartition("priority").write.partitionBy("priority").parquet(folded)
            self.visited = folded

    def visited_rows(self) -> DataFrame:
        if not self.waves:
            return self.spark.createDataFrame([], "url string, depth int, priority int, wave int")
        return self.spark.read.parquet(self.visited).select("url", "depth", "priority", "wave")


def _best_first(
    adjacency: Adjacency,
    start: DataFrame,
    max_depth: int | None,
    wave_size: int,
    max_pages: int | None,
    heuristics: Heuristics,
) -> DataFrame:
    queue = PriorityQueue(start)
    visited = 0
    while queue.counts:
        room = wave_size if max_pages is None else min(wave_size, max_pages - visited)
        if room < 1:
            break
        live, alive = queue.best(room)
        cut, taken = head_cut(live, ORDER, room) if alive else (None, 0)
        if cut is None:
            break
        picked = settle(live.filter(up_to(cut, ORDER, live)))
        queue.visit(picked)
        sources = picked if max_depth is None else picked.filter(F.col("depth") < max_depth)
        reached = next_urls(
            adjacency.follow(sources.select(F.col("url").alias("src"), (F.col("depth") + 1).alias("depth")))
        )
        queue.push(scored(reached, heuristics))
        visited += taken
    return queue.visited_rows()
