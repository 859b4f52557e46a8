"""PageRank against golden values, brute force and its own invariants."""

from __future__ import annotations

import os
import random
import time
from collections import Counter

import pytest

from linkloom import session
from linkloom.operators import adjacency
from linkloom.operators import pagerank as module
from linkloom.operators.pagerank import pagerank

GOLDEN = {
    "cycle_sink": (
        range(6),
        [(0, 1), (0, 2), (1, 2), (2, 0), (3, 2), (2, 4)],
        [1.205144, 0.885874, 1.956298, 0.373770, 1.205144, 0.373770],
        [1.210893, 0.884617, 1.958825, 0.367386, 1.210893, 0.367386],
    ),
    "multi_edge": (
        range(3),
        [(0, 1), (0, 1), (0, 2), (1, 0)],
        [1.244604, 1.053989, 0.701407],
        [1.240614, 1.059609, 0.699778],
    ),
    "no_edges": (range(2), [], [1, 1], [1, 1]),
    "collide": ((0, 0, 1, 7), [(0, 1), (0, 7)], [0.779221, 1.110390, 1.110390], [0.779221, 1.110390, 1.110390]),
}


def ranks(df):
    return {row.id: row["rank"] for row in df.collect()}


@pytest.mark.parametrize("name", GOLDEN)
def test_golden_values(spark, name):
    ids, pairs, converged, fixed = GOLDEN[name]
    edges = spark.createDataFrame(pairs, "src bigint, dst bigint")
    vertices = spark.createDataFrame([(i,) for i in ids], "id bigint")
    for options, expected in (({}, converged), ({"iterations": 10}, fixed)):
        got = ranks(pagerank(edges, vertices, **options))
        assert [got[i] for i in sorted(set(ids))] == pytest.approx(expected, abs=2e-6)


def brute_force(pairs, rounds):
    out = Counter(src for src, _ in pairs)
    ids = {i for pair in pairs for i in pair}
    rank = dict.fromkeys(ids, 1.0)
    for _ in range(rounds):
        sent = dict.fromkeys(ids, 0.0)
        for src, dst in pairs:
            sent[dst] += rank[src] / out[src]
        rank = {i: 0.15 + 0.85 * sent[i] for i in ids}
    scale = len(ids) / sum(rank.values())
    return {i: r * scale for i, r in rank.items()}


@pytest.fixture(scope="module")
def hub_pairs():
    """A third of all edges leave one vertex, a third enter it."""
    pick = random.Random(3)
    ids = [f"v{i}" for i in range(60)]
    pairs = [("hub", pick.choice(ids)) for _ in range(300)] + [(pick.choice(ids), "hub") for _ in range(300)]
    return pairs + [(pick.choice(ids), pick.choice(ids)) for _ in range(300)]


@pytest.mark.parametrize("hot_edges", [5, 100_000])
def test_hot_sources_give_the_same_ranks(spark, hub_pairs, hot_edges):
    edges = spark.createDataFrame(hub_pairs, "src string, dst string")
    got = ranks(pagerank(edges, iterations=7, hot_edges=hot_edges))
    assert got == pytest.approx(brute_force(hub_pairs, 7), abs=1e-9)
    assert sum(got.values()) == pytest.approx(len(got))


def test_converged_is_close_to_many_rounds(spark, hub_pairs):
    edges = spark.createDataFrame(hub_pairs, "src string, dst string")
    assert ranks(pagerank(edges, hot_edges=5)) == pytest.approx(brute_force(hub_pairs, 60), abs=0.02)


@pytest.mark.parametrize("options", [{"iterations": 4}, {}])
def test_text_ids_loop_as_numbers(spark, monkeypatch, options):
    """Text ids, a missing one and an unlinked vertex among them, rank as numbers do; the loop sees numbers only."""
    pick = random.Random(5)
    pairs = [(pick.choice([None, *range(12)]), pick.choice([None, *range(12)])) for _ in range(60)]
    seen = []

    def watched(edges, *rest):
        seen.append(dict(edges.dtypes)["src"])
        return usual(edges, *rest)

    usual = module.lay_out
    monkeypatch.setattr(module, "lay_out", watched)
    edges = spark.createDataFrame(pairs, "src bigint, dst bigint")
    vertices = spark.createDataFrame([(0,), (77,), (None,)], "id bigint")
    numbers = ranks(pagerank(edges, vertices, **options))
    texts = ranks(pagerank(edges.selectExpr("'v' || src src", "'v' || dst dst"), vertices.selectExpr("'v' || id id"), **options))
    assert texts == pytest.approx({i if i is None else f"v{i}": rank for i, rank in numbers.items()}, abs=1e-9)
    assert seen == ["bigint", "bigint"]


@pytest.fixture
def many(monkeypatch):
    """What holds for very many edges holds for few: tables instead of caches, several slices."""
    monkeypatch.setattr(module, "STORED_EDGES", 0)
    monkeypatch.setattr(adjacency, "EDGES_PER_SLICE", 400)
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)


@pytest.mark.parametrize("hot_edges", [5, 100_000])
def test_stored_edges_give_the_same_ranks(spark, many, hub_pairs, hot_edges):
    edges = spark.createDataFrame(hub_pairs, "src string, dst string")
    assert ranks(pagerank(edges, iterations=7, hot_edges=hot_edges)) == pytest.approx(brute_force(hub_pairs, 7), abs=1e-9)
    assert ranks(pagerank(edges, iterations=0)) == pytest.approx(dict.fromkeys({i for pair in hub_pairs for i in pair}, 1.0))
    assert not spark.sql("SHOW TABLES").filter("tableName LIKE 'linkloom_%' AND tableName NOT LIKE 'linkloom_pages%'").count()


def test_stored_golden_values(spark, many):
    test_golden_values(spark, "multi_edge")


def test_stored_missing_ids_and_no_edges(spark, many):
    pairs = [(None, 1), (1, None), (1, 2), (1, 2), (None, None), (2, 3)]
    vertices = spark.createDataFrame([(7,), (None,)], "id bigint")
    edges = spark.createDataFrame(pairs, "src bigint, dst bigint")
    stored = ranks(pagerank(edges, vertices, iterations=3))
    module.STORED_EDGES = 100
    assert stored == pytest.approx(ranks(pagerank(edges, vertices, iterations=3)), abs=1e-12)
    module.STORED_EDGES = 0
    assert ranks(pagerank(edges.limit(0), iterations=3)) == {}


def shuffled(spark):
    """Bytes of the shuffle files on disk, by shuffle."""
    found = Counter()
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    for at in range(files.size()):
        path = files.apply(at).getPath()
        if os.path.basename(path).startswith("shuffle_") and os.path.exists(path):
            found[int(os.path.basename(path).split("_")[1])] += os.path.getsize(path)
    return found


def test_disk_holds_one_round(spark, monkeypatch):
    """Of very many edges neither the shuffle files of earlier rounds nor earlier states or edges stay on disk."""
    monkeypatch.setattr(module, "STORED_EDGES", 0, raising=False)
    pick = random.Random(9)
    edges = spark.createDataFrame([(pick.randrange(9000), pick.randrange(9000)) for _ in range(20_000)], "src bigint, dst bigint")
    folder = f"{session.checkpoint_root(spark)}/linkloom".removeprefix("file:")
    tables = set(os.listdir(folder)) if os.path.exists(folder) else set()
    before = set(shuffled(spark))
    most = []

    def watched(state, *rest):
        most.append(sum(name.startswith("state-") for name in set(os.listdir(folder)) - tables))
        return usual(state, *rest)

    usual = module.drop_stage if hasattr(module, "drop_stage") else None
    monkeypatch.setattr(module, "drop_stage", watched, raising=False)
    ranked = pagerank(edges, iterations=6)
    left = Counter()
    for _ in range(50):  # removed files go in the background
        left = Counter({shuffle: size for shuffle, size in shuffled(spark).items() if shuffle not in before})
        if sum(left.values()) < 50_000:
            break
        time.sleep(0.2)
    assert sum(left.values()) < 50_000  # a single round shuffles over 200,000
    assert max(most) == 2
    kept = Counter(name.rpartition("-")[0] for name in set(os.listdir(folder)) - tables)
    assert not kept.keys() & {"edges", "weights", "cold-edges", "hot-edges", "nodes"} and kept["state"] == 1
    assert ranked.count() == len({i for row in edges.collect() for i in row})


def test_settings_are_restored(spark, hub_pairs):
    names = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")
    before = [spark.conf.get(name) for name in names]
    pagerank(spark.createDataFrame(hub_pairs[:10], "src string, dst string"), iterations=1)
    assert [spark.conf.get(name) for name in names] == before
