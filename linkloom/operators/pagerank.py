"""PageRank as a loop of one co-partitioned join and one partial aggregation.

Parallel edges count with their multiplicity; the result is scaled so that the
ranks sum to the number of vertices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.operators.adjacency import HOT_EDGES, Adjacency, lay_out, lay_out_stored, merged
from linkloom.operators.graph import link_urls, number_urls, numbered_ends, url_hash
from linkloom.session import bucketed_table, drop_stage, iterating, loop_width, settle, stage_table

RESET = 0.15
TOLERANCE = 1e-4
# Rounds of a fixed-length run between two settled states.
ROUNDS_PER_STAGE = 5
# Edges from which edges and states are tables, each state dropped once the next is written,
# and every round is stored: the shuffle files of one round alone lie on disk at a time.
STORED_EDGES = 10_000_000


def _nodes(weighted: DataFrame, vertices: DataFrame | None, every: bool = False) -> DataFrame:
    """``(id, out_degree)`` of every end-point and given vertex, from one aggregation.

    ``weighted`` are edges with their ``copies``.  With ``every`` the given vertices
    hold all end-points.
    """
    ends = weighted.select(F.col("src").alias("id"), "copies")
    others = [] if every else [weighted.select(F.col("dst").alias("id"))]
    if vertices is not None:
        others.append(vertices.select("id"))
    for frame in others:
        ends = ends.unionByName(frame.withColumn("copies", F.lit(0).cast("bigint")))
    return ends.groupBy("id").agg(F.sum("copies").alias("out_degree"))


def _text_id(text: Column, attempt: int) -> Column:
    """The number of a text id; no id stays none."""
    return F.when(text.isNotNull(), url_hash(text, attempt))


def _numbered(edges: DataFrame, vertices: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Edges with numbers for text ids, and ``(id, url)``: the text of each number, given vertices included."""
    texts = link_urls(edges)
    if vertices is not None:
        texts = texts.unionByName(vertices.select(F.col("id").alias("url"))).distinct()
    names, moved = number_urls(texts, _text_id)
    return numbered_ends(edges, moved, _text_id), names


def pagerank(
    edges: DataFrame,
    vertices: DataFrame | None = None,
    tol: float = TOLERANCE,
    iterations: int | None = None,
    hot_edges: int = HOT_EDGES,
) -> DataFrame:
    """``ranks(id, rank)`` of ``edges(src, dst)``; every end-point and given vertex has a rank.

    Ids may be of any type; texts are numbered for the loop (see
    :func:`linkloom.operators.graph.number_urls`), so that its messages are small
    and sorted as numbers, and looked up once at the end.

    Without ``iterations`` a vertex keeps passing on its change until the
    change is at most ``tol``, and the loop ends when none is left; with it,
    exactly that many rounds run from ranks of 1.

    A round shuffles partially summed messages only.  States are settled in the
    shared checkpoint folder, so lineage stays short and a lost executor costs
    a few rounds at most.  Of many edges (``STORED_EDGES``) one form at a time lies
    on disk, beside two states and the messages of one round.
    """
    given = edges = stage_table(edges.select("src", "dst"), "edges", "zstd")
    rows = edges.count()
    names = None
    if all(isinstance(edges.schema[end].dataType, T.StringType) for end in ("src", "dst")):
        edges, names = _numbered(edges, vertices)
        vertices = names.select("id")
    companions = 0 if vertices is None else vertices.count()
    spark = edges.sparkSession
    # Nodes are aggregated by id under the loop's settings, so already partitioned like the edges.
    if rows < STORED_EDGES:
        weighted = stage_table(merged(edges), "weights")
        adjacency = lay_out(weighted, hot_edges, companions)
        with iterating(spark, adjacency.width):
            nodes = settle(_nodes(weighted, vertices, names is not None).sortWithinPartitions("id"))
    else:
        weighted = edges.withColumn("copies", F.lit(1).cast("bigint"))
        width = loop_width(spark, max(rows, companions))
        with iterating(spark, width):
            nodes = _nodes(weighted, vertices, names is not None).sortWithinPartitions("id")
        nodes = bucketed_table([nodes], "nodes", width, "id")
        adjacency = lay_out_stored(edges, nodes, rows, width, hot_edges)
    drop_stage(given)
    with iterating(spark, adjacency.width):
        ranks = _until_settled(adjacency, nodes, tol) if iterations is None else _rounds(adjacency, nodes, iterations)
        adjacency.release()
        scale = ranks.agg((F.count("*") / F.sum("rank")).alias("scale")).first()["scale"]
    ranks = ranks.select("id", (F.col("rank") * F.lit(scale)).alias("rank"))
    return ranks if names is None else label_ranks(ranks, names).select(F.col("url").alias("id"), "rank")


def _received(adjacency: Adjacency, passing: DataFrame, amount: str) -> DataFrame:
    """``(id, received)``: the damped sum of what each vertex is sent."""
    shares = passing.filter(F.col("out_degree") > 0).select(
        F.col("id").alias("src"), (F.col(amount) / F.col("out_degree")).alias("share")
    )
    return (
        adjacency.follow(shares)
        .groupBy(F.col("dst").alias("id"))
        .agg(((1 - RESET) * F.sum(F.col("share") * F.col("copies"))).alias("received"))
    )


def _kept(adjacency: Adjacency, state: DataFrame, before: DataFrame) -> DataFrame:
    """The state settled; the state ``before`` goes if it is a table."""
    if not adjacency.stored:
        return settle(state)
    kept = bucketed_table([state], "state", adjacency.width, "id")
    drop_stage(before)
    return kept


def _rounds(adjacency: Adjacency, nodes: DataFrame, iterations: int) -> DataFrame:
    kept, ranks = nodes, nodes.withColumn("rank", F.lit(1.0))
    each = 1 if adjacency.stored else ROUNDS_PER_STAGE
    for done in range(1, iterations + 1):
        received = _received(adjacency, ranks, "rank")
        ranks = kept.select("id", "out_degree").join(received, "id", "left").select(
            "id", "out_degree", (RESET + F.coalesce("received", F.lit(0.0))).alias("rank")
        )
        if done % each == 0 or done == iterations:
            kept = ranks = _kept(adjacency, ranks, kept)
    return ranks


def _until_settled(adjacency: Adjacency, nodes: DataFrame, tol: float) -> DataFrame:
    """Ranks start at the reset value, all of it yet to be passed on."""
    state = nodes.select("id", "out_degree", F.lit(RESET).alias("rank"), F.lit(RESET).alias("delta"))
    passing = (F.col("delta") > tol) & (F.col("out_degree") > 0)
    active = state.filter(passing).count()
    while active:
        received = _received(adjacency, state.filter(passing), "delta")
        delta = F.coalesce("received", F.lit(0.0))
        watch = Observation()
        after = (
            state.join(received, "id", "left")
            .select("id", "out_degree", (F.col("rank") + delta).alias("rank"), delta.alias("delta"))
            .observe(watch, F.count_if(passing).alias("active"))
        )
        state = _kept(adjacency, after, state)
        active = watch.get["active"]
    return state


def label_ranks(ranks: DataFrame, vertices: DataFrame) -> DataFrame:
    """``ranks(id, url, rank)``; an id without a vertex row has no URL."""
    return ranks.join(vertices.select("id", "url"), "id", "left").select("id", "url", "rank")
