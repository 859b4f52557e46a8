"""Links, in-degrees, first-seen URLs and sizes kept up to date as pages arrive.

Each job reads a file source until it is exhausted (``availableNow``), writes
one folder per micro-batch and returns the table read back, so a repeated
batch replaces its own folder.  Keyed state lives in RocksDB, outside the heap.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions.heuristics import DEFAULT, Heuristics
from linkloom.functions.urls import PROTOCOL
from linkloom.operators.links import extract_links, kept_links
from linkloom.operators.policy import Forgiveness
from linkloom.session import delete_at_exit, stage_path
from linkloom.sources.pages import PAGE_SCHEMA

# Files one micro-batch takes, so that a backlog is worked off in batches of bounded size.
FILES_PER_BATCH = 1_000
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _spilling_state(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before)


def page_stream(
    spark: SparkSession, folder: str, pattern: str = "*.parquet", files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Page files of ``folder`` as a stream, at most ``files_per_batch`` in a micro-batch."""
    reader = spark.readStream.schema(PAGE_SCHEMA).option("pathGlobFilter", pattern)
    return reader.option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def _run(stream: DataFrame, mode: str, name: str, path: str | None) -> str:
    """Run ``stream`` to its present end; each micro-batch replaces its own folder."""
    spark = stream.sparkSession
    target = path or stage_path(spark, name)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/rows/batch_id={batch_id}")

    with _spilling_state(spark):
        query = (
            stream.writeStream.outputMode(mode)
            .option("checkpointLocation", f"{target}/progress")
            .trigger(availableNow=True)
            .foreachBatch(store)
            .start()
        )
        query.awaitTermination()
    if path is None:
        delete_at_exit(spark, target)
    return f"{target}/rows"


def _stored(stream: DataFrame, rows: str) -> DataFrame:
    schema = T.StructType([*stream.schema.fields, T.StructField("batch_id", T.LongType())])
    return stream.sparkSession.read.schema(schema).parquet(rows)


def stream_links(
    pages: DataFrame, policy: str = "lax", forgive: Forgiveness = (PROTOCOL,)
) -> DataFrame:
    """Arriving pages as link rows; stateless, any page-level policy."""
    return extract_links(pages, policy, forgive)


def accumulate_links(links: DataFrame, path: str | None = None) -> DataFrame:
    """The growing edge table: every link of every batch, with its ``batch_id``."""
    return _stored(links, _run(links, "append", "links", path))


def running_in_degree(links: DataFrame, path: str | None = None) -> DataFrame:
    """``(url, in_degree)``.

    Batches store the counts they changed; counts only grow, so the current one
    is the largest.  The state keeps one count per URL ever seen.
    """
    counts = links.groupBy(F.col("dst").alias("url")).agg(F.count("*").alias("in_degree"))
    changes = _stored(counts, _run(counts, "update", "in-degree", path))
    return changes.groupBy("url").agg(F.max("in_degree").alias("in_degree"))


def first_seen(links: DataFrame, path: str | None = None) -> DataFrame:
    """``(url, batch_id)``: each linked URL once, in the batch that brought it first.

    The state keeps one row per URL ever seen; nothing bounds it, as no event
    time exists.  It is an aggregation rather than a deduplication so that a
    URL's repeats are merged before the shuffle: the batch times a URL was seen
    in coincide exactly when this batch is its first.
    """
    seen = (
        links.select(F.col("dst").alias("url"), F.current_timestamp().alias("at"))
        .groupBy("url")
        .agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))
        .filter(F.col("first_at") == F.col("last_at"))
        .select("url")
    )
    stored = _stored(seen, _run(seen, "update", "first-seen", path))
    # Two batches of one and the same clock reading may both report a URL.
    return stored.groupBy("url").agg(F.min("batch_id").alias("batch_id"))


def running_sizes(
    pages: DataFrame,
    policy: str = "lax",
    forgive: Forgiveness = (PROTOCOL,),
    heuristics: Heuristics = DEFAULT,
    path: str | None = None,
) -> DataFrame:
    """``(pages, vertices, edges, queued)`` after the last batch, in one row.

    Vertices and edges are counted as pages bring them (see
    :func:`linkloom.operators.graph.page_edges`); ``queued`` counts the admitted
    links.  Counts are summed within each task before they meet.
    """
    targets = kept_links(pages, policy, forgive).select(
        "url", F.transform("kept", lambda link: link["dst"]).alias("targets")
    )
    rows = targets.select(
        F.array_contains("targets", F.col("url")).alias("looped"), F.posexplode_outer("targets").alias("pos", "dst")
    )
    linked = F.col("pos").isNotNull()
    sizes = rows.agg(
        F.count_if(F.coalesce("pos", F.lit(0)) == 0).alias("pages"),
        F.count("pos").alias("vertices"),
        F.count_if(linked & F.col("looped")).alias("edges"),
        F.count_if(linked & heuristics.ignore(F.col("dst")).isNull()).alias("queued"),
    )
    stored = _stored(sizes, _run(sizes, "complete", "sizes", path))
    last = stored.agg(F.max_by(F.struct("pages", "vertices", "edges", "queued"), "batch_id").alias("last"))
    return last.select("last.*")
