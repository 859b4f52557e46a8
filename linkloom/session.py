"""Where intermediate results live, and the settings iterative jobs run under."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Rows one task of an iterative job should hold before another is added.
ROWS_PER_TASK = 50_000
# Rows beyond which one task would spill; more partitions are taken, whatever the session says.
MOST_ROWS_PER_TASK = 5_000_000
# Whether Spark removes a query's shuffle files when the query ends, instead of when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints, stream state and stage tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    that names none gets a temporary folder; a cluster without one is refused,
    since a machine-local folder would be lost together with its executor.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="linkloom-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for one written stage table below the shared folder."""
    return f"{checkpoint_root(spark)}/linkloom/{name}-{uuid.uuid4().hex}"


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Remove a folder that was written when the session's JVM ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def drop_stage(table: DataFrame) -> None:
    """Remove the files of a stage table that no later job reads."""
    spark = table.sparkSession
    for path in {file.rpartition("/")[0] for file in table.inputFiles()}:
        if f"{checkpoint_root(spark)}/linkloom/".removeprefix("file:") in path:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def stage_table(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    For results that several later jobs scan.  The table is removed when the
    session's JVM ends, and the shuffle files it was made from once it is written.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    with _settings(spark, {SHUFFLE_CLEANUP: "true"}):
        df.write.parquet(path, compression=compression)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed_table(parts: Iterable[DataFrame], name: str, width: int, *keys: str) -> DataFrame:
    """A stage table of ``width`` buckets, each one file sorted by ``keys``.

    Each of ``parts`` is partitioned into ``width`` by the hash of ``keys`` and sorted
    by them, and no two hold rows of one bucket.  They are written one after the other,
    so the shuffle files of one part alone lie on disk at a time.  Under
    :func:`iterating` the table keeps its partitioning and order, like a
    checkpoint.  The catalog knows it only while it is written.
    """
    parts = iter(parts)
    part = next(parts)
    spark, by = part.sparkSession, ", ".join(keys)
    path, table = stage_path(spark, name), f"spark_catalog.default.linkloom_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in part.schema.fields)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet"
        f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {width} BUCKETS LOCATION '{path}'"
    )
    # The writer sorts by bucket and keys in any case, which takes one pass over rows in
    # order; planned by the optimizer, that sort would replace the one by keys alone.
    writing = {SHUFFLE_CLEANUP: "true", "spark.sql.optimizer.plannedWrite.enabled": "false"}
    try:
        while part is not None:
            with iterating(spark, width), _settings(spark, writing):
                part.write.insertInto(table)
            part = next(parts, None)
        delete_at_exit(spark, path)
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")  # its files stay, being outside the warehouse


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into a checkpoint and cut its lineage.

    For the states of a loop: unlike a table, a checkpoint made under
    :func:`iterating` keeps its partitioning and order.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def loop_width(spark: SparkSession, rows: int) -> int:
    """Partitions for an iterative job: the session's number, fewer for few ``rows``, more for very many."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = math.ceil(rows / MOST_ROWS_PER_TASK)
    return max(1, least, min(usual, math.ceil(rows / ROWS_PER_TASK)))


@contextmanager
def iterating(spark: SparkSession, width: int) -> Iterator[None]:
    """Settings that keep a loop's frames co-partitioned from round to round.

    A checkpoint remembers the hash partitioning of its plan only if the plan
    is static, so adaptive re-planning is off inside the loop; what it would do
    is done beforehand (``width`` is chosen from counted rows, hot keys are
    split off by :mod:`linkloom.operators.adjacency`).  Size-estimated broadcasts
    are off too: only sides of a proven size are broadcast, by explicit hint.
    So is the inference of filters across joins, which would test the URLs of
    all edges again because the seeds were tested.  A bucket of one file
    (:func:`bucketed_table`) is read in the order it was written in.
    """
    wanted = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.constraintPropagation.enabled": "false",
        "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    }
    with _settings(spark, wanted):
        yield
