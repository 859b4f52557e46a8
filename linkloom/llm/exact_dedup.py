"""Exact deduplication by exchanging Golomb-coded fingerprints.

Every partition sorts the fingerprints of its texts and sends each owner of a
share of the fingerprint space one compressed list.  Owners answer every list
with a bitmap of the entries that were seen more than once.  Only the texts so
marked are shuffled and compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm import golomb
from linkloom.llm.words import fresh, staged

# Bits of a fingerprint; chance agreements only add suspects, which are then compared byte by byte.
FINGERPRINT_BITS = 44
# Fingerprints of one list; a partition with more sends several.
LIST_ROWS = 1_000_000

LISTS = "part long, owner int, coded binary, repeated binary, runs array<int>, ids array<long>"


def _bitmap(bits: np.ndarray) -> bytes:
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _bits(bitmap: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bitmap, np.uint8), count=count).astype(bool)


def _lists(owners: int):
    def send(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 24
        held, rows = [], 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate([h[0] for h in held])
            prints = np.concatenate([h[1] for h in held])
            owner = (prints % np.uint64(owners)).astype(np.int64)
            order = np.lexsort((prints, owner))
            ids, prints, owner = ids[order], prints[order], owner[order]
            out: dict[str, list] = {k: [] for k in ("part", "owner", "coded", "repeated", "runs", "ids")}
            edges = np.flatnonzero(np.diff(owner, prepend=-1))
            for low, high in zip(edges, np.append(edges[1:], len(owner)), strict=True):
                values, runs = np.unique(prints[low:high] // np.uint64(owners), return_counts=True)
                out["part"].append(part)
                out["owner"].append(int(owner[low]))
                out["coded"].append(golomb.encode(values))
                out["repeated"].append(_bitmap(runs > 1))
                out["runs"].append(runs.astype(np.int32))
                out["ids"].append(ids[low:high])
            return pa.RecordBatch.from_pydict(
                out,
                pa.schema(
                    [
                        ("part", pa.int64()),
                        ("owner", pa.int32()),
                        ("coded", pa.binary()),
                        ("repeated", pa.binary()),
                        ("runs", pa.list_(pa.int32())),
                        ("ids", pa.list_(pa.int64())),
                    ]
                ),
            )

        for frame in frames:
            if not frame.num_rows:
                continue
            held.append((frame.column(0).to_numpy(), frame.column(1).to_numpy().astype(np.uint64)))
            rows += frame.num_rows
            if rows >= LIST_ROWS:
                yield flush()
                held, rows, part = [], 0, part + 1
        if rows:
            yield flush()

    return send


def _answer(lists: pd.DataFrame) -> pd.DataFrame:
    """For one owner: which entries of each list it has seen more than once."""
    decoded = [golomb.decode(coded) for coded in lists["coded"]]
    values, seen = np.unique(np.concatenate(decoded), return_counts=True)
    shared = values[seen > 1]
    answers = []
    for entries, repeated in zip(decoded, lists["repeated"], strict=True):
        answers.append(_bitmap(np.isin(entries, shared) | _bits(repeated, len(entries))))
    return pd.DataFrame({"part": lists["part"], "owner": lists["owner"], "bitmap": answers})


def _suspects(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for bitmap, runs, ids in zip(frame["bitmap"], frame["runs"], frame["ids"], strict=True):
            yield pd.DataFrame({"doc_id": np.asarray(ids)[np.repeat(_bits(bitmap, len(runs)), runs)]})


def suspects(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids of the documents whose fingerprint occurs more than once (column ``doc_id``).

    Owners hold ``rows / spark.sql.shuffle.partitions`` fingerprints each, and of
    a text with any number of copies one entry for every list.
    """
    owners = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_column), F.lit(""))
    prints = docs.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.shiftrightunsigned(F.xxhash64(text), 64 - FINGERPRINT_BITS).alias("print"),
    )
    lists = staged(prints.mapInArrow(_lists(owners), LISTS), "fingerprints")
    bitmaps = (
        lists.select("part", "owner", "coded", "repeated")
        .groupBy("owner")
        .applyInPandas(_answer, "part long, owner int, bitmap binary")
    )
    # Stored, so that no task runs two Python workers at once, one behind the other.
    marked = lists.select("part", "owner", "runs", "ids").join(staged(bitmaps, "bitmaps"), ["part", "owner"])
    return marked.select("bitmap", "runs", "ids").mapInPandas(_suspects, "doc_id long")


def duplicate_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each text that occurs more than once: ``text_sha256, keep_id, group_size``.

    A class is found by fingerprint, formed by SHA-256 and confirmed by comparing
    the bytes of its smallest and largest text.  Copies meet partially aggregated,
    so a text held by a third of all rows is one row for each task.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    found = (
        docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"))
        .join(suspects(docs, id_column, text_column).hint("merge"), "doc_id", "left_semi")
        .groupBy(F.sha2("text", 256).alias("text_sha256"))
        .agg(
            F.max("doc_id").alias("keep_id"),
            F.count("*").alias("group_size"),
            F.min("text").alias("low"),
            F.max("text").alias("high"),
        )
        .where("group_size > 1")
    )
    unequal = F.raise_error(F.lit("two different texts have one SHA-256 digest"))
    checked = found.withColumn("group_size", F.when(F.expr("low = high"), F.col("group_size")).otherwise(unequal))
    return checked.select("text_sha256", "keep_id", "group_size")


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the one with the largest id stays.  A null text counts as
    empty.  Rows that repeat an id and its text count each, and all of them carry
    the same ``kept``.  A row without an id stays, as a group of its own.  Other
    columns are not read.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    classes = staged(duplicate_classes(docs, id_column, text_column), "copies")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.sha2(text, 256).alias("text_sha256"))
    known = F.col("doc_id").isNotNull() & F.col("keep_id").isNotNull()
    return rows.join(classes, "text_sha256", "left").select(
        "doc_id",
        F.when(known, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.when(known, F.col("group_size")).otherwise(F.lit(1).cast("long")).alias("group_size"),
        F.when(known, F.col("keep_id") == F.col("doc_id")).otherwise(F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the copies, all columns kept; a repeated row stays once."""
    columns = docs.columns
    key, digest, row = fresh(docs, "key"), fresh(docs, "digest"), fresh(docs, "row")
    classes = staged(duplicate_classes(docs, id_column, text_column), "copies")
    text = F.coalesce(F.col(text_column), F.lit(""))
    keyed = docs.withColumn(key, F.col(id_column).cast("long")).withColumn(digest, F.sha2(text, 256))
    gone = (
        keyed.select(key, digest)
        .join(classes.select(F.col("text_sha256").alias(digest), "keep_id").hint("merge"), digest)
        .where(F.col("keep_id") != F.col(key))
        .select(key, digest)
        .distinct()
    )
    # Texts move once, by id and digest: the copies of one text are spread.  A repeated row meets itself there.
    stays = keyed.join(gone.hint("merge"), [key, digest], "left_anti")
    told_apart = stays.withColumn(row, F.when(F.col(key).isNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1)))
    return told_apart.dropDuplicates([key, digest, row]).select(columns)


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
WINDOW same AS (PARTITION BY text_sha256)
"""
