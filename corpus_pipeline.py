"""A training-corpus pipeline: toxic texts, copies, near copies and leaked benchmark passages go, the rest is encoded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm import pieces
from linkloom.llm.decontaminate import drop_contaminated
from linkloom.llm.exact_dedup import drop_copies
from linkloom.llm.jaccard import drop_near_copies
from linkloom.llm.queries import PIECE_MODEL
from linkloom.llm.toxicity import drop_toxic
from linkloom.llm.words import staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by the similarity of their five-word shingles that with the smallest id."""
    return drop_near_copies(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, piece_ids, n_pieces, round_trip`` of every document."""
    return pieces.tokenised(docs, PIECE_MODEL)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("SentencePiece encoding and decoding", encoding),
]

# The stages rest on a trained model and on searches that SQL does not express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; what one returns is stored in the shared folder for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
