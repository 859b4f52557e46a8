"""The queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from linkloom.llm import byte_bpe, decontaminate, exact_dedup, hard_negatives, html_text, jaccard, languages, lexical_search, licenses, pieces, repeats, suffix_tree, toxicity
from linkloom.llm.words import table


# The public byte-level BPE ranks, split by their own pattern; another place can be set in the environment.
BPE_RANKS = os.environ.get("LINKLOOM_BPE_RANKS") or public_tokenizers.path("byte_bpe_50k.tiktoken")

# The public model that texts are encoded with; another place can be set in the environment.
PIECE_MODEL = os.environ.get("LINKLOOM_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.tokenised(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"), jaccard.Measure(width=4, percent=85))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.language_id(table(spark, sf_dir, "documents"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.suffix_tree_scores(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"), licenses.shipped_digests(spark))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors (ids divisible by 100) of all ``embeddings`` with five positives and ten hard negatives each."""
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all ``documents`` for every ``benchmark`` item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every whole ``documents`` text by the public byte-level ranks, decoded again; digests of both."""
    return byte_bpe.digests(table(spark, sf_dir, "documents"), BPE_RANKS, public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_language_id": op3_language_id,
    "op4_repeats": op4_repeats,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_lm_score": op6_lm_score,
    "op7_decontamination": op7_decontamination,
    "op8_html_text": op8_html_text,
    "op9_toxicity": op9_toxicity,
    "op10_license_scan": op10_license_scan,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_lexical_search": op12_lexical_search,
    "op13_byte_bpe": op13_byte_bpe,
}

ORACLES: dict[str, str] = {
    "op5_exact_dedup": exact_dedup.ORACLE,
    "op10_license_scan": licenses.oracle(),
    "op11_hard_negatives": hard_negatives.oracle(),
    "op12_lexical_search": lexical_search.oracle(),
}
