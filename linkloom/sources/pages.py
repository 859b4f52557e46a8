"""Seed and page sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions.urls import NOT_FOUND, absolute_url, can_parse
from linkloom.operators.keys import join_side, only_keys
from linkloom.operators.policy import Forgiveness, apply_policy

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The page table ``(page_id, url, html)``; unused columns are pruned from the scan."""
    return spark.read.schema(PAGE_SCHEMA).parquet(path)


def parsed_seeds(texts: DataFrame, column: str = "url") -> DataFrame:
    """``(text, url, error_class)``: each seed text and what it reads as."""
    return texts.select(
        F.col(column).alias("text"), absolute_url(F.col(column)).alias("read")
    ).select("text", "read.url", "read.error_class")


def seeds(
    texts: DataFrame,
    column: str = "url",
    policy: str = "strict",
    forgive: Forgiveness = (),
) -> DataFrame:
    """``seeds(url)`` from texts; under ``strict`` one bad text leaves none."""
    return apply_policy(parsed_seeds(texts, column), None, policy, forgive).select("url")


def fetch(wanted: DataFrame, pages: DataFrame) -> DataFrame:
    """Content for the URLs asked for: ``(url, html, error_class)``.

    A URL without a page comes back with ``error_class = 'not_found'``.
    ``wanted`` has one row per URL; a URL with several pages gives several rows.
    Hits and misses are two joins, since only an inner join can be split on the
    page side when one URL has very many copies.
    """
    asked = wanted.select("url")
    hits = pages.select("url", "html").join(join_side(asked, "url"), "url").withColumn("error_class", F.lit(None).cast("string"))
    misses = asked.join(pages.select("url").distinct(), "url", "left_anti").select(
        "url", F.lit(None).cast("string").alias("html"), F.lit(NOT_FOUND).alias("error_class")
    )
    return hits.unionByName(misses)


def parse_gate(pages: DataFrame, batch: str) -> DataFrame:
    """All pages of the batches in which at least one URL looks like HTML.

    Of the second reading of ``pages`` only the URL and the batch are needed.
    """
    return only_keys(pages, pages.filter(can_parse(F.col("url"))), batch)
