"""A page store laid out by URL, so that fetching moves URLs and never html.

Pages are written once as a table bucketed and sorted by ``(url, salt)`` in
the warehouse; ``salt`` is a hash of the page id modulo ``SALTS``, so the
copies of one very common URL are spread over several buckets.  A fetch then
deals only the wanted URLs (each once per salt) into the store's buckets:
the store side of the join is read bucket by bucket, in place, without an
Exchange.  The misses path reads the store's ``url`` column alone.

Building the store is the one step that moves html, once, when the pages are
ingested; every fetch of a crawl reads it afterwards.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.urls import NOT_FOUND
from linkloom.session import delete_at_exit

# Salts per URL: a URL with very many pages is read by as many tasks.
SALTS = 8
# Pages and bytes of html per bucket when the number of buckets is not given.
PAGES_PER_BUCKET = 200_000
BYTES_PER_BUCKET = 64 << 20


def salt(page_id: str = "page_id", salts: int = SALTS):
    return F.pmod(F.xxhash64(F.col(page_id)), F.lit(salts)).cast("int")


def store_pages(pages: DataFrame, buckets: int | None = None, salts: int = SALTS) -> DataFrame:
    """Write ``(page_id, url, html)`` as a table bucketed and sorted by ``(url, salt)``; return the stored table.

    ``buckets`` defaults to one per ``BYTES_PER_BUCKET`` of html, or per
    ``PAGES_PER_BUCKET`` pages if these are more: one task reads one bucket, so
    its share must not grow with the table.  Pages
    are dealt by the bucket columns before the write, so each bucket is one
    sorted file.  The table lives in the warehouse, which all executors share,
    and is removed when the session's JVM ends.
    """
    spark = pages.sparkSession
    if buckets is None:
        found = pages.agg(F.count("*").alias("pages"), F.sum(F.octet_length("html")).alias("bytes")).first()
        buckets = max(1, math.ceil(found["pages"] / PAGES_PER_BUCKET), math.ceil((found["bytes"] or 0) / BYTES_PER_BUCKET))
    name = f"linkloom_pages_{uuid.uuid4().hex}"
    laid = pages.select("page_id", "url", "html", salt(salts=salts).alias("salt"))
    (
        laid.repartition(buckets, "url", "salt")
        .write.bucketBy(buckets, "url", "salt")
        .sortBy("url", "salt")
        .option("path", f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}")
        .saveAsTable(name)
    )
    stored = spark.table(name)
    for path in {file.rpartition("/")[0] for file in stored.inputFiles()}:
        delete_at_exit(spark, path)
    return stored


def fetch_stored(wanted: DataFrame, store: DataFrame, salts: int = SALTS) -> DataFrame:
    """Content for the URLs asked for from a store of :func:`store_pages`: ``(url, html, error_class)``.

    Equal to :func:`linkloom.sources.pages.fetch`: a URL without a page comes
    back once with ``error_class = 'not_found'``, a URL with several pages
    gives several rows.  ``wanted`` has one row per URL.
    """
    asked = wanted.select("url").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    hits = store.join(asked, ["url", "salt"]).select("url", "html", F.lit(None).cast("string").alias("error_class"))
    misses = wanted.select("url").join(store.select("url").distinct(), "url", "left_anti").select(
        "url", F.lit(None).cast("string").alias("html"), F.lit(NOT_FOUND).alias("error_class")
    )
    return hits.unionByName(misses)
