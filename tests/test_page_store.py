"""The page store: fetches equal the plain fetch, and no html crosses an Exchange."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from linkloom.sources import page_store
from linkloom.sources.pages import PAGE_SCHEMA, fetch


def rows(df):
    return Counter(map(tuple, df.select("url", F.md5("html").alias("h"), "error_class").collect()))


def pages(spark):
    data = [(i, f"http://a.example/{i % 40}", f"<p>{i}</p>") for i in range(300)]
    data += [(1000 + i, "http://hot.example/", f"<p>hot {i}</p>") for i in range(500)]  # one URL with very many pages
    data += [(2000, None, "<p>no url</p>"), (2001, "http://a.example/1", None), (None, "http://a.example/2", "<p>no id</p>")]
    return spark.createDataFrame(data, PAGE_SCHEMA)


def test_equals_the_plain_fetch(spark):
    table = pages(spark)
    wanted = spark.createDataFrame([(u,) for u in ["http://a.example/1", "http://hot.example/", "http://none.example/", None, "http://a.example/39"]], "url string")
    store = page_store.store_pages(table, buckets=3)
    assert rows(page_store.fetch_stored(wanted, store)) == rows(fetch(wanted, table))


def test_empty_store_and_empty_wants(spark):
    table = pages(spark).limit(0)
    wanted = spark.createDataFrame([("http://a.example/1",)], "url string")
    store = page_store.store_pages(table)
    assert rows(page_store.fetch_stored(wanted, store)) == Counter({("http://a.example/1", None, "not_found"): 1})
    assert page_store.fetch_stored(wanted.limit(0), page_store.store_pages(pages(spark), buckets=2)).count() == 0


def test_html_never_crosses_an_exchange(spark):
    store = page_store.store_pages(pages(spark), buckets=4)
    wanted = spark.range(2000).select(F.concat(F.lit("http://a.example/"), F.col("id").cast("string")).alias("url"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = page_store.fetch_stored(wanted, store)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("html" in line for line in exchanges)
    assert "SelectedBucketsCount: 4 out of 4" in plan


def test_buckets_follow_the_bytes(spark, monkeypatch):
    """Few pages with much html take as many buckets as their bytes ask for."""
    monkeypatch.setattr(page_store, "BYTES_PER_BUCKET", 1_000, raising=False)
    table = spark.createDataFrame([(i, f"http://a.example/{i}", "x" * 500) for i in range(20)], PAGE_SCHEMA)
    store = page_store.store_pages(table)
    assert len(store.inputFiles()) > 4  # one file per bucket that is not empty
    wanted = table.select("url")
    assert rows(page_store.fetch_stored(wanted, store)) == rows(fetch(wanted, table))
