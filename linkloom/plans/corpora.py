"""Test corpora that Spark derives from the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators.ordering import with_position
from linkloom.sources.pages import read_pages

SHOP = "https://shop.example.com"
# A page row of the shop is a URL and a range of so many keys, at every scale: a
# hub is many page rows of one URL.
KEYS_PER_PAGE = 10_000
# Links of every shop page that a crawl turns away.
SHOP_EXTRA = '<a href="/logo.png">l</a><a href="https://hackers.example.org/">h</a><a href="mailto:a@example.com">m</a>'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_pages(spark, f"{sf_dir}/pages.parquet")


def _neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(kind, key, to_kind, to_key)`` in both directions."""
    ends = [
        ("region", "nation", table(spark, sf_dir, "nation").select("n_regionkey", "n_nationkey")),
        ("nation", "customer", table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey")),
        ("customer", "order", table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")),
    ]
    parts = []
    for upper, lower, pairs in ends:
        one, many = (F.col(name).cast("bigint") for name in pairs.columns)
        # Both directions of a pair come from one scan of its table.
        both = F.array(
            F.struct(F.lit(upper).alias("kind"), one.alias("key"), F.lit(lower).alias("to_kind"), many.alias("to_key")),
            F.struct(F.lit(lower).alias("kind"), many.alias("key"), F.lit(upper).alias("to_kind"), one.alias("to_key")),
        )
        parts.append(pairs.select(F.explode(both).alias("pair")).select("pair.*"))
    return reduce(DataFrame.unionByName, parts)


def shop_url(kind: Column | str, key: Column | str) -> Column:
    return F.concat_ws("/", F.lit(SHOP), kind, F.col(key).cast("string") if isinstance(key, str) else key)


def shop_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One linked page per region, nation, customer and order."""
    anchor = lambda to: F.concat(
        F.lit('<a href="/'), to["to_kind"], F.lit("/"), to["to_key"].cast("string"), F.lit('">x</a>')
    )
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        _neighbours(spark, sf_dir)
        .withColumn("part", F.floor(F.col("to_key") / KEYS_PER_PAGE))
        # A counted exchange: adaptive execution would merge these small lists into a few
        # tasks, and reading the pages they become takes far longer than their bytes tell.
        .repartition(width, "kind", "key", "part")
        .groupBy("kind", "key", "part")
        # Keys are unique, so a list has KEYS_PER_PAGE entries per kind at most.
        .agg(F.sort_array(F.collect_list(F.struct("to_kind", "to_key"))).alias("to"))
        .select(
            F.xxhash64("kind", "key", "part").alias("page_id"),
            shop_url("kind", "key").alias("url"),
            F.concat(
                F.lit("<html><body>"), F.array_join(F.transform("to", anchor), ""), F.lit(SHOP_EXTRA + "</body></html>")
            ).alias("html"),
        )
    )


def shop_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regions' pages."""
    return table(spark, sf_dir, "region").select(shop_url(F.lit("region"), "r_regionkey").alias("url"))


def hop_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``edges(src, dst)`` from each event's user to the next event's user."""
    events = with_position(table(spark, sf_dir, "events").select("ts", "event_id", "user_id"), ("ts", "event_id"))
    here = events.select("position", F.col("user_id").cast("string").alias("src"))
    there = events.select((F.col("position") - 1).alias("position"), F.col("user_id").cast("string").alias("dst"))
    return here.join(there, "position").select("src", "dst")


def part_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``edges(src, dst)`` between orders and the parts they hold, both directions."""
    pairs = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").distinct()
    order = F.concat(F.lit("o"), F.col("l_orderkey").cast("string"))
    part = F.concat(F.lit("p"), F.col("l_partkey").cast("string"))
    ends = F.array(
        F.struct(order.alias("src"), part.alias("dst")), F.struct(part.alias("src"), order.alias("dst"))
    )
    return pairs.select(F.explode(ends).alias("edge")).select("edge.*")


# Anchors added to a page whose URL contains the marker.
EXTRA_ANCHORS = (
    ("https:", '<a href="mailto:team@example.org">mail</a>'),
    ("?", '<a href="javascript:void(0)">script</a>'),
    (".html", '<a href="ftp://files.example.org/all">files</a>'),
    ("#", '<a href="//cdn.example.org/lib.zip">lib</a>'),
    ("/en/", '<a href="HTTP://hackernews.example.com/New">news</a>'),
    ("blog", '<a href="next.html">next</a>'),
    ("/fr/", '<style-guide>g</style-guide><div title="<script ">q</div><p title="<a href=\'/no\'>">'),
    ("/fr/", "<a title=it's data-href=/no href=\"/p&#0000000038;x&#x0000002F;&eacute;\">padded</a><a/href='/slash'>s</a>"),
    ("/de/", '<div title="<!-- ">c</div><script-x>n</script-x><a href="/&copy;">named</a>'),
)
UNREAD = "7"


def mixed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages with links of every outcome added, chosen by what their URLs contain.

    Every page also links to itself.  Pages whose URL ends with ``UNREAD`` have no content.
    """
    extra = [
        F.when(F.col("url").contains(marker), F.lit(anchor)).otherwise(F.lit("")) for marker, anchor in EXTRA_ANCHORS
    ]
    itself = F.concat(F.lit('<a href="'), F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit('">self</a>'))
    content = F.when(~F.col("url").endswith(UNREAD), F.concat("html", *extra, itself))
    return pages(spark, sf_dir).select("page_id", "url", content.alias("html"))
