"""Ranked lexical search of benchmark items over all documents: hybrid TAAT-DAAT.

Documents become bags of terms in one pass of Arrow batches, without a
shuffle; ``N`` and ``L`` are aggregates over all of them, and the postings
``(row, doc_id, term, tf)`` of the terms that some item asks for, with their
``df``, are drawn from them.  For each item, the
posting lists of its terms are split by length:

* short lists (``df <= LONG_DF``) are read term-at-a-time: a join of the item's
  short terms with their postings, summed per document, materialises the
  item's accumulators;
* long lists are read document-at-a-time.  Documents are dealt into shards by
  row; in each shard one pandas task walks, per item, the long lists together
  with the accumulators, which act as one more sorted iterator whose upper
  bound is its largest value.  The walk skips in the manner of MaxScore: lists
  whose upper bounds together stay below the current tenth score are never
  iterated, only probed by binary search for the candidates that the others
  yield, and only while a candidate can still reach that score.

Each shard returns at most ``k`` documents per item; a window function merges
them.  A hot term is never joined to all its documents per item, and no item
or term meets in one task.

Defined results: a null or empty text has no terms (and counts in neither
``N`` nor ``L``); each row of ``documents`` is a document of its own, so a
repeated id may appear twice; rows with a null ``doc_id`` count in the
statistics but are never returned; items with a null id or without terms
return nothing, and rows repeating an item id search for their terms together; only scores above 0 are returned; equal scores go by ascending
``doc_id``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.session import stage_table

# Fixed values of the contract: what a term is, and the constants of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
K1000, B_LOW, B_SPAN, TF_SCALE, M_SCALE = 1000, 10, 90, 1_000_000_000, 8

# Lists longer than this are read document-at-a-time; shorter ones term-at-a-time.
LONG_DF = 1024
# Long postings one shard (and so one task) holds.
SHARD_POSTINGS = 200_000
# Documents one Arrow slice carries into and out of a worker.
ROWS = 512
# Items one task walks.
ITEMS_PER_BLOCK = 1024
# Candidates a document-at-a-time step scores at once.
STEP = 2048

RESULT = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("score", T.LongType()),
    ]
)
_FOUND = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("row", T.LongType()),
        T.StructField("score", T.LongType()),
    ]
)


def terms(text: Column) -> Column:
    """The terms of a text: A-Z lower-cased, maximal runs of letters, digits and non-ASCII; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), 0)


_WORD = re.compile(TERM)
_LOWER = str.maketrans(UPPER, LOWER)
_BAGS = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.StringType())),
        T.StructField("tfs", T.ArrayType(T.LongType())),
    ]
)


def _bags(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its number of terms and its distinct terms with their counts, ``ROWS`` documents at a time."""
    schema = pa.schema([(f.name, t) for f, t in zip(_BAGS.fields, (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())), strict=True)])
    for whole in frames:
        for low in range(0, whole.num_rows, ROWS):
            frame = whole.slice(low, ROWS)
            n, terms, tfs = [], [], []
            for text in frame.column("text").to_pylist():
                found = _WORD.findall(text.translate(_LOWER)) if text else []
                bag = Counter(found)
                n.append(len(found))
                terms.append(list(bag))
                tfs.append(list(bag.values()))
            yield pa.RecordBatch.from_arrays(
                [frame.column("row"), frame.column("doc_id"), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.string())), pa.array(tfs, pa.list_(pa.int64()))],
                schema=schema,
            )


def bags(documents: DataFrame) -> DataFrame:
    """Stored ``row, doc_id, n, terms, tfs``: one row per document, read in one pass without a shuffle."""
    docs = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage_table(docs.mapInArrow(_bags, _BAGS), "term-bags")


def postings(bagged: DataFrame, wanted: DataFrame) -> DataFrame:
    """``row, doc_id, term, tf, n`` of the documents' terms that are among ``wanted``'s."""
    each = bagged.select("row", "doc_id", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("p")).select(
        "row", "doc_id", F.col("p.terms").alias("term"), F.col("p.tfs").alias("tf"), "n"
    )
    return each.join(wanted.select("term").distinct(), "term", "left_semi")


def item_terms(benchmark: DataFrame) -> DataFrame:
    """``item_id, term``: the distinct terms of each item with an id; rows repeating an id join their terms."""
    return benchmark.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), F.explode(F.array_distinct(terms(F.col("text")))).alias("term")
    ).distinct()


def _maxscore(lists: list[tuple[np.ndarray, np.ndarray]], ids: dict, k: int) -> list[tuple[int, int, int]]:
    """Top ``k`` ``(row, doc_id, score)`` over sorted iterators ``(rows, contributions)``, by MaxScore skipping."""
    lists = [(r, c) for r, c in lists if len(r) and c.max() > 0]
    if not lists:
        return []
    lists.sort(key=lambda rc: int(rc[1].max()))
    bounds = np.array([int(c.max()) for _, c in lists], np.int64)
    prefix = np.cumsum(bounds)
    cursors = [0] * len(lists)
    best = np.zeros((0, 3), np.int64)  # row, doc_id, score
    theta = 1  # a document is returned only with a score above 0
    while True:
        first = int(np.searchsorted(prefix, theta, side="left"))  # lists before it cannot reach theta together
        if first == len(lists):
            break
        ahead = [lists[i][0][cursors[i] : cursors[i] + STEP] for i in range(first, len(lists))]
        ahead = [a for a in ahead if len(a)]
        if not ahead:
            break
        end = min(int(a[-1]) for a in ahead)  # every essential list is read up to the same row
        cand = np.unique(np.concatenate([a[a <= end] for a in ahead]))
        for i in range(first, len(lists)):
            cursors[i] = int(np.searchsorted(lists[i][0], end, side="right"))
        score = np.zeros(len(cand), np.int64)
        for i in range(len(lists) - 1, first - 1, -1):
            score += _probe(lists[i], cand)
        for i in range(first - 1, -1, -1):  # non-essential lists: probed only where the rest can still reach theta
            alive = score + prefix[i] >= theta
            if not alive.any():
                break
            score[alive] += _probe(lists[i], cand[alive])
        keep = score >= theta
        docs = np.array([ids[r] for r in cand[keep].tolist()], np.int64)
        best = np.concatenate([best, np.column_stack([cand[keep], docs, score[keep]])])
        best = best[np.lexsort((best[:, 0], best[:, 1], -best[:, 2]))][:k]
        if len(best) == k:
            theta = max(theta, int(best[-1, 2]))
    return [tuple(map(int, r)) for r in best]


def _probe(lst: tuple[np.ndarray, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Contributions of one sorted iterator at ``rows`` (0 where it has none), by binary search."""
    at = np.searchsorted(lst[0], rows)
    inside = at < len(lst[0])
    hit = np.zeros(len(rows), bool)
    hit[inside] = lst[0][at[inside]] == rows[inside]
    return np.where(hit, lst[1][np.minimum(at, len(lst[0]) - 1)], 0)


def _walk(k: int):
    def task(long: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, int]] = []
        if asks.empty:
            return pd.DataFrame(out, columns=[f.name for f in _FOUND])
        lists: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        ids: dict[int, int] = {}
        if not long.empty:
            long = long.sort_values("row", kind="stable")
            ids.update(zip(long["row"].tolist(), long["doc_id"].tolist(), strict=True))
            for term, part in long.groupby("term", sort=False):
                lists[term] = (part["row"].to_numpy(np.int64), part["ts"].to_numpy(np.int64))
        weights = asks[asks["term"].notna()]
        accs = asks[asks["term"].isna()].sort_values("row", kind="stable")
        ids.update(zip(accs["row"].tolist(), accs["doc_id"].tolist(), strict=True))
        by_item = {i: part for i, part in accs.groupby("item_id", sort=False)}
        for item in asks["item_id"].unique().tolist():
            its = []
            for term, w in weights.loc[weights["item_id"] == item, ["term", "w"]].itertuples(index=False):
                if term in lists:
                    rows, ts = lists[term]
                    its.append((rows, ts * int(w)))
            if item in by_item:
                acc = by_item[item]
                its.append((acc["row"].to_numpy(np.int64), acc["acc"].to_numpy(np.int64)))
            out += [(item, doc, row, score) for row, doc, score in _maxscore(its, ids, k)]
        return pd.DataFrame(out, columns=[f.name for f in _FOUND])

    return task


def search(
    documents: DataFrame,
    benchmark: DataFrame,
    k: int = 10,
    long_df: int = LONG_DF,
    shard_postings: int = SHARD_POSTINGS,
    items_per_block: int = ITEMS_PER_BLOCK,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0.

    ``long_df``, ``shard_postings`` and ``items_per_block`` shape the work,
    never the result.  Odd input is described in the module docstring.
    """
    spark = documents.sparkSession
    bagged = bags(documents)
    stats = bagged.agg(F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.sum("n").alias("L")).first()
    n_docs, n_terms = int(stats["N"] or 0), int(stats["L"] or 0)
    asked = item_terms(benchmark)
    if not n_docs:
        return spark.createDataFrame([], RESULT)
    posts = stage_table(postings(bagged, asked), "postings")
    df = posts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * n_docs + 2)) / (F.lit(2.0) * F.col("df") + F.lit(1.0)))).cast("long")
    weighted = asked.join(df, "term").select("item_id", "term", "df", weight.alias("w")).where(F.col("w") > 0)
    weighted = stage_table(weighted, "item-terms")
    ts = F.expr(f"({TF_SCALE} * tf) div ({K1000} * tf + {M_SCALE} * ({B_LOW} + ({B_SPAN} * n * {n_docs}) div {n_terms}))").alias("ts")
    scored = posts.where(F.col("doc_id").isNotNull()).select("row", "doc_id", "term", ts)

    # term-at-a-time over short lists: accumulators per item and document
    short = weighted.where(F.col("df") <= long_df).select("item_id", "term", "w")
    accs = (
        short.join(scored, "term")
        .groupBy("item_id", "row", "doc_id")
        .agg(F.sum(F.col("w") * F.col("ts")).alias("acc"))
    )
    # document-at-a-time over long lists, shard by shard
    long_terms = weighted.where(F.col("df") > long_df).select("item_id", "term", "w")
    long_posts = scored.join(long_terms.select("term").distinct(), "term", "left_semi")
    n_long = long_posts.count()
    n_items = asked.select("item_id").distinct().count()
    shards = max(1, math.ceil(n_long / shard_postings))
    blocks = max(1, math.ceil(n_items / items_per_block))
    shard = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard")
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("block")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = long_posts.select("row", "doc_id", "term", "ts", shard, every(blocks).alias("block"))
    asks = long_terms.select(
        "item_id", "term", "w", F.lit(None).cast("long").alias("row"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("acc"),
        every(shards).alias("shard"), block,
    ).unionByName(
        accs.select("item_id", F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("w"), "row", "doc_id", "acc", shard, block)
    )
    found = left.groupBy("shard", "block").cogroup(asks.groupBy("shard", "block")).applyInPandas(_walk(k), _FOUND)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id", "row")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
    )


def oracle(k: int = 10) -> str:
    """The same ranking in DuckDB SQL: every item's terms joined with all their postings."""
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lower}, '{TERM}') AS terms FROM documents
),
st AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS nd, coalesce(sum(len(terms)), 0) AS nt FROM d),
p AS (
  SELECT r, any_value(doc_id) AS doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY r, term
),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({lower}, '{TERM}')) AS term FROM benchmark WHERE item_id IS NOT NULL
),
s AS (
  SELECT q.item_id, p.r, p.doc_id,
         sum(CAST(floor(1000 * ln((2.0 * st.nd + 2) / (2.0 * f.df + 1))) AS BIGINT)
             * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * p.n * st.nd) // st.nt)))) AS score
  FROM q JOIN p ON p.term = q.term JOIN f ON f.term = q.term CROSS JOIN st
  WHERE p.doc_id IS NOT NULL
  GROUP BY q.item_id, p.r, p.doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS rank
  FROM s WHERE score > 0
) WHERE rank <= {k}
"""
