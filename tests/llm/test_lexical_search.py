"""op12: ranked search against a plain scoring of every document, and on odd rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from linkloom.llm import lexical_search as S

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    if text is None:
        return []
    return WORD.findall(text.translate(str.maketrans(S.UPPER, S.LOWER)))


def brute(docs, items, k=10):
    """The contract, document by document."""
    parsed = [(i, words(t)) for i, t, *_ in docs]
    n_docs = sum(1 for _, w in parsed if w)
    n_terms = sum(len(w) for _, w in parsed)
    df = Counter(t for _, w in parsed for t in set(w))
    out = set()
    for item, text in items:
        if item is None:
            continue
        q = set(words(text))
        scored = []
        for pos, (doc, w) in enumerate(parsed):
            if doc is None or not w:
                continue
            tf, m = Counter(w), 10 + (90 * len(w) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2.0 * n_docs + 2) / (2.0 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in q if tf[t])
            if s > 0:
                scored.append((-s, doc, pos))
        out |= {(item, r, doc, -s) for r, (s, doc, _) in enumerate(sorted(scored)[:k], 1)}
    return out


def result(df):
    return {tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()}


def corpus(n, seed=4):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["The", "the", "THE", "a", "x1", "naïve", "日本語"]
    weights = [1.0 / (i + 1) for i in range(len(vocab))]
    docs = [(i, " ".join(rng.choices(vocab, weights, k=rng.randrange(1, 40))) + rng.choice(["", ".", ", and-so", "—ok"]), "en") for i in range(n)]
    items = [(j, " ".join(rng.choices(vocab, k=rng.randrange(1, 6)))) for j in range(25)]
    return docs, items


@pytest.mark.parametrize("long_df", [1, 8, 10_000])
def test_equals_brute_force(spark, long_df):
    docs, items = corpus(300)
    got = S.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), long_df=long_df, shard_postings=400, items_per_block=4)
    assert result(got) == brute(docs, items)


def test_maxscore_equals_exhaustive_scoring():
    rng = np.random.default_rng(2)
    for _ in range(40):
        lists = []
        for _ in range(rng.integers(1, 6)):
            rows = np.unique(rng.integers(0, 3000, rng.integers(0, 800)))
            lists.append((rows, rng.integers(0, 50, len(rows)) * rng.integers(1, 40)))
        ids = {r: int(r) // 3 for r in range(3000)}  # ties of doc_id, broken by row
        total = Counter()
        for rows, c in lists:
            total.update(dict(zip(rows.tolist(), c.tolist(), strict=True)))
        expected = sorted(((-s, ids[r], r) for r, s in total.items() if s > 0))[:10]
        assert S._maxscore(lists, ids, 10) == [(r, d, -s) for s, d, r in expected]


def test_odd_rows(spark):
    docs, items = corpus(120, seed=9)
    docs += [(None, "w1 w2 w3", None), (500, None, None), (501, "", None), (502, "!!! ... ---", None), (3, "w5 w5 w5", "de"), (503, "w7 " * 5000, None)]
    items += [(None, "w1"), (90, None), (91, ""), (92, "?!"), (93, "w7"), (93, "w7"), (94, "zzz-unknown")]
    df = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS row", "'x' AS term", "2 AS tf", "3 AS score", "4 AS shard", "5 AS block")
    bench = spark.createDataFrame(items, ITEMS).selectExpr("*", "'y' AS term", "7 AS w")
    assert result(S.search(df, bench, long_df=4, shard_postings=100)) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = corpus(30)
    assert S.search(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)).count() == 0
    assert S.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], ITEMS)).count() == 0
    assert S.search(spark.createDataFrame([(1, None, None)], DOCS), spark.createDataFrame(items, ITEMS)).count() == 0
