"""The registered training-data queries: those with SQL against DuckDB, the pipeline stage by stage."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from linkloom.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    result = QUERIES[name](spark, FOLDER)
    columns = sorted(result.columns)
    duck = duckdb.connect()
    for view in ("documents", "embeddings", "benchmark"):
        duck.sql(f"CREATE VIEW {view} AS SELECT * FROM '{FOLDER}/{view}.parquet'")
    expected = duck.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    assert Counter(map(tuple, result.select(*columns).collect())) == Counter(expected.project(", ".join(columns)).fetchall())


def test_pipeline_keeps_what_its_stages_keep(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, FOLDER).checkpoint() if spark.sparkContext.getCheckpointDir() else stage(spark, docs, FOLDER)
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and 0 < sizes[-1] < sizes[0]
    result = corpus_pipeline.run(spark, FOLDER)
    assert sorted(r["doc_id"] for r in result.collect()) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    assert result.where("NOT round_trip").count() == 0
    texts = [r["text"] for r in docs.select("text").collect()]
    assert len(texts) == len(set(texts))
