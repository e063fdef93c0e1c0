"""The pipeline's stages, and the registered queries' SQL."""

import os

import pytest

import corpus_pipeline
from linkwright.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_stages_keep_columns_and_lose_rows_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids and left, name
        ids = left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == ids
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == ids


def test_ten_queries():
    assert sorted(int(q[2:].split("_")[0]) for q in registry.QUERIES) == list(range(1, 11))
    assert set(registry.SQL) <= set(registry.QUERIES)
