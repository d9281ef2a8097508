"""The pipeline, stage by stage, and on nothing."""

from pathlib import Path

import pytest

import corpus_pipeline

SF = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF.exists(), reason="driver tables not present")


def test_stages_keep_the_columns_and_never_add_documents(spark):
    docs = first = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id for r in docs.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, str(SF)).collect(), first.schema)
        assert docs.columns == first.columns
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= before
        before = now
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(SF)).collect()
    assert {r.doc_id for r in pieces} == before
    assert len(corpus_pipeline.run(spark, str(SF)).collect()) == len(pieces)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame([], stage(spark, docs, str(SF)).schema)
        assert docs.count() == 0
