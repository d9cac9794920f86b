"""Registered queries against their SQL, and the pipeline, on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import corpus_pipeline
from hazardbook.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_a_row_for_every_document(spark, name):
    table = {"op5_url_tree": "pages", "op9_templates": None, "pipeline": None}.get(name, "documents")
    got = QUERIES[name](spark, SF_DIR).count()
    assert got == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count() if table else got > 0


def test_contaminated_documents_hold_an_item(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    held = {(d["doc_id"], i["item_id"]) for d in docs for i in items if i["text"] in d["text"]}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op9_templates"](spark, SF_DIR).collect()}
    assert held and held <= got


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns, name
