from __future__ import annotations

import pytest

import corpus_pipeline
from boxoffice.llm.queries import QUERIES, SQL
from tests.conftest import SF
from tools.check_oracles import compare, duck


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), duck(SF), SQL[name]) is None


def test_pipeline_is_what_its_stages_decide(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        last, before = docs, docs.columns
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
        if name != "packing":
            assert docs.columns == before
            ids = {r.doc_id for r in docs.collect()}
            assert ids < {r.doc_id for r in last.collect()}
            kept.append(ids)
    packed = {p.doc_id for r in docs.collect() for p in r.pieces}
    assert packed == kept[-1]
    whole = corpus_pipeline.run(spark, SF)
    assert {p.doc_id for r in whole.select("pieces").collect() for p in r.pieces} == packed
