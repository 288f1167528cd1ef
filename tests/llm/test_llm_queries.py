"""Queries of the package against their SQL, and their contracts where SQL cannot say them."""

import hashlib

import pytest
from oracle_check import connect, differences

import __spark_entry__ as contract
import corpus_pipeline
from tidewire.llm.oracle import ORACLE
from tidewire.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, duck, name):
    assert differences(spark, duck, SF, QUERIES[name], ORACLE[name]) is None


def test_every_operator_is_registered():
    names = contract.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1


def test_pipeline_against_its_stages(spark, duck):
    """Each stage keeps what its operator says about the rows before it; the last decodes to the redacted texts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        rows = after.collect()
        assert after.columns == docs.columns
        ids.append(len(rows))
        docs = spark.createDataFrame(rows, docs.schema)
    assert ids == sorted(ids, reverse=True) and ids[3] == ids[4]
    texts = {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in docs.collect()}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    from pyspark.sql import functions as F

    from tidewire.llm.pieces import decode_pieces
    decoded = decode_pieces(last, F.col("ids")).collect()
    assert {r["doc_id"]: hashlib.sha256(r["decoded"].encode()).hexdigest() for r in decoded} == texts


def test_pipeline_run(spark):
    rows = contract.queries()["pipeline"](spark, SF)
    assert rows.columns == ["doc_id", "n_tokens", "score", "ids"]
    assert rows.filter("n_tokens <> size(ids)").count() == 0 and rows.count() > 100
