"""From raw documents to token ids: the stages of a training corpus, one table each.

All stages read ``doc_id`` and ``text`` (the first also ``lang``, ``source`` and ``n_chars``) and pass every column on
under its own name, whatever it is called. An empty table gives an empty one. Repeated ids, and null ids, are rows like
others unless a stage says more; texts are read whole, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import small_batches, table
from tidewire.llm.decontamination import find_contamination
from tidewire.llm.near_duplicates import distinct_documents
from tidewire.llm.pieces import encode_pieces
from tidewire.llm.quality import score_quality
from tidewire.llm.secret_scan import redact_secrets
from tidewire.session import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Null and empty texts and null metadata are scored like others, a null text as an empty one, and go or stay by their
    score. Rows that are alike get the same score. Without labels of both classes all scores are the share of label 1.
    """
    small_batches(spark)
    scored = score_quality(docs, table(spark, sf_dir, "labels"), keep=docs.columns)
    return scored.filter("accepted = 1").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that with the smallest id, a null id last.

    Rows with null texts all stay. Empty texts are one class, and so are texts without words that are equal. Of rows that
    repeat id and text of the one that stays, one stays.
    """
    small_batches(spark)
    return distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark.

    Null and empty texts have no words and stay. Repeated rows stay or go together. An empty benchmark takes nothing.
    """
    small_batches(spark)
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), keep=docs.columns)
    return found.filter("not contaminated").select("row.*")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts. Null texts stay null, empty ones empty."""
    return redact_secrets(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as the ids of their best segmentation: ``doc_id, n_tokens, score, ids``.

    The best of the n segmentations that the operator finds. A null text has nulls, an empty one no ids and the score 0.
    """
    small_batches(spark)
    best = encode_pieces(docs).withColumn("best", F.col("nbest")[0])
    return best.select("doc_id", "n_tokens", F.col("best.score").alias("score"), F.col("best.ids").alias("ids"))


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("secrets", secrets), ("pieces", pieces)]

# Training a classifier and segmenting with an external vocabulary are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written as Parquet and read back for the next one."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
