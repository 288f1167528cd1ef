"""Registered queries of the operators in this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.alignment import align_tokens, link_strengths
from tidewire.llm.chat import repair_conversations
from tidewire.llm.common import table
from tidewire.llm.decontamination import find_contamination
from tidewire.llm.embeddings import link_embeddings
from tidewire.llm.infilling import fill_in_middle, restored
from tidewire.llm.license_scan import license_scan
from tidewire.llm.near_duplicates import near_duplicates
from tidewire.llm.pieces import decode_pieces, encode_pieces
from tidewire.llm.quality import score_quality
from tidewire.llm.secret_scan import RULES, secret_spans, span_text
from tidewire.llm.toxicity import score_toxicity
from tidewire.llm.url_filter import judge_urls
from tidewire.llm.warc import archive_folder, read_archives, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best segmentations of each text."""
    return encode_pieces(table(spark, sf_dir, "documents"))


@query
def sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the text that decoding the best segmentation gives."""
    encoded = encode_pieces(table(spark, sf_dir, "documents"), n=1)
    return decode_pieces(encoded, F.col("nbest")[0]["ids"]).select("doc_id", F.sha2("decoded", 256).alias("text_sha256"))


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"))
    base = [r.kind for r in RULES if r.base]
    return found.select(
        "doc_id",
        *[F.expr(f"size(filter(secrets, s -> s.kind = '{kind}'))").cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(span_text(F.filter("secrets", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"),
        span_text(F.col("secrets")).alias("spans"))


@query
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = archive_folder(pages)
    return read_archives(write_archives(pages, folder), folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, every third again under a larger id, and pages without a payload: revisits by the hundred."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    again = pages.filter("page_id % 3 = 0").withColumn("page_id", F.col("page_id") + 1_000_000)
    bare = pages.filter("page_id % 50 = 0").withColumns({"page_id": F.col("page_id") + 2_000_000, "html": F.lit(None).cast("string")})
    rows = pages.unionByName(again).unionByName(bare)
    folder = archive_folder(rows)
    return read_archives(write_archives(rows, folder), folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors, turned a little, turned further, and again under another label: chains of links, and none across labels."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")

    def turned(by: float, times: int, more_label: int) -> DataFrame:
        return rows.select(
            (F.col("vec_id") + times * 1_000_000).alias("vec_id"),
            F.transform("embedding", lambda x, i: x * (1 + by * (i % 3 - 1))).alias("embedding"), (F.col("label") + more_label).alias("label"))

    return link_embeddings(turned(0.0, 0, 0).unionByName(turned(0.1, 1, 0)).unionByName(turned(0.3, 2, 0)).unionByName(turned(0.0, 3, 1000)))


@query
def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_embeddings(table(spark, sf_dir, "embeddings"))


@query
def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source, language and thousands of the id are folders; every twentieth name is LICENSE."""
    documents = table(spark, sf_dir, "documents")
    number = F.col("doc_id")
    folders = F.when(number % 40 == 0, F.concat_ws("/", "source", "lang")).otherwise(
        F.concat_ws("/", "source", "lang", F.floor(number / 1000).cast("string")))
    name = F.when(number % 20 == 0, F.concat(F.lit("LICENSE-"), number)).otherwise(F.concat(number, F.lit(".txt")))
    files = documents.select(F.concat_ws("/", folders, name).alias("path"), "text")
    return license_scan(files)


@query
def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(table(spark, sf_dir, "conversations"))


@query
def op11_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align_tokens(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return link_strengths(aligned.withColumn("groups_sha256", digest)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages"))
    return judged.select(
        "page_id", "host", "path", "rule", "verdict", F.size("strict_terms").cast("long").alias("n_strict"),
        F.size("soft_terms").cast("long").alias("n_soft"), "n_hits")
