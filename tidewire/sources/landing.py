"""Landed API responses as JSON lines, and their flat form."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.concepts import empty_to_null
from tidewire.functions.timecols import instant, logical_date_bj, parse_publish_time
from tidewire.schemas import LANDED_ARTICLE, LANDED_EVENT, LANDED_TRENDING

CORRUPT = "_corrupt_record"


def arrived_lines(lines: DataFrame) -> DataFrame:
    """Non-empty lines of text files, ``value``, with ``arrival``: file, start of its stretch, and place in the stretch."""
    arrival = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"))
    return lines.select("value", arrival.alias("arrival")).filter(F.trim("value") != "")


def parsed_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Lines as objects, one row per item of a line that is a list.

    An unreadable line has NULL fields and keeps its text in ``_corrupt_record``. Batch and stream read
    through here, so that they treat lines alike.
    """
    with_bad = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    one = F.from_json("value", with_bad, {"columnNameOfCorruptRecord": CORRUPT})
    listed = F.when(F.startswith(F.ltrim("value"), F.lit("[")), F.from_json("value", T.ArrayType(schema)))
    items = F.transform(listed, lambda item: F.struct(
        *[item[name].alias(name) for name in schema.fieldNames()], F.lit(None).cast("string").alias(CORRUPT)))
    others = [c for c in lines.columns if c != "value"]
    return lines.select(F.explode(F.coalesce(items, F.array(one))).alias("o"), *others).select("o.*", *others)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return parsed_lines(arrived_lines(spark.read.text(path)), schema)


def unreadable(landed: DataFrame, kind: str) -> DataFrame:
    """``kind, line`` of the lines that could not be read."""
    return landed.filter(F.col(CORRUPT).isNotNull()).select(F.lit(kind).alias("kind"), F.col(CORRUPT).alias("line"))


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Landed article objects in ``arrival`` order. Unreadable lines keep their text in ``_corrupt_record``."""
    return _read(spark, path, LANDED_ARTICLE)


def landed_events(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, LANDED_EVENT)


def landed_trending(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, LANDED_TRENDING)


def parse_articles(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.select(F.from_json(column, LANDED_ARTICLE).alias("o")).select("o.*")


def flatten_articles(landed: DataFrame, collected_at: Column | datetime | str, cutoff_hour: int = 6) -> DataFrame:
    """Nested articles as rows of the ``articles`` table.

    ``source_name`` holds the uri of the source. A missing or unreadable publish time becomes the
    collection time, and ``published_at_imputed`` says so. A missing event size is 0.
    """
    now = instant(collected_at)
    published = parse_publish_time(F.col("dateTimePub"))
    flat = landed.select(
        F.col("uri").alias("id"), "title", "body", "url",
        F.coalesce(published, now).alias("published_at"),
        now.alias("collected_at"),
        "sentiment",
        F.col("source.uri").alias("source_name"),
        F.col("source.ranking.importanceRank").alias("source_importance"),
        F.col("eventUri").alias("event_uri"),
        F.coalesce("totalArticleCountInEvent", F.lit(0)).alias("total_articles_in_event"),
        empty_to_null(F.col("concepts")).alias("concepts"),
        published.isNull().alias("published_at_imputed"),
        *(["arrival"] if "arrival" in landed.columns else []),
    )
    return flat.withColumn("logical_date", logical_date_bj(F.col("published_at"), cutoff_hour))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Landed event objects with the columns that the selection needs."""
    landed = landed_events(spark, path).filter(F.col(CORRUPT).isNull())
    return landed.select(
        "uri", "lang", F.col("totalArticleCount").alias("total_article_count"),
        parse_publish_time(F.col("eventDate")).alias("event_date"),
        F.col("sourceUris").alias("source_uris"), "concepts", "title", "categories", "sentiment", "wgt",
    )


def trending_items(landed: DataFrame) -> DataFrame:
    """One row per trending concept.

    A response is a bare list (one object per row), or an object that holds the list under
    ``trendingConcepts`` or, if that is empty, under ``results``.
    """
    lists = F.coalesce(F.when(F.size("trendingConcepts") > 0, F.col("trendingConcepts")), F.col("results"))
    bare = F.array(F.struct(F.col("uri"), F.col("type"), F.col("trendingScore")))
    items = landed.select(F.explode(F.coalesce(lists, F.when(F.col("uri").isNotNull(), bare))).alias("item"))
    return items.select("item.uri", "item.type", F.col("item.trendingScore.news.score").alias("score"))


def read_trending(spark: SparkSession, path: str, updated_at: Column | datetime | str) -> DataFrame:
    """Landed trending concepts; a response without any is an error."""
    items = trending_items(landed_trending(spark, path))
    if items.isEmpty():
        raise ValueError(f"no trending concepts in {path}")
    return items.withColumn("updated_at", instant(updated_at))
