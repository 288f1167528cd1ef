"""News tables derived from the driver tables, as FIXTURES.md defines them.

Event sizes, trending concepts and article scores are stored tables in a running pipeline. Here
they are landed once per session in the shared folder and read from there by every query.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewire.functions.timecols import briefing_file_name, report_file_name, utc_to_bj
from tidewire.operators.lookup import lookup
from tidewire.operators.scoring import score_articles
from tidewire.params import ScoringParams
from tidewire.session import settle_at, spread, use_utc

ROUTINE = ("c/3", "c/7", "t/error")
CATEGORY = ("c/5", "t/signup")
PARAMS = ScoringParams(routine_uris=ROUTINE, category_uris=CATEGORY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


_LANDED: dict[tuple[str, ...], tuple[str, StructType]] = {}


def state_of(spark: SparkSession, sf_dir: str, name: str = "events") -> str:
    """Size and time of a table's files: another state is another table, though the path is the same."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{sf_dir}/{name}.parquet")
    row = files.agg(F.sum("length").alias("size"), F.max("modificationTime").alias("at"), F.count("*").alias("n")).first()
    return f"{row['n']} {row['size']} {row['at']}"


def landed(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table that is built on first use in a session, or again if its files are gone or its input changed."""
    key = (spark.sparkContext.applicationId, sf_dir, name, state_of(spark, sf_dir))
    if key in _LANDED:
        path, schema = _LANDED[key]
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    rows = build()
    _LANDED[key] = (settle_at(rows), rows.schema)
    return spark.read.schema(rows.schema).parquet(_LANDED[key][0])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for work that is heavy per row."""
    return spread(table(spark, sf_dir, "documents"))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", F.regexp_extract("props", r"(\d+)", 1).cast("int"))


def as_of(spark: SparkSession, sf_dir: str) -> datetime:
    """Latest time of the table; one number, so that plans hold it as a literal."""
    latest = table(spark, sf_dir, "events").select(F.max(F.col("ts").cast("timestamp_ltz")))
    return latest.first()[0].astimezone(timezone.utc)


def event_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per news event: uri, language, number of articles and latest time."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count("*").alias("total_article_count"), F.max("ts").alias("event_date"),
    ).select(
        F.concat(F.lit("ev-"), F.col("user_id")).alias("uri"),
        F.when(F.col("user_id") % 4 == 0, "deu").otherwise("eng").alias("lang"),
        F.concat(F.lit("src"), F.col("user_id") % 20).alias("source_uri"),
        "total_article_count", "event_date",
    )


def plain_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles without the size of their event."""
    user, kind, k = F.col("user_id"), F.col("event_type"), F.col("k")
    strength = F.least(F.col("value") / 500, F.lit(1.0))
    return event_rows(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("ev-"), user).alias("event_uri"),
        F.col("ts").alias("published_at"),
        F.col("ts").alias("collected_at"),
        F.concat(kind, F.lit(" "), user).alias("title"),
        F.concat(F.lit("https://src"), user % 20, F.lit(".example.com/"), F.col("event_id")).alias("url"),
        F.concat(F.lit("src"), user % 20).alias("source_name"),
        F.when(user % 10 != 0, 1 + (user * 7919) % 1000000).alias("source_importance"),
        F.when(kind == "error", -strength).otherwise(strength).alias("sentiment"),
        F.transform(
            F.array(F.concat(F.lit("c/"), k), F.concat(F.lit("c/"), (k + user) % 100), F.concat(F.lit("t/"), kind)),
            lambda uri: F.struct(uri.alias("uri")),
        ).alias("concepts"),
    )


def event_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = event_objects(spark, sf_dir).select(
        F.col("uri").alias("event_uri"), F.col("total_article_count").alias("total_articles_in_event"))
    return landed(spark, sf_dir, "event_sizes", lambda: sizes)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup(plain_articles(spark, sf_dir), event_sizes(spark, sf_dir), "event_uri", spread_by="id")


def trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_rows(spark, sf_dir).filter("k % 3 = 0").groupBy("k").agg(
        F.round(F.sum("value"), 4).alias("score"), F.max("ts").alias("updated_at"))
    table_rows = rows.select(F.concat(F.lit("c/"), "k").alias("uri"), "score", "updated_at")
    return landed(spark, sf_dir, "trending", lambda: table_rows)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored ``article_scores`` table that reports and monitoring read.

    Final scores are rounded to 6 places, so that two engines rank alike.
    """
    def build() -> DataFrame:
        scored = score_articles(articles(spark, sf_dir), trending(spark, sf_dir), PARAMS, as_of(spark, sf_dir))
        return scored.withColumn("final_score_v2", F.round("final_score_v2", 6))

    return landed(spark, sf_dir, "scores", build)


def briefings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One briefing per document: 0 to 11 topics in one of the three layouts, whole text in topic 1."""
    docs = documents(spark, sf_dir)
    doc, layout = F.col("doc_id"), F.col("doc_id") % 3
    flat = F.translate("text", "\r\n", "  ")
    host = F.concat(F.col("source"), F.lit(".example.com"))
    url = F.concat(F.lit("https://www."), host, F.lit("/"), doc)

    def body(no):
        mention = F.when(doc % 5 == 0, F.lit("见选题 2。")).otherwise(F.lit(""))
        return F.when(no == 1, F.concat(F.lit("A "), flat, F.lit(" Z"))).otherwise(
            F.concat(F.lit("item "), no, F.lit(" "), mention))

    def topic(no):
        day = F.lpad((1 + no % 28).cast("string"), 2, "0")
        number, title = no.cast("string"), F.concat(F.lit("T"), no, F.lit(" "), F.col("lang"))
        subtitle = F.concat(F.lit("S"), doc % 7)
        spec = F.concat(
            F.lit("选题"), number, F.lit("\n涉及地区/热点： #"), F.col("lang"), F.lit(" #"), F.col("source"),
            F.lit("\n标题："), title, F.lit("\n副标题："), subtitle, F.lit("\n内容："), body(no),
            F.lit("\n时间：2024-01-"), day, F.lit("\n来源："), host, F.lit(" – "), url, F.lit("\n\n"))
        body_first = F.concat(
            F.lit("### 选题"), number, F.lit("\n\n"), body(no), F.lit("\n\n**标题：** "), title,
            F.lit("\n**副标题：** "), subtitle, F.lit("\n\n**思路：**\nwhy "), number,
            F.lit("\n\n**时间：** 2024年01月"), day, F.lit("日\n**来源：** "), host, F.lit(" – "), url,
            F.lit("\n\n---\n\n"))
        one_line = F.concat(
            F.lit("### 选题"), number, F.lit("\n\n**标题："), title, F.lit(" / "), subtitle,
            F.lit("**\n\n**内容：** "), body(no), F.lit("\n\n**思路：** why "), number,
            F.lit("\n\n**时间：** 2024年01月"), day, F.lit("日\n**来源：** "), host, F.lit("\n\n***\n\n"))
        return F.when(layout == 0, spec).when(layout == 1, body_first).otherwise(one_line)

    topics = F.when(doc % 12 > 0, F.transform(F.sequence(F.lit(1), (doc % 12).cast("int")), topic))
    text = F.concat(F.lit("preamble\n\n"), F.coalesce(F.array_join(topics, ""), F.lit("")))
    return docs.select(doc.alias("name"), text.alias("text"))


def file_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names and modification times: reports and briefings, one per event row."""
    ts = F.col("ts").cast("timestamp")
    day = F.date_format(utc_to_bj(ts), "yyyy-MM-dd")
    run = F.when(F.col("user_id") % 3 == 0, "manual").otherwise("scheduled")
    briefing = F.when(F.col("user_id") % 4 == 1, briefing_file_name(ts)).otherwise(
        F.concat(day, F.lit("_notes_"), F.col("event_id"), F.lit(".md")))
    name = F.when(F.col("user_id") % 2 == 0, report_file_name(day, run, ts)).otherwise(briefing)
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("/exports/"), name).alias("path"), name.alias("name"), ts.alias("modified_at"))
