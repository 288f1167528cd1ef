"""The daily ranked report and its JSON form."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.timecols import in_logical_day, instant, iso_text, logical_date_bj
from tidewire.operators.lookup import rows_with_keys
from tidewire.operators.ranking import first_per_group, numbered, numbered_top
from tidewire.params import ReportParams
from tidewire.session import settle

WIDE_COLUMNS = ["title", "url", "body"]
CANDIDATE_COLUMNS = ["id", "event_uri", "source_name", "published_at", "final_score_v2", *WIDE_COLUMNS]
ARTICLE_FIELDS = ["rank", "score", "source", "title", "url", "publishedAt", "eventId", "body"]


def near_dates(rows: DataFrame, logical_date: date | str) -> DataFrame:
    """Only the folders of a stored table that can hold rows of the date.

    The stored date may use another cutoff; it is off by one day at most.
    """
    if "logical_date" not in rows.columns:
        return rows
    day = F.lit(str(logical_date)).cast("date")
    return rows.filter(F.col("logical_date").between(F.date_sub(day, 1), F.date_add(day, 1)))


def report_candidates(scored: DataFrame, logical_date: date | str | None, p: ReportParams) -> DataFrame:
    """Scored rows of the day (or of every day), at most ``per_event`` per event, best first.

    Rows without an event form one group, so that at most ``per_event`` of them stay per day.
    """
    rows = scored.filter(F.col("final_score_v2").isNotNull())
    if logical_date is not None:
        rows = near_dates(rows, logical_date).filter(in_logical_day(rows, "published_at", logical_date, p.cutoff_hour))
    narrow = [c for c in CANDIDATE_COLUMNS if c in rows.columns]
    rows = rows.select(logical_date_bj(F.col("published_at"), p.cutoff_hour).alias("logical_date"), *narrow)
    return first_per_group(rows, ["logical_date", "event_uri"], [F.desc("final_score_v2"), F.col("id")], p.per_event)


def daily_report(scored: DataFrame, articles: DataFrame | None = None, logical_date: date | str | None = None,
                 params: ReportParams | None = None) -> DataFrame:
    """Ranked report rows of one logical date, or of all dates if none is given.

    ``articles`` supplies title, url and body; they are joined after the cut per event, so that the
    wide columns of dropped rows never move. Leave it out if ``scored`` has them.
    """
    p = params or ReportParams()
    if articles is not None:
        scored = scored.drop(*WIDE_COLUMNS)
    picked = report_candidates(scored, logical_date, p)
    order = [F.desc("final_score_v2"), F.col("id")]
    if p.limit is not None:
        ranked = numbered_top(picked, order, p.limit, within="logical_date")
    else:
        ranked = numbered(picked, order, within="logical_date")
    if articles is not None:
        if logical_date is not None:
            articles = near_dates(articles, logical_date).filter(
                in_logical_day(articles, "published_at", logical_date, p.cutoff_hour))
        wide = [c for c in WIDE_COLUMNS if c in articles.columns]
        ranked = settle(ranked)
        ranked = ranked.join(rows_with_keys(articles.select("id", *wide), ranked, "id"), "id", "left")
    body = F.col("body") if "body" in ranked.columns else F.lit(None).cast("string")
    return ranked.select(
        "logical_date",
        "rank",
        F.round("final_score_v2", p.score_digits).alias("score"),
        F.col("source_name").alias("source"),
        "title",
        "url",
        iso_text(F.col("published_at")).alias("publishedAt"),
        F.col("event_uri").alias("eventId"),
        body.alias("body"),
        "id",
    )


def article_json(report: DataFrame) -> Column:
    return F.to_json(F.struct(*ARTICLE_FIELDS), {"ignoreNullFields": "false"})


def report_metadata(generated_at: Column | datetime | str, p: ReportParams) -> Column:
    """Head of a report document; needs the columns ``logical_date`` and ``article_count``."""
    return F.struct(
        iso_utc(instant(generated_at)).alias("reportGeneratedAt"),
        F.col("logical_date").cast("string").alias("reportForDate"),
        F.col("article_count").alias("articleCount"),
        F.lit(p.data_source).alias("dataSource"),
    )


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def report_lines(report: DataFrame, generated_at: Column | datetime | str,
                 params: ReportParams | None = None) -> DataFrame:
    """The report documents as text lines: head, one line per article, tail.

    The lines of a date in the order of ``line_no`` are one valid JSON document, whatever its size:
    no row ever holds more than one article. The counts of the heads need no title or body, so these are read once.
    """
    p = params or ReportParams()
    counts = report.groupBy("logical_date").agg(F.count("*").alias("article_count"))
    head = F.concat(F.lit('{"reportMetadata":'), F.to_json(report_metadata(generated_at, p)), F.lit(',"articles":['))
    frame = F.array(
        F.struct(F.lit(0).cast("long").alias("line_no"), head.alias("line")),
        F.struct((F.col("article_count") + 1).alias("line_no"), F.lit("]}").alias("line")))
    comma = F.when(F.col("rank") > 1, F.lit(",")).otherwise(F.lit(""))
    body = report.select("logical_date", F.col("rank").alias("line_no"),
                         F.concat(comma, article_json(report)).alias("line"))
    return counts.select("logical_date", F.inline(frame)).unionByName(body)


def report_documents(report: DataFrame, generated_at: Column | datetime | str, limit: int,
                     params: ReportParams | None = None) -> DataFrame:
    """One JSON text per date with the first ``limit`` articles, at most 1,000 of them, because a
    text is one row. ``report_lines`` writes whole reports."""
    if not 0 < limit <= 1000:
        raise ValueError("limit must be 1..1000")
    p = params or ReportParams()
    rows = report.filter(F.col("rank") <= limit).select("logical_date", F.struct(*ARTICLE_FIELDS).alias("article"))
    docs = rows.groupBy("logical_date").agg(
        F.array_sort(F.collect_list("article")).alias("articles"), F.count("*").alias("article_count"))
    document = F.struct(report_metadata(generated_at, p).alias("reportMetadata"), "articles")
    return docs.select("logical_date", "article_count",
                       F.to_json(document, {"ignoreNullFields": "false"}).alias("document"))
