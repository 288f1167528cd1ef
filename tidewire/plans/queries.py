"""The registered queries: each runs one operator over whole driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire import params, schemas
from tidewire.functions import scores as S
from tidewire.functions import text as X
from tidewire.functions import timecols as TC
from tidewire.functions.concepts import concept_uris, mentions_any, uri_set
from tidewire.operators import cards, daily_state, dedup, keys, keywords, monitor, ranking, report, scoring, select, tables
from tidewire.operators.ledger import SCORING, Ledger
from tidewire.operators.lookup import lookup
from tidewire.params import ReportParams, SelectionParams
from tidewire.plans import daily
from tidewire.plans import driver_views as V
from tidewire.session import settle, shared_dir
from tidewire.sources import files, landing, sinks
from tidewire.streaming import incremental

DAY = "2024-01-10"
GENERATED_AT = "2024-02-01T00:00:00+00:00"
EARLIER = "published_at < timestamp_ntz'2024-01-15 00:00:00'"
CONFLICT = ("token", "cookie", "License")
BANG = ("secret", "MIT")
INSIDER = ("password",)
RECENT = SelectionParams(min_articles=3, lookback_hours=24, breaking_hours=6)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def r6(value: Column | str, name: str) -> Column:
    return F.round(value, 6).alias(name)


def stamp(value: str, name: str | None = None) -> Column:
    return F.date_format(F.col(value).cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name or value)


def day_text(value: str) -> Column:
    return F.col(value).cast("string").alias(value)


# Scoring

@query
def score_articles(spark, sf):
    scored = scoring.score_articles(V.articles(spark, sf), V.trending(spark, sf), V.PARAMS, V.as_of(spark, sf))
    return scored.select("id", *[r6(c, c) for c in scoring.SCORE_COLUMNS], *scoring.FLAG_COLUMNS)


@query
def entity_hot_score(spark, sf):
    rows = V.plain_articles(spark, sf)
    hot = scoring.with_entity_hot(rows, V.trending(spark, sf).select("uri", "score"), ["id"], concept_uris(rows))
    return hot.select("id", r6("entity_hot_score", "entity_hot_score"))


@query
def hot_score(spark, sf):
    return V.scores(spark, sf).select("id", "total_articles_in_event", r6("hot_score_v2", "hot_score_v2"))


@query
def authority_score(spark, sf):
    return V.plain_articles(spark, sf).select("id", r6(S.authority_score(F.col("source_importance"), V.PARAMS), "rep_norm"))


@query
def sentiment_score(spark, sf):
    return V.plain_articles(spark, sf).select("id", r6(S.sentiment_score(F.col("sentiment"), V.PARAMS), "sent_score_v2"))


@query
def freshness_score(spark, sf):
    now = TC.instant(V.as_of(spark, sf))
    return V.plain_articles(spark, sf).select("id", r6(S.freshness_score(F.col("published_at"), now, V.PARAMS), "freshness_score"))


@query
def minmax_normalize(spark, sf):
    raw = scoring.raw_scores(V.articles(spark, sf), V.trending(spark, sf).select("uri", "score"), V.PARAMS)
    return scoring.normalised(raw).select(
        "id", r6("hot_norm_raw", "hot_norm_raw"), r6("sent_norm", "sent_norm"), r6("concept_hot_norm", "concept_hot_norm"))


@query
def minmax_constant_batch(spark, sf):
    """All rows of one event alike: a batch without spread gets 0.5 on every norm."""
    same = V.articles(spark, sf).withColumns({
        "total_articles_in_event": F.lit(5), "sentiment": F.lit(-0.5), "concepts": F.array(F.struct(F.lit("x").alias("uri")))})
    raw = scoring.raw_scores(same, V.trending(spark, sf).select("uri", "score"), V.PARAMS)
    return scoring.normalised(raw).select("id", "hot_norm_raw", "sent_norm", "concept_hot_norm")


@query
def topic_flags(spark, sf):
    rows = V.plain_articles(spark, sf)
    uris = concept_uris(rows)
    return rows.select("id", mentions_any(uris, V.ROUTINE).alias("is_routine_topic"),
                       mentions_any(uris, V.CATEGORY).alias("is_category_topic"))


@query
def topic_damping(spark, sf):
    return V.scores(spark, sf).select("id", "is_suppressed", "is_downweighted", r6("hot_norm_raw", "hot_norm_raw"),
                                      r6("hot_norm", "hot_norm"))


@query
def unscorable_rows(spark, sf):
    """Rows without a publish time cannot be scored and go to the rejects."""
    rows = V.articles(spark, sf).withColumn(
        "published_at", F.when(F.col("source_importance").isNotNull(), F.col("published_at")))
    scored = scoring.score_articles(rows, V.trending(spark, sf), V.PARAMS, V.as_of(spark, sf))
    return scoring.split_unscorable(scored)[1].select("id", "event_uri")


@query
def legacy_score(spark, sf):
    """The earlier formula: hot from activity, similarity from the vectors in turn."""
    topic = topic_vector(spark, sf)
    sims = V.table(spark, sf, "embeddings").select("vec_id", S.cosine(F.col("embedding"), topic).alias("similarity"))
    events = V.table(spark, sf, "events")
    n = sims.count()
    rows = lookup(events.withColumn("vec_id", F.col("event_id") % n), sims, "vec_id", spread_by="event_id", how="inner")
    score = S.legacy_score(F.col("value") / 500, F.col("similarity"), F.col("ts"), TC.instant(V.as_of(spark, sf)))
    return cards.above(rows.withColumn("score", score), 0.2).select("event_id", r6("score", "score"))


def topic_vector(spark, sf) -> Column:
    """Mean of the vectors with label 0, as a literal of as many numbers as a vector has."""
    vectors = V.table(spark, sf, "embeddings").filter("label = 0")
    size = vectors.agg(F.max(F.size("embedding"))).first()[0]
    means = vectors.agg(*[F.avg(F.get("embedding", F.lit(i)).cast("double")).alias(f"d{i}") for i in range(size)]).first()
    return F.array(*[F.lit(m) for m in means])


@query
def topic_vector_similarity(spark, sf):
    topic = topic_vector(spark, sf)
    return V.table(spark, sf, "embeddings").select("vec_id", r6(S.cosine(F.col("embedding"), topic), "similarity"))


# Reports

def _report_columns(rows: DataFrame) -> DataFrame:
    return rows.select(day_text("logical_date"), "rank", "score", "source", "title", "url", "publishedAt", "eventId", "id")


@query
def daily_report(spark, sf):
    return _report_columns(report.daily_report(V.scores(spark, sf), V.articles(spark, sf), DAY))


@query
def daily_report_all_days(spark, sf):
    return _report_columns(report.daily_report(V.scores(spark, sf), V.articles(spark, sf)))


@query
def daily_report_top_k(spark, sf):
    return _report_columns(report.daily_report(V.scores(spark, sf), V.articles(spark, sf), None, ReportParams(limit=100)))


@query
def report_order(spark, sf):
    """Dense positions over all scored rows, best first."""
    order = [F.desc("final_score_v2"), F.col("id")]
    return ranking.numbered(V.scores(spark, sf).select("id", "final_score_v2"), order)


def with_bodies(rows: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """Report rows with the text of a document in turn as their body: only narrow rows and each document once move."""
    docs = V.table(spark, sf, "documents").select(F.col("doc_id").alias("no"), F.col("text").alias("body"))
    n = docs.count()
    return rows.drop("body").withColumn("no", F.col("id").cast("long") % n).join(docs, "no", "left").drop("no")


def bodied_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Articles with the text of a document in turn as their body."""
    return with_bodies(V.articles(spark, sf), spark, sf)


ARTICLE_JSON = "rank long, score double, source string, title string, url string, publishedAt string, eventId string, body string"
HEAD_JSON = ("reportMetadata struct<reportGeneratedAt: string, reportForDate: string, articleCount: long, dataSource: string>, "
             "articles array<string>")


@query
def report_json(spark, sf):
    """Whole report documents of all dates, bodies included, read back from their JSON lines."""
    rows = with_bodies(settle(report.daily_report(V.scores(spark, sf), V.articles(spark, sf))), spark, sf)
    lines = settle(report.report_lines(rows, GENERATED_AT))
    heads = lines.filter("line_no = 0").select(
        "logical_date", F.from_json(F.concat("line", F.lit("]}")), HEAD_JSON)["reportMetadata"].alias("h")).select("logical_date", "h.*")
    items = lines.filter(F.contains("line", F.lit('"eventId"'))).select(
        "logical_date", F.from_json(F.regexp_replace("line", "^,", ""), ARTICLE_JSON).alias("a")).select(
            "logical_date", "a.*", F.md5("a.body").alias("body_md5")).drop("body")
    # One head per date: looked up, so that no article moves for it.
    return lookup(items, settle(heads), "logical_date", "rank", "inner").select(
        "reportGeneratedAt", "reportForDate", "articleCount", "rank", "score", "source", "title", "url", "publishedAt", "eventId", "body_md5")


@query
def report_json_top_k(spark, sf):
    """Report documents of the top 100 per date as single JSON texts, read back."""
    rows = report.daily_report(V.scores(spark, sf), V.articles(spark, sf), None, ReportParams(limit=100))
    docs = report.report_documents(rows, GENERATED_AT, 100)
    parsed = docs.select(F.from_json("document", HEAD_JSON.replace("array<string>", f"array<struct<{ARTICLE_JSON}>>")).alias("d")).select(
        F.col("d.reportMetadata.*"), F.explode("d.articles").alias("a"))
    return parsed.select("reportGeneratedAt", "reportForDate", "articleCount", "a.rank", "a.score", "a.source", "a.title", "a.url",
                         "a.publishedAt", "a.eventId")


@query
def report_line_count(spark, sf):
    """The line form of whole reports: lines, articles and commas per date."""
    rows = settle(report.daily_report(V.scores(spark, sf), V.articles(spark, sf)))
    lines = report.report_lines(rows, GENERATED_AT)
    return lines.groupBy(day_text("logical_date")).agg(
        F.count("*").alias("n_lines"), F.max("line_no").alias("last_line"),
        F.count_if(F.startswith("line", F.lit(","))).alias("n_commas"),
        F.count_if(F.contains("line", F.lit('"eventId"'))).alias("n_articles"))


@query
def report_article_count(spark, sf):
    return report.report_candidates(V.scores(spark, sf), None, ReportParams()).groupBy(
        day_text("logical_date")).agg(F.count("*").alias("article_count"))


# Time

@query
def logical_date_counts(spark, sf):
    rows = V.table(spark, sf, "events").withColumn("logical_date", TC.logical_date_bj(F.col("ts")))
    return rows.groupBy(day_text("logical_date")).agg(F.count("*").alias("n"))


@query
def prev_logical_date(spark, sf):
    return V.table(spark, sf, "events").select(
        "event_id", TC.prev_logical_date_str(F.col("ts")).alias("prev_date"),
        F.date_format(TC.utc_to_bj(F.col("ts")), "yyyy-MM-dd HH:mm:ss").alias("bj_time"))


@query
def logical_day_rows(spark, sf):
    rows = V.plain_articles(spark, sf)
    return rows.filter(TC.in_logical_day(rows, "published_at", DAY, 8)).select("id", stamp("published_at"))


@query
def parsed_publish_times(spark, sf):
    landed = landed_articles(spark, sf)
    flat = landing.flatten_articles(landed, GENERATED_AT)
    return flat.select("id", stamp("published_at"), "published_at_imputed")


# Ingest

def article_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Article objects as JSON text, with publish times in seven spellings."""
    rows = V.plain_articles(spark, sf)
    ts, form = F.col("published_at").cast("timestamp"), F.col("id").cast("long") % 7
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    shifted = lambda hours: F.date_format(ts + F.make_dt_interval(hours=F.lit(hours)), iso)
    spelled = (
        F.when(form == 0, F.concat(F.date_format(ts, iso), F.lit("Z")))
        .when(form == 1, F.concat(shifted(8), F.lit("+08:00")))
        .when(form == 2, F.concat(shifted(-5), F.lit("-05:00")))
        .when(form == 3, F.date_format(ts, iso))
        .when(form == 4, F.date_format(ts, "yyyy-MM-dd"))
        .when(form == 5, F.lit(""))
        .otherwise(F.lit("garbage"))
    )
    ranked = F.when(F.col("source_importance").isNotNull(), F.struct(F.col("source_importance").alias("importanceRank")))
    body = F.struct(
        F.col("id").alias("uri"), "title", "url", spelled.alias("dateTimePub"), "sentiment",
        F.struct(F.col("source_name").alias("uri"), ranked.alias("ranking")).alias("source"),
        F.col("event_uri").alias("eventUri"),
        F.when(form != 6, F.col("concepts")).otherwise(F.slice("concepts", 1, 0)).alias("concepts"))
    return rows.select(F.to_json(body).alias("value"))


def landed_articles(spark: SparkSession, sf: str) -> DataFrame:
    return landing.parse_articles(article_lines(spark, sf))


@query
def flatten_articles(spark, sf):
    flat = landing.flatten_articles(landed_articles(spark, sf), GENERATED_AT)
    return flat.select(
        "id", "title", "url", r6("sentiment", "sentiment"), "source_name",
        F.coalesce("source_importance", F.lit(-1)).cast("long").alias("source_importance"), "event_uri",
        F.col("total_articles_in_event").cast("long").alias("total_articles_in_event"),
        F.coalesce(F.array_join("concepts.uri", ","), F.lit("none")).alias("uris"))


@query
def concept_uri_sets(spark, sf):
    """Uris out of stored JSON, clean and dirty."""
    k, kind = F.concat(F.lit('{"uri":"c/'), F.col("k"), F.lit('"}')), F.concat(F.lit('{"uri":"t/'), F.col("event_type"), F.lit('"}'))
    form = F.col("event_id") % 7
    listed = lambda *parts: F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))
    text = (
        F.when(form == 0, listed(k, kind)).when(form == 1, k).when(form == 2, listed(F.lit('"x"'), k))
        .when(form == 3, listed(F.lit('{"label":"none"}'), kind)).when(form == 4, F.lit("bad["))
        .when(form == 5, listed(k, k)).otherwise(F.lit(None).cast("string")))
    rows = V.event_rows(spark, sf).select("event_id", text.alias("concepts"))
    return rows.select("event_id", F.array_join(F.array_sort(uri_set(concept_uris(rows))), ",").alias("uris"))


@query
def trending_items(spark, sf):
    """Trending responses in three shapes, one per event: bare object, either list key."""
    row = V.event_rows(spark, sf)
    item = F.concat(F.lit('{"uri":"c/'), F.col("k"), F.lit('","type":"org","trendingScore":{"news":{"score":'),
                    F.col("event_id"), F.lit("}}}"))
    form = F.col("event_id") % 3
    text = (F.when(form == 0, item).when(form == 1, F.concat(F.lit('{"trendingConcepts":['), item, F.lit(']}')))
            .otherwise(F.concat(F.lit('{"trendingConcepts":[],"results":['), item, F.lit(","), item, F.lit("]}"))))
    parsed = row.select(F.from_json(text, schemas.LANDED_TRENDING).alias("o")).select("o.*")
    return landing.trending_items(parsed).groupBy("uri", "type").agg(
        F.count("*").alias("n"), F.max("score").alias("max_score"))


@query
def select_popular_events(spark, sf):
    rows = select.popular_events(V.event_objects(spark, sf), RECENT, V.as_of(spark, sf))
    return rows.select("uri", "total_article_count", stamp("event_date"))


@query
def select_breaking_events(spark, sf):
    rows = select.breaking_events(V.event_objects(spark, sf), RECENT, V.as_of(spark, sf))
    return rows.select("uri", "total_article_count", stamp("event_date"))


@query
def merge_event_paths(spark, sf):
    return select.select_events(V.event_objects(spark, sf), RECENT, V.as_of(spark, sf)).select("uri", "path")


@query
def merge_counters(spark, sf):
    events, now = V.event_objects(spark, sf), V.as_of(spark, sf)
    return select.merge_counters(select.popular_events(events, RECENT, now), select.breaking_events(events, RECENT, now))


@query
def latest_articles_per_event(spark, sf):
    events = settle(V.event_objects(spark, sf).filter("total_article_count >= 3"))
    rows = select.attach_event_size(select.latest_per_event(V.plain_articles(spark, sf), 3), events)
    return rows.select("event_uri", "id", "total_articles_in_event")


@query
def source_whitelist(spark, sf):
    """Documents of trusted sources; names resolve through a source dimension."""
    docs = V.table(spark, sf, "documents")
    dim = docs.select(F.concat(F.lit("name of "), "source").alias("name"), F.col("source").alias("uri")).distinct()
    names = dim.filter(F.col("uri").isin("src1", "src3", "src5", "src7")).select("name").unionByName(
        docs.select(F.concat(F.lit("unknown "), "lang").alias("name")).distinct())
    trusted = select.resolve_sources(names, dim)
    return select.trusted_only(docs, "source", trusted).select("doc_id", "source")


@query
def top_trending_by_type(spark, sf):
    kinds = F.element_at(F.array(*[F.lit(t) for t in ("person", "org", "loc", "wiki")]),
                         (F.regexp_extract("uri", r"(\d+)", 1).cast("int") % 4 + 1))
    rows = V.trending(spark, sf).withColumn("type", kinds)
    return select.top_trending(rows, SelectionParams(trending_count=20)).select("uri", "type", r6("score", "score"))


# Tables

@query
def insert_ignore(spark, sf):
    """All articles arrive, those on errors twice; the first half of the month is stored already."""
    rows = V.plain_articles(spark, sf).select("id", "title", "published_at", F.lit(0).alias("pos"))
    again = rows.filter(F.startswith("title", F.lit("error"))).withColumns({"title": F.concat("title", F.lit(" again")), "pos": F.lit(1)})
    return tables.insert_new(rows.unionByName(again), rows.filter(EARLIER), "id", [F.col("pos")]).select("id", "title")


@query
def upsert_latest(spark, sf):
    """Concept scores of the first half of the month, updated by those of the second half."""
    def part(condition):
        rows = V.event_rows(spark, sf).filter(condition)
        return rows.select(F.concat(F.lit("c/"), "k").alias("uri"), F.col("value").alias("score"), F.col("ts").alias("updated_at"))

    first = part("ts < timestamp_ntz'2024-01-15 00:00:00'")
    current = tables.upsert_latest(first.limit(0), first)
    return tables.upsert_latest(current, part("ts >= timestamp_ntz'2024-01-15 00:00:00'")).select(
        "uri", r6("score", "score"), stamp("updated_at"))


@query
def unscored_queue(spark, sf):
    rows = V.plain_articles(spark, sf)
    return tables.unscored(rows, rows.filter(EARLIER), rows.filter("source_importance IS NULL")).select("id", "event_uri")


@query
def raw_without_summary(spark, sf):
    rows = V.plain_articles(spark, sf)
    return tables.without_summary(rows, rows.filter(~F.startswith("title", F.lit("view"))).select(F.col("id").alias("raw_id"))).select("id")


@query
def scored_view(spark, sf):
    done = V.scores(spark, sf).filter(EARLIER)
    view = tables.with_flag_defaults(tables.scored_view(V.plain_articles(spark, sf), done))
    return view.select("id", "title", F.coalesce(F.round("final_score_v2", 6), F.lit(-1.0)).alias("final_score_v2"), "is_suppressed")


@query
def split_rejects(spark, sf):
    rows = V.plain_articles(spark, sf).select(
        F.when(~F.startswith("title", F.lit("signup")), F.col("id")).alias("id"), "url",
        F.when(F.startswith("title", F.lit("error")), -1).otherwise(1).alias("total_articles_in_event"))
    kept, bad = tables.split_rejects(rows)
    return kept.select("url", F.lit("kept").alias("fate")).unionByName(bad.select("url", F.lit("rejected").alias("fate")))


@query
def delete_by_date(spark, sf):
    return tables.without_collected_on(V.plain_articles(spark, sf), DAY).select("id", stamp("collected_at"))


@query
def preview_delete(spark, sf):
    return tables.collected_on(V.plain_articles(spark, sf), DAY).select("id", stamp("collected_at"))


@query
def truncate_requeues_all(spark, sf):
    rows = V.plain_articles(spark, sf)
    return tables.row_count(tables.without_summary(rows, tables.emptied(rows.select(F.col("id").alias("raw_id")))))


@query
def unify_sources(spark, sf):
    """Articles, documents and pages in one schema."""
    a = V.plain_articles(spark, sf).select("id", "title", "url", F.col("source_name").alias("source"))
    d = V.table(spark, sf, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), F.col("text").alias("body"), "source", "lang")
    p = V.table(spark, sf, "pages").select(F.concat(F.lit("p"), "page_id").alias("id"), "url", F.col("html").alias("body"))
    rows = tables.unify([a, d, p])
    return rows.select("id", *[F.coalesce(c, F.lit("none")).alias(c) for c in ("title", "url", "source", "lang")],
                       F.coalesce(F.length("body"), F.lit(-1)).cast("long").alias("body_length"))


@query
def column_check(spark, sf):
    half = tables.scored_view(V.plain_articles(spark, sf), V.scores(spark, sf).filter(EARLIER))
    return schemas.column_check(half)


@query
def latest_raw_rows(spark, sf):
    rows = tables.latest_rows(V.event_rows(spark, sf), [F.desc("event_id")], 3)
    return rows.select("event_id", X.snippet(F.col("event_type"), 4).alias("title_snip"), stamp("ts", "published_at"))


@query
def latest_summaries(spark, sf):
    rows = tables.latest_rows(V.table(spark, sf, "documents"), [F.desc("doc_id")], 5)
    return rows.select("doc_id", X.snippet(F.col("text"), 40).alias("snip"))


# Monitoring

@query
def suppression_monitor(spark, sf):
    return monitor.suppression_monitor(V.scores(spark, sf), V.as_of(spark, sf))


@query
def suppression_summary(spark, sf):
    return monitor.suppression_summary(V.scores(spark, sf), V.as_of(spark, sf))


@query
def suppression_stats(spark, sf):
    return monitor.batch_suppression(V.scores(spark, sf))


@query
def score_column_stats(spark, sf):
    rows = monitor.column_stats(V.scores(spark, sf), ["hot_score_v2", "sent_score_v2", "entity_hot_score", "final_score_v2"])
    return rows.select("column_name", *[r6(c, c) for c in ("min_value", "max_value", "avg_value")])


@query
def score_distribution(spark, sf):
    rows = monitor.score_distribution(V.scores(spark, sf), V.as_of(spark, sf))
    return rows.withColumn("avg_score", F.round("avg_score", 6))


@query
def topic_class_distribution(spark, sf):
    rows = monitor.topic_class_distribution(V.scores(spark, sf), V.as_of(spark, sf))
    return rows.select("topic_category", "article_count", r6("avg_final_score", "avg_final_score"), r6("avg_hot_norm", "avg_hot_norm"))


@query
def suppression_trend_daily(spark, sf):
    rows = monitor.suppression_trend(V.scores(spark, sf))
    return rows.withColumn("logical_date", F.col("logical_date").cast("string"))


@query
def suppression_by_source(spark, sf):
    return monitor.suppression_by_source(V.scores(spark, sf))


@query
def damping_effect(spark, sf):
    rows = monitor.damping_effect(V.scores(spark, sf))
    return rows.select("topic_category", "article_count", *[r6(c, c) for c in ("avg_before", "avg_after", "avg_loss")])


@query
def quality_by_treatment(spark, sf):
    rows = monitor.quality_by_treatment(V.scores(spark, sf))
    return rows.select("treatment", "article_count", r6("avg_authority", "avg_authority"),
                       r6("avg_final_score", "avg_final_score"), "high_score_records")


@query
def affected_articles(spark, sf):
    rows = monitor.affected_articles(V.scores(spark, sf), V.as_of(spark, sf))
    return rows.select("id", "source_name", stamp("published_at"), r6("hot_norm", "hot_norm"), "final_score_v2",
                       "is_routine_topic", "is_breaking_news", "is_suppressed", "is_downweighted")


@query
def top_articles(spark, sf):
    best = monitor.top_articles(V.scores(spark, sf)).select("id", "final_score_v2")
    rows = V.plain_articles(spark, sf).join(F.broadcast(best), "id")
    return rows.select("id", X.snippet(F.col("title"), 50).alias("title_snippet"), stamp("published_at"), "final_score_v2")


@query
def top_concepts(spark, sf):
    return monitor.top_concepts(V.trending(spark, sf)).select("uri", r6("score", "score"), stamp("updated_at"))


@query
def run_metrics(spark, sf):
    docs = V.table(spark, sf, "documents")
    return monitor.run_metrics(docs, docs.filter("lang = 'en'"))


def state_of_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The state after three runs, each with rows of all dates; the third counted wrong scores first, and corrects them."""
    folder, scored, turn = scratch(spark, "state"), V.scores(spark, sf), F.pmod(F.col("id").cast("long"), F.lit(3))
    wrong = scored.filter(turn == 2).withColumns({
        "final_score_v2": F.lit(9.0), "is_suppressed": ~F.col("is_suppressed"), "source_name": F.lit("unknown")})
    runs = [daily_state.partials(scored.filter(turn == k)) for k in (0, 1)] + [
        daily_state.partials(wrong),
        daily_state.partials(wrong, sign=-1).unionByName(daily_state.partials(scored.filter(turn == 2)))]
    for number, rows in enumerate(runs):
        sinks.append_table(rows.withColumn("run", F.lit(f"run-{number}")), folder, by="run")
    return daily.read_table(spark, folder, daily.STATE)


@query
def state_trend(spark, sf):
    return daily_state.trend(state_of_runs(spark, sf)).withColumn("logical_date", F.col("logical_date").cast("string"))


@query
def state_by_source(spark, sf):
    return daily_state.by_source(daily_state.compacted(state_of_runs(spark, sf)))


@query
def state_effect(spark, sf):
    rows = daily_state.effect(state_of_runs(spark, sf))
    return rows.select("topic_category", "article_count", *[r6(c, c) for c in ("avg_before", "avg_after", "avg_loss")])


@query
def state_quality(spark, sf):
    rows = daily_state.quality(state_of_runs(spark, sf))
    return rows.select("treatment", "article_count", r6("avg_authority", "avg_authority"),
                       r6("avg_final_score", "avg_final_score"), "high_score_records")


@query
def observed_metrics(spark, sf):
    """A run over all briefings whose metrics are counted by its own writes, and stored as a stage."""
    folder, run = scratch(spark, "stages"), monitor.ObservedRun()
    recent = V.scores(spark, sf).select("id", "final_score_v2", TC.logical_date_bj(F.col("published_at")).alias("logical_date"))
    sinks.write_stage(run.candidates(recent, F.col("logical_date") == F.lit(DAY).cast("date")), folder, DAY, "prefiltered")
    texts, docs = V.briefings(spark, sf), V.documents(spark, sf)
    prompt = X.prompt(F.lit("From {source_filename}:\n{summary_content}"), F.col("doc_id").cast("string"), F.col("text"))
    sinks.write_stage(run.prompts(docs.select("doc_id", prompt.alias("prompt")), F.col("prompt")), folder, DAY, "prompts")
    sinks.write_stage(run.briefings(texts, F.col("text")), folder, DAY, "briefings")
    parsed = cards.parse_cards(texts)
    sinks.write_stage(run.cards(parsed, F.col("title").isNotNull() & F.col("date").isNotNull()), folder, DAY, "cards")
    stored = sinks.write_stage(run.metrics(spark), folder, DAY, "metrics")
    return spark.read.json(stored).select(
        "n_candidates", "n_prompts", "prompt_bytes", "token_estimate", "n_briefings", "n_cards", "retries", "is_complete",
        "fallback_used", "schema_validated", "dry_run")


@query
def declared_columns(spark, sf):
    """Scores in files without a flag, with another default, and with a flag that may be NULL, as their files declare them."""
    scored, folder = V.scores(spark, sf).select("id", "is_suppressed", "is_downweighted", "is_breaking_news"), scratch(spark, "declared")
    fields = [f for f in schemas.DECLARED_SCORES.fields if f.name in scored.columns]
    plain = schemas.T.StructType([schemas.T.StructField(f.name, f.dataType) for f in fields])
    flags = {name: "false" for name in schemas.FLAG_DEFAULTS}
    kinds = {
        "lacks": (scored.drop("is_breaking_news"), schemas.declared(plain, flags, ["id", *flags])),
        "other": (scored, schemas.declared(plain, {**flags, "is_suppressed": "true"}, ["id", *flags])),
        "nullable": (scored.withColumn("is_downweighted", F.when(F.col("is_downweighted"), True)), schemas.declared(
            plain, flags, ["id", "is_suppressed", "is_breaking_news"]))}
    expected, found = schemas.T.StructType(fields), []
    for kind, (rows, declaration) in kinds.items():
        schemas.with_declarations(rows, declaration).write.parquet(f"{folder}/{kind}")
        table = spark.read.parquet(f"{folder}/{kind}")
        lines = {x.split(":")[0]: x.split(": ")[1] for x in schemas.schema_differences(table, expected)}
        told = schemas.column_check(table, ["is_suppressed", "is_downweighted", "is_breaking_news"])
        said = F.create_map(*[F.lit(v) for pair in lines.items() for v in pair])[F.col("column_name")]
        found.append(told.select(F.lit(kind).alias("file"), "column_name", F.coalesce("column_default", F.lit("none")).alias("column_default"),
                                 F.coalesce("is_nullable", F.lit(True)).alias("is_nullable"), "n_values", "n_null",
                                 F.coalesce(said, F.lit("as declared")).alias("difference")))
    return tables.unify(found)


@query
def added_column(spark, sf):
    """Scores of the first half of the month in files without the flags, the others with them: the files' default fills in."""
    folder, scored = scratch(spark, "added"), V.scores(spark, sf).select("id", "published_at", *schemas.FLAG_DEFAULTS)
    early = F.col("published_at") < F.lit("2024-01-15 00:00:00").cast("timestamp")
    scored.filter(early).select("id", "published_at").write.parquet(folder)
    schemas.with_declarations(scored.filter(~early), schemas.DECLARED_SCORES).write.mode("append").parquet(folder)
    return schemas.read_declared(spark, folder).select("id", *schemas.FLAG_DEFAULTS)


@query
def table_row_counts(spark, sf):
    names = ["events", "documents", "pages", "embeddings"]
    counts = [tables.row_count(V.table(spark, sf, n)).withColumn("table_name", F.lit(n)) for n in names]
    return tables.unify(counts)


# Repeats

@query
def exact_dedup(spark, sf):
    return dedup.exact_repeats_dropped(V.table(spark, sf, "documents"), "doc_id", "text").select("doc_id", "lang")


@query
def simhash_signatures(spark, sf):
    return dedup.signatures(V.documents(spark, sf), "doc_id", F.col("text"))


@query
def near_dup_simhash(spark, sf):
    rows = V.documents(spark, sf)
    return dedup.near_repeats(rows, "doc_id", F.col("text")).select("doc_id", "earliest", "is_repeat")


@query
def similar_documents(spark, sf):
    """Documents with an earlier one that shares 80 % of the words."""
    return dedup.similar_repeats(V.documents(spark, sf), "doc_id", F.col("text"))


@query
def similar_title_url(spark, sf):
    """Pages with an earlier one that shares 80 % of the words of title and url."""
    rows = V.table(spark, sf, "pages").select("page_id", F.concat_ws(
        " ", F.regexp_extract("html", r"<title>([^<]*)</title>", 1), F.regexp_replace("url", "[/:?#=&._-]+", " ")).alias("text"))
    return dedup.similar_repeats(rows, "page_id", F.col("text"))


@query
def url_dedup(spark, sf):
    return dedup.same_url_dropped(V.table(spark, sf, "pages"), "page_id").select("page_id", "url")


@query
def url_or_title_dedup(spark, sf):
    """Pages without an earlier page of the same url or a similar title."""
    rows = V.table(spark, sf, "pages").select("page_id", "url", F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"))
    return dedup.repeats_dropped(rows, "page_id").select("page_id")


@query
def richest_per_group(spark, sf):
    rows = V.table(spark, sf, "documents").withColumn("event", F.concat("source", F.lit("/"), "lang"))
    return dedup.richest_per_group(rows, "event", "doc_id", "text").select("event", "doc_id", F.length("text").cast("long").alias("n"))


# Cards

def marked_documents(spark: SparkSession, sf: str) -> DataFrame:
    return cards.with_keyword_marks(V.documents(spark, sf), F.col("text"), CONFLICT, BANG, INSIDER)


@query
def keyword_filter_exception(spark, sf):
    return cards.without_routine_conflict(marked_documents(spark, sf)).select("doc_id", "has_conflict", "has_bang", "has_insider")


@query
def keyword_lists(spark, sf):
    """Thousands of listed words: the last one of every document, as conflict, bang or insider word by turns."""
    docs = V.documents(spark, sf)
    kinds = ("conflict", "bang", "insider")
    listed = docs.select(F.element_at(F.array(*map(F.lit, kinds)), (F.col("doc_id") % 3 + 1).cast("int")).alias("kind"),
                         F.element_at(F.split("text", " "), -1).alias("keyword")).filter("keyword <> ''")
    marked = keywords.with_listed_marks(docs, "doc_id", "text", settle(listed), kinds)
    return marked.select("doc_id", *[f"has_{kind}" for kind in kinds])


@query
def card_picks(spark, sf):
    """Ten picks: one document per source and language, bang words first."""
    rows = marked_documents(spark, sf).select(
        F.concat("source", F.lit("/"), "lang").alias("event_uri"), F.col("doc_id").alias("id"), F.col("text").alias("body"),
        "has_bang", (F.col("n_chars") % 1000).alias("final_score_v2"))
    return cards.picks(rows).select(F.col("pick_no").cast("long").alias("pick_no"), "event_uri", "id", "has_bang")


@query
def truncate_and_cap(spark, sf):
    """Candidates of the last day by score, at most 60, with clipped bodies."""
    rows = V.scores(spark, sf).select("id", "published_at", "final_score_v2")
    bodies = bodied_articles(spark, sf).select("id", "body")
    return cards.candidates(rows.join(bodies, "id"), V.as_of(spark, sf), 800, 60).select("id", "body", "final_score_v2")


@query
def candidate_window(spark, sf):
    """All rows of the last day."""
    return cards.recent(V.scores(spark, sf), V.as_of(spark, sf), 24).select("id", "final_score_v2")


@query
def score_threshold(spark, sf):
    return cards.above(V.scores(spark, sf), 0.6, "final_score_v2").select("id", "final_score_v2")


@query
def picks_by_index(spark, sf):
    """Rows chosen by position within their source."""
    docs = V.table(spark, sf, "documents").select("source", "doc_id", (F.floor(F.col("doc_id") / 20)).cast("int").alias("position"))
    chosen = docs.select("source").distinct().withColumn("indices", F.array(*[F.lit(i) for i in (4, 0, 2)]))
    return cards.selected(docs, chosen, "source").select("source", F.col("pick_pos").cast("long").alias("pick_pos"), "doc_id")


@query
def card_parse(spark, sf):
    rows = cards.parse_cards(V.briefings(spark, sf))
    return rows.select(
        "name", F.col("card_no").cast("long").alias("card_no"), F.array_join("tags", " ").alias("tags"), "title", "subtitle",
        "content", F.coalesce("angle", F.lit("none")).alias("angle"), F.col("date").cast("string").alias("date"), "source",
        F.coalesce("source_url", F.lit("none")).alias("source_url"), "source_domain")


@query
def card_cleanup(spark, sf):
    """Clipped fields, repaired tags, one card per title and subtitle. Every card occurs again, later and with other content."""
    parsed = cards.parse_cards(V.briefings(spark, sf))
    again = parsed.withColumns({"pos": F.col("pos") + 100, "content": F.lit("again")})
    rows = cards.clean_cards(parsed.unionByName(again))
    return rows.select("name", F.col("card_no").cast("long").alias("card_no"), "title", "subtitle",
                       F.length("content").cast("long").alias("content_length"), F.array_join("tags", " ").alias("tags"))


@query
def card_quality_gate(spark, sf):
    return cards.enough_cards(cards.parse_cards(V.briefings(spark, sf)))


@query
def card_completeness(spark, sf):
    rows = cards.completeness(V.briefings(spark, sf))
    return rows.select("name", *[F.col(c).cast("long").alias(c) for c in ("last_topic", "first_no", "last_no")])


@query
def clip_fields(spark, sf):
    text = F.col("text")
    return V.table(spark, sf, "documents").select(
        "doc_id", X.clip(text, 8).alias("title"), X.clip(text, 12).alias("subtitle"), X.clip(text, 200).alias("summary"),
        X.utf8_size(text).cast("long").alias("n_bytes"))


@query
def summary_points(spark, sf):
    text = F.replace("text", F.lit("."), F.lit("；"))
    return V.table(spark, sf, "documents").select("doc_id", F.array_join(X.summary_points(text), "|").alias("points"))


@query
def hashtag_fix(spark, sf):
    rows = V.table(spark, sf, "documents").select("doc_id", "lang", "source")
    valid = F.array(F.concat(F.lit("#"), "lang"), F.concat(F.lit("#"), "source"), F.lit("#x"))
    some = F.array("lang", F.concat(F.lit("#"), "source"), "source", F.lit("#a"), F.lit("b"), F.lit("#c"), F.lit("d"))
    tags = F.when(F.col("doc_id") % 9 != 8, F.slice(some, 1, (F.col("doc_id") % 8).cast("int")))
    tags = F.when(F.col("doc_id") % 10 == 3, valid).otherwise(tags)
    return rows.select("doc_id", X.tags_valid(tags).alias("is_valid"), F.array_join(X.tags_fixed(tags), " ").alias("tags"))


@query
def prompt_text(spark, sf):
    docs = V.table(spark, sf, "documents").select(F.concat(F.lit("doc"), "doc_id").alias("name"), "text")
    rows = cards.prompts(docs, "From {source_filename}:\n---\n{summary_content}\n---\n")
    return rows.select("name", F.md5("prompt").alias("prompt_md5"), F.col("input_bytes").cast("long").alias("input_bytes"))


@query
def card_local_fields(spark, sf):
    """Date from the logical date and source from media name and url."""
    day = TC.logical_date_bj(F.col("published_at"))
    rows = cards.with_local_fields(V.plain_articles(spark, sf), day, F.col("source_name"), F.col("url"))
    return rows.select("id", F.col("date").cast("string").alias("date"), "source")


@query
def url_domain(spark, sf):
    return V.table(spark, sf, "pages").select("page_id", X.domain(F.col("url")).alias("domain"))


@query
def digest_concat(spark, sf):
    """One digest per language: its blocks in document order."""
    docs = V.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("name"), "text", "lang", "doc_id")
    rows = files.build_digest(docs, [F.col("doc_id")], F.col("lang"), "doc_id")
    return rows.select("digest", "position", "name", F.md5("block").alias("block_md5"))


@query
def digest_index(spark, sf):
    """Position, byte offset and size of every block of the digests per language."""
    docs = V.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("name"), "text", "lang", "doc_id")
    return files.digest_index(docs, [F.col("doc_id")], F.col("lang")).select("digest", "position", "name", "offset", "size")


# Files

@query
def latest_file_by_strategy(spark, sf):
    catalogue, now = V.file_catalogue(spark, sf), V.as_of(spark, sf)
    choices = {
        "by_ds": files.newest_report(catalogue, "by_ds", DAY),
        "by_ds_absent": files.newest_report(catalogue, "by_ds", "2023-01-01"),
        "by_ds_then_latest": files.newest_report(catalogue, "by_ds_then_latest", "2023-01-01"),
        "latest_any": files.newest_report(catalogue, "latest_any"),
        "within_48h": files.newest_within(catalogue, now),
        "briefing_latest": files.briefing_files(catalogue, "latest_any"),
        "briefing_daily": files.briefing_files(catalogue, "latest_daily_single", DAY),
    }
    named = [rows.select(F.lit(n).alias("choice"), F.coalesce("path", F.lit("none")).alias("path")) for n, rows in choices.items()]
    return tables.unify(named)


@query
def briefings_of_day(spark, sf):
    rows = files.briefing_files(V.file_catalogue(spark, sf), "by_date", DAY)
    return rows.select("name", stamp("modified_at"))


@query
def file_names(spark, sf):
    ts = F.col("ts").cast("timestamp")
    day = TC.prev_logical_date_str(F.col("ts"))
    return V.table(spark, sf, "events").select(
        "event_id", TC.briefing_file_name(ts).alias("briefing"), TC.report_file_name(day, F.lit("manual"), ts).alias("report"))


# Landed files and sinks: write to the shared folder, read back

def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query
def ingest_landed_files(spark, sf):
    """Landed article files into the articles table, twice; the second run adds nothing."""
    folder, store = scratch(spark, "landed"), daily.Store(scratch(spark, "store"))
    article_lines(spark, sf).write.text(folder)
    for _ in range(2):
        daily.store_articles(spark, store, landing.flatten_articles(landing.read_articles(spark, folder), GENERATED_AT))
    rows = daily.read_table(spark, store.articles, schemas.ARTICLES)
    return rows.select("id", "title", "source_name", stamp("published_at"), day_text("logical_date"), "published_at_imputed")


def stored_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All articles as rows of the stored table."""
    concepts = F.from_json(F.to_json("concepts"), schemas.ARTICLES["concepts"].dataType)
    rows = V.articles(spark, sf).withColumns({
        "body": F.col("title"), "concepts": concepts, "published_at_imputed": F.lit(False),
        "logical_date": TC.logical_date_bj(F.col("published_at"))})
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.ARTICLES.fields])


def two_batches(spark: SparkSession, sf: str) -> daily.Store:
    """A store whose first batch, half of the month, is scored, and whose second waits."""
    store, rows, at = daily.Store(scratch(spark, "store"), key_buckets=8), stored_rows(spark, sf), V.as_of(spark, sf)
    sinks.write_version(V.trending(spark, sf).withColumn("updated_at", F.col("updated_at").cast("timestamp")), store.trending, 1)
    early = F.col("published_at") < F.lit("2024-01-15 00:00:00").cast("timestamp")
    daily.store_articles(spark, store, rows.filter(early), "first", at)
    daily.score_new(spark, store, at, V.PARAMS)
    daily.store_articles(spark, store, rows, "second", at)
    return store


@query
def batch_queue(spark, sf):
    """What waits for a score by the ledger: the articles that the second batch brought."""
    store = two_batches(spark, sf)
    return daily.scoring_queue(spark, store, Ledger(spark, store.ledger).open_batches()).select("id", "batch", day_text("logical_date"))


@query
def resumed_scoring(spark, sf):
    """A scoring run that was interrupted behind its scores, done again: each article has one score."""
    store, at = daily.Store(scratch(spark, "store"), key_buckets=8), V.as_of(spark, sf)
    sinks.write_version(V.trending(spark, sf).withColumn("updated_at", F.col("updated_at").cast("timestamp")), store.trending, 1)
    daily.store_articles(spark, store, stored_rows(spark, sf), "only", at)
    Ledger(spark, store.ledger).note(["only"], SCORING, at, "interrupted")
    left = V.scores(spark, sf).withColumns({"final_score_v2": F.lit(-1.0), "run": F.lit("interrupted"), "logical_date": TC.logical_date_bj(F.col("published_at"))})
    sinks.append_table(left, store.scores, by=["logical_date", "run"])
    daily.score_new(spark, store, at, V.PARAMS)
    rows = daily.read_table(spark, store.scores, daily.STORED_SCORES)
    return rows.select("id", r6("final_score_v2", "final_score_v2"), "is_suppressed", day_text("logical_date"))


@query
def replayed_batch(spark, sf):
    """A batch of the stream, with unreadable lines, that arrives twice: how much is stored after each time."""
    folder, store, passes = scratch(spark, "landed"), daily.Store(scratch(spark, "store"), key_buckets=8), []
    broken = V.table(spark, sf, "documents").select(F.concat(F.lit('{"uri": "broken '), "doc_id").alias("value"))
    article_lines(spark, sf).unionByName(broken).write.text(folder)
    for number in (1, 2):
        incremental.ingest_batch(store, spark.read.text(folder).select("value", "_metadata"), "stream-0", GENERATED_AT)
        counts = [tables.row_count(daily.read_table(spark, path, schema)).withColumn("table_name", F.lit(name)) for name, path, schema in (
            ("articles", store.articles, daily.STORED_ARTICLES), ("rejects", store.rejects, daily.REJECTS))]
        passes.append(settle(tables.unify(counts).withColumn("pass", F.lit(number))))
    return tables.unify(passes)


@query
def insert_by_keys(spark, sf):
    """All articles arrive, those on errors twice; the keys of the first half of the month are in buckets."""
    known = keys.KeyTable(spark, scratch(spark, "keys"), buckets=8)
    rows = V.plain_articles(spark, sf).select("id", "title", "published_at", F.lit(0).alias("arrival"))
    known.rebuild(rows.filter(EARLIER).withColumn("batch", F.lit("first")))
    again = rows.filter(F.startswith("title", F.lit("error"))).withColumns({"title": F.concat("title", F.lit(" again")), "arrival": F.lit(1)})
    return keys.insert_new_keys(rows.unionByName(again), known, "second").select("id", "title")


@query
def landed_rejects(spark, sf):
    """Good and broken lines of each kind: what is stored, and the broken lines among the rejects."""
    landed, store = scratch(spark, "landed"), daily.Store(scratch(spark, "store"))
    broken = V.table(spark, sf, "documents").select(F.concat(F.lit('{"uri": "broken '), "doc_id").alias("value"))
    article_lines(spark, sf).unionByName(broken).write.text(f"{landed}/articles")
    event = F.to_json(F.struct("uri", "lang", F.col("total_article_count").alias("totalArticleCount"),
                               F.date_format("event_date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eventDate")))
    V.event_objects(spark, sf).select(event.alias("value")).unionByName(broken).write.text(f"{landed}/events")
    item = F.to_json(F.struct("uri", F.lit("org").alias("type"), F.struct(F.struct("score").alias("news")).alias("trendingScore")))
    V.trending(spark, sf).select(item.alias("value")).unionByName(broken).write.text(f"{landed}/trending")
    daily.refresh_trending(spark, store, f"{landed}/trending", GENERATED_AT, SelectionParams())
    daily.ingest(spark, store, f"{landed}/articles", f"{landed}/events", V.as_of(spark, sf), SelectionParams(articles_per_event=2))
    rejects = daily.read_table(spark, store.rejects, daily.REJECTS).select("kind", F.col("line").alias("value"))
    concepts, _ = daily.read_trending(spark, store)
    events = landing.read_events(spark, f"{landed}/events").select(F.lit("event").alias("kind"), F.col("uri").alias("value"))
    return rejects.unionByName(events).unionByName(concepts.select(F.lit("trending").alias("kind"), F.col("uri").alias("value")))


@query
def first_of_batch(spark, sf):
    """Every article in two folders of one batch, newer and under another title in the second: the first folder wins."""
    folder, store = scratch(spark, "landed"), daily.Store(scratch(spark, "store"))
    rows = V.plain_articles(spark, sf)
    for name, hours, suffix in (("a", 0, ""), ("b", 2, " again")):
        at = F.date_format(F.col("published_at").cast("timestamp") + F.make_dt_interval(hours=F.lit(hours)), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        rows.select(F.to_json(F.struct(F.col("id").alias("uri"), F.concat("title", F.lit(suffix)).alias("title"), at.alias(
            "dateTimePub"))).alias("value")).write.text(f"{folder}/{name}")
    daily.store_articles(spark, store, landing.flatten_articles(landing.read_articles(spark, f"{folder}/*"), GENERATED_AT))
    return daily.read_table(spark, store.articles, schemas.ARTICLES).select("id", "title")


@query
def schema_check(spark, sf):
    """Columns of the landed articles that differ from the stored table, one line each."""
    lines = schemas.schema_differences(V.plain_articles(spark, sf), schemas.ARTICLES)
    counts = V.plain_articles(spark, sf).agg(F.count("*").alias("n"))
    return counts.select(F.explode(F.array(*[F.lit(x.split(":")[0]) for x in lines])).alias("column_name"), "n")


@query
def cutoff_settings(spark, sf):
    """Articles per logical date under the day boundary that each setting resolves to; one that cannot be read counts as 6."""
    rows, found = V.plain_articles(spark, sf).select("published_at"), []
    for said in ("0", "8", "23", "25", "-1", "x", ""):
        hour = params.cutoff_hour({params.CUTOFF_SETTING: said}.get)
        dated = rows.select(TC.logical_date_bj(F.col("published_at"), hour).cast("string").alias("logical_date"))
        found.append(dated.groupBy("logical_date").agg(F.count("*").alias("n")).withColumn("setting", F.lit(said)))
    return tables.unify(found)


@query
def now_prev_date(spark, sf):
    """The previous date as seen from the latest event, and how many events fall on it."""
    now = TC.now_prev_logical_date_str(V.as_of(spark, sf))
    rows = V.table(spark, sf, "events").filter(F.date_format(TC.utc_to_bj(F.col("ts")), "yyyy-MM-dd") == now)
    return rows.groupBy(now.alias("prev_date")).agg(F.count("*").alias("n"))


@query
def incremental_ingest(spark, sf):
    """The file stream over two arrivals, the second with all articles again."""
    folder, store = scratch(spark, "arrivals"), daily.Store(scratch(spark, "store"))
    lines = article_lines(spark, sf)
    for part in (lines.filter(F.contains("value", F.lit('"title":"view'))), lines):
        part.write.mode("append").text(folder)
        incremental.ingest_available(spark, store, folder, f"{store.root}/stream", GENERATED_AT).awaitTermination()
    return daily.read_table(spark, store.articles, schemas.ARTICLES).select("id", "event_uri", day_text("logical_date"))


@query
def daily_pipeline(spark, sf):
    """The whole daily run on landed files of all events, articles and concepts: its stored scores."""
    landed, store = scratch(spark, "landed"), daily.Store(scratch(spark, "store"))
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    V.event_objects(spark, sf).select(F.to_json(F.struct(
        "uri", "lang", F.col("total_article_count").alias("totalArticleCount"),
        F.date_format("event_date", micros).alias("eventDate"))).alias("value")).write.text(f"{landed}/events")
    V.plain_articles(spark, sf).select(F.to_json(F.struct(
        F.col("id").alias("uri"), "title", "url", F.date_format("published_at", micros).alias("dateTimePub"), "sentiment",
        F.struct(F.col("source_name").alias("uri"), F.struct(F.col("source_importance").alias("importanceRank")).alias("ranking")).alias("source"),
        F.col("event_uri").alias("eventUri"), "concepts")).alias("value")).write.text(f"{landed}/articles")
    V.trending(spark, sf).select(F.to_json(F.struct(
        "uri", F.lit("org").alias("type"), F.struct(F.struct("score").alias("news")).alias("trendingScore"))).alias("value")).write.text(f"{landed}/trending")
    daily.run_day(spark, store, landed, DAY, V.as_of(spark, sf), V.PARAMS, SelectionParams(articles_per_event=2))
    rows = daily.read_table(spark, store.scores, daily.STORED_SCORES)
    return rows.select(
        "id", "event_uri", F.col("total_articles_in_event").cast("long").alias("total_articles_in_event"),
        r6("entity_hot_score", "entity_hot_score"), r6("hot_norm", "hot_norm"), r6("final_score_v2", "final_score_v2"),
        "is_suppressed", "is_downweighted", day_text("logical_date"))


@query
def read_landed_events(spark, sf):
    folder = scratch(spark, "events")
    V.event_objects(spark, sf).select(F.to_json(F.struct(
        "uri", "lang", F.col("total_article_count").alias("totalArticleCount"),
        F.date_format("event_date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eventDate"),
        F.array("source_uri", F.lit("src99")).alias("sourceUris"))).alias("value")).write.text(folder)
    trusted = spark.createDataFrame([("src1",), ("src2",), ("src99999",)], "uri string")
    rows = select.events_of_sources(landing.read_events(spark, folder), trusted)
    return rows.select("uri", "lang", F.col("total_article_count").cast("long").alias("total_article_count"), stamp("event_date"))


@query
def read_landed_trending(spark, sf):
    folder = scratch(spark, "trending")
    item = F.struct(F.concat(F.lit("c/"), "k").alias("uri"), F.lit("org").alias("type"),
                    F.struct(F.struct(F.col("value").alias("score")).alias("news")).alias("trendingScore"))
    V.event_rows(spark, sf).select(F.to_json(F.struct(F.array(item).alias("results"))).alias("value")).write.text(folder)
    rows = landing.read_trending(spark, folder, GENERATED_AT)
    best = tables.upsert_latest(rows.select("uri", "score", "updated_at").limit(0), rows.select("uri", "score", "updated_at"))
    return best.select("uri", r6("score", "score"), stamp("updated_at"))


@query
def report_sink(spark, sf):
    """Whole reports of two runs, one of them twice, found by listing and read back: every article under its file's name."""
    folder = written_reports(spark, sf)
    found = files.list_documents(spark, folder).filter(files.is_report(F.col("name")))
    lines = files.read_documents(spark, folder).filter(F.contains("value", F.lit('"eventId"')))
    article = F.from_json(F.regexp_replace("value", "^,", ""), ARTICLE_JSON)
    return lines.join(found, "path").select("name", article.alias("a")).select("name", "a.rank", "a.eventId", "a.url")


def written_reports(spark: SparkSession, sf: str) -> str:
    folder = scratch(spark, "reports")
    lines = settle(report.report_lines(report.daily_report(V.scores(spark, sf), V.articles(spark, sf)), GENERATED_AT))
    for run_type, at in (("manual", "2024-02-01 10:00:00"), ("manual", "2024-02-01 10:00:00"), ("scheduled", "2024-02-01 22:00:00")):
        sinks.write_report(lines, folder, run_type, F.lit(at).cast("timestamp"))
    return folder


@query
def report_found(spark, sf):
    """The newest report of a date among written ones, whole: its lines in order."""
    found = files.recorded_documents(spark, written_reports(spark, sf))
    path = files.report_path(found, "by_ds", DAY)
    lines = ranking.numbered(files.read_documents(spark, path), [F.col("place")], name="line_no")
    article = F.from_json(F.regexp_replace("value", "^,", ""), ARTICLE_JSON)
    return lines.select("line_no", F.lit(path.rsplit("=", 1)[1]).alias("name"), article["eventId"].alias("eventId"), F.when(
        F.contains("value", F.lit('"eventId"')), article["rank"]).alias("rank"))


@query
def briefing_sink(spark, sf):
    """Every document as a briefing under the file name of a run of its own, written twice, recorded and read back whole."""
    folder = scratch(spark, "briefings")
    run_at = F.lit("2024-01-01 22:00:00").cast("timestamp") + F.make_dt_interval(secs=F.col("doc_id"))
    rows = V.table(spark, sf, "documents").select("text", run_at.alias("run_at"))
    for _ in range(2):
        sinks.write_briefings(rows, folder, F.col("run_at"))
    recorded = files.recorded_documents(spark, folder).select("name", "path")
    lines = files.read_recorded(spark, folder)
    # Of each text its lines in order; a text is as long as one document.
    whole = lines.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]), "\n").alias("text"))
    bare = lambda path: F.regexp_extract(path, "file_name=([^/]+)$", 1)
    found = whole.select(bare(F.col("path")).alias("name"), F.md5("text").alias("text_md5"))
    # Paths compress so well that all of them look small enough to broadcast.
    return found.hint("merge").join(recorded, "name").select(F.col("name").alias("file_name"), "text_md5")


@query
def daily_append(spark, sf):
    """Texts appended per date by two runs."""
    folder = scratch(spark, "daily")
    rows = V.event_rows(spark, sf).select(
        F.to_date("ts").cast("string").alias("date"), F.concat(F.lit("## "), "event_type", F.lit(" "), "event_id").alias("text"))
    for early in (True, False):
        sinks.append_daily(rows.filter(F.startswith("text", F.lit("## view")) == early), folder)
    return spark.read.text(folder).select(day_text("date"), F.col("value").alias("text"))


@query
def stage_sink(spark, sf):
    """The rows of one day as the named stage of a run."""
    rows = V.scores(spark, sf)
    day = rows.filter(TC.in_logical_day(rows, "published_at", DAY)).select("id", "event_uri", "final_score_v2")
    folder = sinks.write_stage(day, scratch(spark, "stages"), DAY, "prefiltered")
    return spark.read.schema("id string, event_uri string, final_score_v2 double").json(folder)


@query
def digest_sink(spark, sf):
    """Digests written as line files, one of them twice: every line in its place."""
    folder = scratch(spark, "digests")
    docs = V.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("name"), "text", "lang", "doc_id")
    blocks = files.digest_blocks(docs, F.col("lang"))
    sinks.write_reports_digest(blocks, [F.col("doc_id")], folder)
    sinks.write_digest(files.build_digest(docs.filter("lang = 'de'"), [F.col("doc_id")], F.col("lang"), "doc_id"), folder)
    lines = files.read_documents(spark, folder).withColumn("digest", F.regexp_extract("path", "digest=([^/]+)$", 1))
    placed = ranking.numbered(lines.select("digest", "place", "value"), [F.col("place")], within="digest", name="line_no")
    return placed.select("digest", "line_no", F.md5("value").alias("line_md5"))


@query
def table_versions(spark, sf):
    """A table without one collection date as its next version, then emptied."""
    root = scratch(spark, "versions")
    rows = V.plain_articles(spark, sf).select("id", "collected_at")
    first = spark.read.parquet(sinks.write_version(tables.without_collected_on(rows, DAY), root, 1))
    second = spark.read.parquet(sinks.write_version(tables.emptied(first), root, 2))
    return tables.unify([tables.row_count(t).withColumn("version", F.lit(v)) for v, t in ((1, first), (2, second))])


@query
def replaced_dates(spark, sf):
    """Scores of one date written again; the partitions of the other dates stay."""
    folder = scratch(spark, "scores")
    rows = V.scores(spark, sf).select("id", "final_score_v2", TC.logical_date_bj(F.col("published_at")).alias("logical_date"))
    sinks.append_table(rows, folder, by="logical_date")
    again = rows.filter(F.col("logical_date") == F.lit(DAY).cast("date")).withColumn("final_score_v2", F.lit(0.0))
    sinks.replace_dates(again, folder)
    return spark.read.parquet(folder).select("id", "final_score_v2", day_text("logical_date"))
