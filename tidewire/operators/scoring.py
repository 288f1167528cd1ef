"""Score a batch of articles.

One shuffle carries the narrow columns: the concepts are exploded and matched where the articles
are read, each task folds them back to one row per article, and only that row moves. Titles and
bodies stay behind; ``tables.scored_view`` brings them back for the few rows that need them. The
raw scores are settled on shared storage, because the batch extremes and the final columns both
read them; the extremes are six numbers.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import scores as S
from tidewire.functions.concepts import concept_uris, mentions_any
from tidewire.functions.timecols import instant, since
from tidewire.operators.lookup import lookup
from tidewire.params import ScoringParams, uri_list
from tidewire.schemas import DECLARED_SCORES, require_columns, with_declarations
from tidewire.session import settle

ARTICLE_COLUMNS = [
    "id", "event_uri", "source_name", "published_at", "collected_at", "sentiment", "source_importance",
    "total_articles_in_event",
]
FLAG_COLUMNS = ["is_routine_topic", "is_category_topic", "is_breaking_news", "is_suppressed", "is_downweighted"]
SCORE_COLUMNS = [
    "entity_hot_score", "hot_score_v2", "rep_score_v2", "sent_score_v2", "hot_norm_raw", "hot_norm", "rep_norm",
    "sent_norm", "concept_hot_norm", "freshness_score", "final_score_v2",
]


def current_trending(trending: DataFrame, p: ScoringParams, as_of: Column | datetime | str) -> DataFrame:
    """uri and score of the concepts to match; without a maximum age every row ever seen counts."""
    if p.trending_max_age_hours is not None:
        trending = trending.filter(since(trending, "updated_at", as_of, p.trending_max_age_hours))
    return trending.select("uri", F.col("score").cast("double").alias("score"))


def with_entity_hot(articles: DataFrame, trending: DataFrame, carry: list[str], uris: Column) -> DataFrame:
    """Best trending score among the concepts of each article, at least 0.

    ``carry`` holds the primary key and the columns to keep. They are grouping keys, so the fold
    runs as a hash aggregate and before the shuffle.
    """
    long = articles.select(*carry, F.explode_outer(uris).alias("uri"))
    matched = lookup(long, trending, "uri", spread_by=carry[0])
    return matched.groupBy(*carry).agg(S.floor_zero(F.max("score")).alias("entity_hot_score"))


def raw_scores(articles: DataFrame, trending: DataFrame, p: ScoringParams) -> DataFrame:
    """Scores that need no batch statistics, and the topic flags."""
    require_columns(articles, [*ARTICLE_COLUMNS, "concepts"])
    uris = concept_uris(articles)
    flagged = articles.select(
        *ARTICLE_COLUMNS,
        mentions_any(uris, uri_list(p.routine_uris)).alias("is_routine_topic"),
        mentions_any(uris, uri_list(p.category_uris)).alias("is_category_topic"),
        uris.alias("uris"),
    )
    carry = [*ARTICLE_COLUMNS, "is_routine_topic", "is_category_topic"]
    folded = with_entity_hot(flagged, trending, carry, F.col("uris"))
    return folded.withColumns({
        "hot_score_v2": S.hot_score(F.col("total_articles_in_event"), F.col("entity_hot_score"), p),
        "rep_score_v2": S.authority_score(F.col("source_importance"), p),
        "sent_score_v2": S.sentiment_score(F.col("sentiment"), p),
    })


def batch_extremes(raw: DataFrame) -> dict[str, tuple[Column, Column]]:
    """Minimum and maximum of the three normalised scores over the batch, as literals."""
    names = ["hot_score_v2", "sent_score_v2", "entity_hot_score"]
    stats = raw.agg(*[f(n).alias(f"{s}_{n}") for n in names for s, f in (("min", F.min), ("max", F.max))]).first()
    return {n: tuple(F.lit(stats[f"{s}_{n}"]).cast("double") for s in ("min", "max")) for n in names}


def normalised(raw: DataFrame) -> DataFrame:
    """Min-max norms over all rows of ``raw``; authority is a share already.

    The batch extremes and the final columns both read the raw scores, so they are settled first.
    """
    raw = settle(raw)
    extremes = batch_extremes(raw)
    return raw.withColumns({
        "hot_norm_raw": S.minmax(F.col("hot_score_v2"), *extremes["hot_score_v2"]),
        "sent_norm": S.minmax(F.col("sent_score_v2"), *extremes["sent_score_v2"]),
        "concept_hot_norm": S.minmax(F.col("entity_hot_score"), *extremes["entity_hot_score"]),
        "rep_norm": F.col("rep_score_v2"),
    })


def damped(norms: DataFrame, p: ScoringParams, as_of: Column) -> DataFrame:
    fresh = norms.withColumn("freshness_score", S.freshness_score(F.col("published_at"), as_of, p))
    flagged = fresh.withColumn("is_breaking_news", F.col("freshness_score") >= p.breaking_threshold)
    flagged = flagged.withColumns({
        "is_suppressed": S.is_suppressed(F.col("is_routine_topic"), F.col("is_breaking_news")),
        "is_downweighted": S.is_downweighted(F.col("is_category_topic"), F.col("is_routine_topic")),
    })
    factor = S.damping(F.col("is_suppressed"), F.col("is_downweighted"), p)
    return flagged.withColumn("hot_norm", F.col("hot_norm_raw") * factor)


def total(norms: DataFrame, p: ScoringParams) -> DataFrame:
    """Weighted sum. Fails before any job runs if a norm column is missing."""
    parts = ["hot_norm", "rep_norm", "concept_hot_norm", "freshness_score", "sent_norm"]
    require_columns(norms, parts)
    return norms.withColumn("final_score_v2", S.final_score(*[F.col(c) for c in parts], p))


def score_articles(articles: DataFrame, trending: DataFrame, params: ScoringParams | None = None,
                   as_of: Column | datetime | str | None = None) -> DataFrame:
    """Rows of ``article_scores`` for one batch.

    ``articles`` has one row per ``id``. All of it is the normalisation scope. ``as_of`` stands
    for "now" and must be given, so that a rerun gives the same scores.
    """
    if as_of is None:
        raise ValueError("as_of is required")
    p = params or ScoringParams()
    now = instant(as_of)
    raw = raw_scores(articles, current_trending(trending, p, as_of), p)
    scored = total(damped(normalised(raw), p, now), p)
    stored = scored.select(*ARTICLE_COLUMNS, *SCORE_COLUMNS, *FLAG_COLUMNS, now.alias("scored_as_of"))
    return with_declarations(stored, DECLARED_SCORES)


def split_unscorable(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a final score, rows without one). The latter must not return to the queue."""
    usable = F.col("final_score_v2").isNotNull() & ~F.isnan("final_score_v2")
    return scored.filter(usable), scored.filter(~F.coalesce(usable, F.lit(False)))
