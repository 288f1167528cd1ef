"""Choose events and articles to ingest."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.timecols import since
from tidewire.operators.lookup import lookup
from tidewire.operators.ranking import first_per_group, first_rows_per_group, top_rows
from tidewire.params import SelectionParams


def resolve_sources(names: DataFrame, sources: DataFrame) -> DataFrame:
    """Distinct uris of named sources; names that the dimension does not know are dropped."""
    return names.select("name").join(sources.select("name", "uri"), "name").select("uri").distinct()


def trusted_only(rows: DataFrame, source_column: str, trusted: DataFrame, enabled: bool = True) -> DataFrame:
    """Rows of trusted sources. No trusted uri leaves no row; switched off, all rows stay.

    ``trusted`` has one row per uri, so that the join can also run from the left. A hot source is spread by whole rows.
    """
    if not enabled:
        return rows
    return lookup(rows, trusted.select(F.col("uri").alias(source_column)), source_column,
                  spread_by=rows.columns, how="left_semi")


def events_of_sources(events: DataFrame, trusted: DataFrame, enabled: bool = True) -> DataFrame:
    """The whitelist for landed events, which name several sources each in ``source_uris``."""
    if not enabled:
        return events
    pairs = events.select("uri", F.explode("source_uris").alias("source"))
    kept = trusted_only(pairs, "source", trusted).select("uri").distinct()
    return events.join(kept, "uri", "left_semi")


def eligible_events(events: DataFrame, p: SelectionParams, as_of: Column | datetime | str,
                    hours: float | None = None) -> DataFrame:
    """Events of the language, large and recent enough."""
    return events.filter(
        (F.col("lang") == p.language)
        & (F.col("total_article_count") >= p.min_articles)
        & since(events, "event_date", as_of, p.lookback_hours if hours is None else hours)
    )


def popular_events(events: DataFrame, p: SelectionParams, as_of: Column | datetime | str) -> DataFrame:
    """The largest events of the look-back window."""
    rows = eligible_events(events, p, as_of)
    return top_rows(rows, [F.desc("total_article_count"), F.col("uri")], p.popular_limit)


def breaking_events(events: DataFrame, p: SelectionParams, as_of: Column | datetime | str) -> DataFrame:
    """The newest events of the last few hours. Only this path has its own start time."""
    rows = eligible_events(events, p, as_of, p.breaking_hours)
    return top_rows(rows, [F.desc("event_date"), F.col("uri")], p.breaking_limit)


def merge_event_paths(popular: DataFrame, breaking: DataFrame) -> DataFrame:
    """Popular events, then breaking ones that are not among them; ``path`` tells which."""
    both = popular.withColumn("path", F.lit("popular")).unionByName(breaking.withColumn("path", F.lit("breaking")))
    return first_per_group(both, ["uri"], [F.col("path") != "popular", F.desc("event_date")])


def merge_counters(popular: DataFrame, breaking: DataFrame) -> DataFrame:
    """Rows before and after the merge, and how many repeats it removed."""
    both = popular.select("uri").unionByName(breaking.select("uri"))
    groups = both.groupBy("uri").agg(F.count("*").alias("n"))
    counts = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_before"), F.count("*").alias("n_after"))
    return counts.withColumn("n_removed", F.col("n_before") - F.col("n_after"))


def select_events(events: DataFrame, p: SelectionParams, as_of: Column | datetime | str,
                  trusted: DataFrame | None = None) -> DataFrame:
    """Both paths merged, after the whitelist if one is given."""
    if trusted is not None:
        events = events_of_sources(events, trusted)
    return merge_event_paths(popular_events(events, p, as_of), breaking_events(events, p, as_of))


def latest_per_event(articles: DataFrame, n: int, at: str = "published_at") -> DataFrame:
    """The newest ``n`` articles of each event."""
    return first_rows_per_group(articles, [F.col("event_uri")], [F.col(at)], "id", n)


def attach_event_size(articles: DataFrame, events: DataFrame) -> DataFrame:
    """Articles of the given events (unique ``uri``) with the article count of their event.

    A missing count is 0 here. The scorer treats NULL as 1, so the difference matters.
    """
    sizes = events.select(F.col("uri").alias("event_uri"),
                          F.coalesce("total_article_count", F.lit(0)).alias("total_articles_in_event"))
    return lookup(articles.drop("total_articles_in_event"), sizes, "event_uri", spread_by="id", how="inner")


def concepts_of_types(concepts: DataFrame, types: Sequence[str]) -> DataFrame:
    return concepts.filter(F.col("type").isin(*types))


def top_trending(concepts: DataFrame, p: SelectionParams) -> DataFrame:
    """The hottest concepts of the wanted types."""
    wanted = concepts_of_types(concepts, p.trending_types)
    return top_rows(wanted, [F.desc("score"), F.col("uri")], p.trending_count)
