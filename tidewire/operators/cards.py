"""From report rows to cards: keyword rules, picks, parsing, clean-up and completeness."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import text as X
from tidewire.functions.timecols import recent
from tidewire.operators.ranking import first_per_group, first_rows_per_group, numbered_top, top_rows


def with_keyword_marks(rows: DataFrame, text: Column, conflict: Sequence[str], bang: Sequence[str],
                       insider: Sequence[str] = ()) -> DataFrame:
    return rows.withColumns({
        "has_conflict": X.contains_any(text, conflict),
        "has_bang": X.contains_any(text, bang),
        "has_insider": X.contains_any(text, insider),
    })


def without_routine_conflict(rows: DataFrame) -> DataFrame:
    """Drop rows with a conflict word, unless they also have a bang word or the insider mark."""
    return rows.filter(~F.col("has_conflict") | F.col("has_bang") | F.col("has_insider"))


def picks(rows: DataFrame, n: int = X.CARDS_PER_BRIEFING, group: str = "event_uri", key: str = "id",
          body: str = "body") -> DataFrame:
    """The rows to write cards for: one per event, the richest; bang words first, then by score."""
    distinct = first_rows_per_group(rows, [F.col(group)], [F.length(body)], key)
    order = [F.desc("has_bang"), F.desc("final_score_v2"), F.col(key)]
    return numbered_top(distinct, order, n, name="pick_no")


def candidates(rows: DataFrame, as_of: Column | datetime | str, width: int = 1000, cap: int = 60,
               hours: float = 24, order: Sequence[Column] | None = None) -> DataFrame:
    """Report rows of the trailing window with the body clipped, at most ``cap`` of them."""
    if not 0 < cap <= 60:
        raise ValueError("cap must be 1..60")
    order = order or [F.desc("final_score_v2"), F.col("id")]
    return top_rows(recent(rows, as_of, hours), order, cap).withColumn("body", X.clip(F.col("body"), width))


def above(rows: DataFrame, threshold: float = 0.6, score: str = "score") -> DataFrame:
    return rows.filter(F.col(score) > threshold)


def selected(candidate_rows: DataFrame, chosen: DataFrame, group: str) -> DataFrame:
    """Candidates named by position: ``chosen`` holds one array of 0-based indices per group."""
    named = chosen.select(group, F.posexplode("indices").alias("pick_pos", "position"))
    return candidate_rows.join(named, [group, "position"])


def parse_cards(briefings: DataFrame, key: str = "name", text: str = "text") -> DataFrame:
    """One row per topic of each briefing. The preamble before the first heading is dropped."""
    blocks = briefings.select(key, F.posexplode(X.topic_blocks(F.col(text))).alias("pos", "block"))
    parts = blocks.select(key, "pos", "block", X.labelled_parts(F.col("block")).alias("parts"))
    lines = parts.select(key, "pos", "block", *[c.alias(n) for n, c in X.card_texts(F.col("parts")).items()])
    fields = X.card_fields({n: F.col(n) for n in ("block", "lead", *X.LABELS)})
    return lines.select(key, "pos", *[c.alias(n) for n, c in fields.items()]).withColumn(
        "source_domain", F.coalesce(X.domain(F.col("source_url")), F.col("source")))


def clean_cards(cards: DataFrame, key: str = "name", summary: str = "content") -> DataFrame:
    """Fields clipped, tags repaired, then the first card of each (title, subtitle) per briefing."""
    clipped = cards.withColumns({
        "title": X.clip(F.col("title"), 8),
        "subtitle": X.clip(F.col("subtitle"), 12),
        summary: X.clip(F.col(summary), 200),
        "tags": X.tags_fixed(F.col("tags")),
    })
    return first_per_group(clipped, [key, "title", "subtitle"], [F.col("card_no"), F.col("pos")])


def with_local_fields(cards: DataFrame, logical_date: Column | str, media: Column, url: Column) -> DataFrame:
    """Date and source of a card as the pipeline knows them, whatever the text says."""
    day = logical_date if isinstance(logical_date, Column) else F.lit(logical_date)
    return cards.withColumns({"date": day.cast("date"), "source": X.media_and_url(media, url)})


def completeness(briefings: DataFrame, key: str = "name", text: str = "text") -> DataFrame:
    """The topic ranges that a briefing still lacks, one row per block of at most five."""
    last = briefings.select(key, X.last_topic_number(F.col(text)).alias("last_topic"))
    open_ones = last.filter(F.col("last_topic") < X.CARDS_PER_BRIEFING)
    return open_ones.select(key, "last_topic", F.inline(X.missing_ranges(F.col("last_topic"))))


def enough_cards(cards: DataFrame, key: str = "name", at_least: int = 5) -> DataFrame:
    """Briefings with the number of valid cards and whether that is enough."""
    valid = X.tags_valid(F.col("tags")) & F.col("title").isNotNull()
    counts = cards.groupBy(key).agg(F.count("*").alias("n_cards"), F.count_if(valid).alias("n_valid"))
    return counts.withColumn("is_enough", F.col("n_valid") >= at_least)


def prompts(reports: DataFrame, template: str, name: str = "name", text: str = "text") -> DataFrame:
    """The request text and input size for each report."""
    return reports.select(
        name, X.prompt(F.lit(template), F.col(name), F.col(text)).alias("prompt"),
        X.utf8_size(F.col(text)).alias("input_bytes"))
