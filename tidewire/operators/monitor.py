"""Monitoring queries over scored articles."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewire.functions import text as X
from tidewire.functions.timecols import logical_date_bj, recent
from tidewire.operators.ranking import top_rows

# The labels of the topic class report.
ROUTINE_QUIET = "常规话题(非爆点)"
ROUTINE_BREAKING = "常规话题(爆点)"
CATEGORY = "领域话题"
OTHER = "其他话题"


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with 2 places; NULL if there is nothing to divide by."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), 2)


def column_stats(scored: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per score column: minimum, maximum and mean, from one pass."""
    wide = scored.agg(*[f(n).alias(f"{s}_{n}") for n in names
                        for s, f in (("min", F.min), ("max", F.max), ("avg", F.avg))])
    rows = [F.struct(F.lit(n).alias("column_name"), F.col(f"min_{n}").alias("min_value"),
                     F.col(f"max_{n}").alias("max_value"), F.col(f"avg_{n}").alias("avg_value")) for n in names]
    return wide.select(F.inline(F.array(*rows)))


def batch_suppression(scored: DataFrame) -> DataFrame:
    """What one scoring run damped. An empty run counts 0 percent."""
    counts = scored.agg(
        F.count("*").alias("total"),
        F.count_if("is_suppressed").alias("suppressed"),
        F.count_if("is_downweighted").alias("downweighted"),
        F.count_if(F.col("is_routine_topic") & F.col("is_breaking_news")).alias("breaking_exempted"),
    )
    return counts.withColumns({
        "suppressed_pct": F.coalesce(percent(F.col("suppressed"), F.col("total")), F.lit(0.0)),
        "downweighted_pct": F.coalesce(percent(F.col("downweighted"), F.col("total")), F.lit(0.0)),
    })


def flag_counts() -> list[Column]:
    """Counts of articles per flag."""
    return [
        F.count("*").alias("total_articles"),
        F.count_if("is_routine_topic").alias("routine_topic_articles"),
        F.count_if("is_category_topic").alias("category_topic_articles"),
        F.count_if("is_breaking_news").alias("breaking_news_articles"),
        F.count_if("is_suppressed").alias("suppressed_articles"),
        F.count_if("is_downweighted").alias("downweighted_articles"),
    ]


def with_rates(counts: DataFrame) -> DataFrame:
    return counts.withColumns({
        "suppression_rate": percent(F.col("suppressed_articles"), F.col("total_articles")),
        "downweight_rate": percent(F.col("downweighted_articles"), F.col("total_articles")),
    })


def suppression_monitor(scored: DataFrame, as_of: Column | datetime | str, hours: float = 24) -> DataFrame:
    """Flag counts and rates of the trailing window."""
    rows = recent(scored, as_of, hours)
    return with_rates(rows.agg(*flag_counts())).withColumnRenamed("total_articles", "total_articles_24h")


def suppression_summary(scored: DataFrame, as_of: Column | datetime | str, hours: float = 24) -> DataFrame:
    """The short form: three counts and one rate."""
    rows = recent(scored, as_of, hours)
    counts = rows.agg(
        F.count("*").alias("total_articles"),
        F.count_if("is_suppressed").alias("suppressed_count"),
        F.count_if("is_downweighted").alias("downweighted_count"),
    )
    return counts.withColumn("suppression_rate", percent(F.col("suppressed_count"), F.col("total_articles")))


def score_distribution(scored: DataFrame, as_of: Column | datetime | str, hours: float = 24,
                       high: float = 0.6) -> DataFrame:
    rows = recent(scored, as_of, hours).filter(F.col("final_score_v2").isNotNull())
    return rows.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("final_score_v2") >= high).alias("high_score_records"),
        F.avg("final_score_v2").alias("avg_score"),
    )


def topic_class() -> Column:
    routine, breaking = F.col("is_routine_topic"), F.col("is_breaking_news")
    return (
        F.when(routine & ~breaking, ROUTINE_QUIET)
        .when(routine & breaking, ROUTINE_BREAKING)
        .when(F.col("is_category_topic"), CATEGORY)
        .otherwise(OTHER)
    )


def topic_class_distribution(scored: DataFrame, as_of: Column | datetime | str, hours: float = 24) -> DataFrame:
    rows = recent(scored, as_of, hours)
    return rows.groupBy(topic_class().alias("topic_category")).agg(
        F.count("*").alias("article_count"),
        F.avg("final_score_v2").alias("avg_final_score"),
        F.avg("hot_norm").alias("avg_hot_norm"),
    ).orderBy(F.desc("article_count"), "topic_category")


def suppression_trend(scored: DataFrame, cutoff_hour: int = 6) -> DataFrame:
    """Flag counts and rates per logical date."""
    dated = scored.withColumn("logical_date", logical_date_bj(F.col("published_at"), cutoff_hour))
    return with_rates(dated.groupBy("logical_date").agg(*flag_counts()))


def suppression_by_source(scored: DataFrame) -> DataFrame:
    return with_rates(scored.groupBy("source_name").agg(*flag_counts()))


def damping_effect(scored: DataFrame) -> DataFrame:
    """Mean hot norm before and after damping, per topic class."""
    return scored.groupBy(topic_class().alias("topic_category")).agg(
        F.count("*").alias("article_count"),
        F.avg("hot_norm_raw").alias("avg_before"),
        F.avg("hot_norm").alias("avg_after"),
        F.avg(F.col("hot_norm_raw") - F.col("hot_norm")).alias("avg_loss"),
    )


def treatment() -> Column:
    return F.when(F.col("is_suppressed"), "suppressed").when(F.col("is_downweighted"), "downweighted").otherwise("untouched")


def quality_by_treatment(scored: DataFrame, high: float = 0.6) -> DataFrame:
    """Authority and final score of damped and untouched articles."""
    return scored.groupBy(treatment().alias("treatment")).agg(
        F.count("*").alias("article_count"),
        F.avg("rep_norm").alias("avg_authority"),
        F.avg("final_score_v2").alias("avg_final_score"),
        F.count_if(F.col("final_score_v2") >= high).alias("high_score_records"),
    )


def affected_articles(scored: DataFrame, as_of: Column | datetime | str, hours: float = 24, n: int = 20) -> DataFrame:
    """The newest damped articles of the trailing window."""
    hit = recent(scored, as_of, hours).filter(F.col("is_suppressed") | F.col("is_downweighted"))
    return top_rows(hit, [F.desc("published_at"), F.col("id")], n)


def top_articles(scored: DataFrame, n: int = 5, width: int = 50) -> DataFrame:
    """The best articles. Without a title in ``scored`` the caller joins it to the few rows left."""
    rows = top_rows(scored.filter(F.col("final_score_v2").isNotNull()),
                    [F.desc("final_score_v2"), F.col("id")], n)
    return rows.withColumn("title_snippet", F.left("title", F.lit(width))) if "title" in rows.columns else rows


def top_concepts(trending: DataFrame, n: int = 10) -> DataFrame:
    return top_rows(trending, [F.desc("score"), F.col("uri")], n)


def run_metrics(candidates: DataFrame, cards: DataFrame, wanted: int = 10, dry_run: bool = False,
                fallback_used: bool = False, last_error: str = "") -> DataFrame:
    """One row for the run: candidates, cards, is the set complete, and the switches of the run."""
    counts = candidates.select(F.lit(1).alias("c"), F.lit(0).alias("k")).unionByName(
        cards.select(F.lit(0).alias("c"), F.lit(1).alias("k")))
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n_candidates"),
                        F.coalesce(F.sum("k"), F.lit(0)).alias("n_cards"))
    return totals.select(
        "n_candidates", "n_cards", (F.col("n_cards") >= wanted).alias("is_complete"),
        F.lit(dry_run).alias("dry_run"), F.lit(fallback_used).alias("fallback_used"),
        F.lit(last_error).alias("last_error"),
        F.lit(not dry_run and not fallback_used and not last_error).alias("schema_validated"),
    )


class ObservedRun:
    """Metrics of a briefing run, counted while its tables are written, so that nothing is read again for them.

    Each method returns its table with an observation; the observed tables must be written once before ``metrics``.
    """

    def __init__(self, bytes_per_token: float = 4.0):
        self.bytes_per_token = bytes_per_token
        self.parts = {name: Observation(name) for name in ("candidates", "prompts", "briefings", "cards")}

    def candidates(self, rows: DataFrame, on_day: Column) -> DataFrame:
        """Report rows; those that are not ``on_day`` come from another report, which stands in for that of the day."""
        return rows.observe(self.parts["candidates"], F.count("*").alias("n_candidates"),
                            F.coalesce(F.bool_or(~on_day), F.lit(False)).alias("fallback_used"))

    def prompts(self, rows: DataFrame, prompt: Column) -> DataFrame:
        return rows.observe(self.parts["prompts"], F.count("*").alias("n_prompts"),
                            F.coalesce(F.sum(X.utf8_size(prompt)), F.lit(0)).alias("prompt_bytes"))

    def briefings(self, rows: DataFrame, text: Column) -> DataFrame:
        """Answers; each block of topics that one lacks is asked for again."""
        again = F.coalesce(F.size(X.missing_ranges(X.last_topic_number(text))), F.lit(0))
        return rows.observe(self.parts["briefings"], F.count("*").alias("n_briefings"),
                            F.coalesce(F.sum(F.greatest(again, F.lit(0))), F.lit(0)).alias("retries"),
                            F.coalesce(F.bool_and(again <= 0), F.lit(False)).alias("is_complete"))

    def cards(self, rows: DataFrame, valid: Column) -> DataFrame:
        return rows.observe(self.parts["cards"], F.count("*").alias("n_cards"),
                            F.coalesce(F.bool_and(valid), F.lit(False)).alias("schema_validated"))

    def metrics(self, spark: SparkSession) -> DataFrame:
        """One row of what was observed; waits for the writes of all four tables."""
        found = {name: value for part in self.parts.values() for name, value in part.get.items()}
        found["token_estimate"] = math.ceil(found["prompt_bytes"] / self.bytes_per_token)
        found["dry_run"] = found["n_prompts"] > 0 and found["n_briefings"] == 0
        return spark.range(1).select(*[F.lit(v).alias(n) for n, v in sorted(found.items())])
