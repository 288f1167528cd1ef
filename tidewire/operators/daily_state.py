"""Monitoring from a small state: partial counts and sums per date, added by each scoring run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.timecols import logical_date_bj
from tidewire.operators.monitor import flag_counts, topic_class, treatment, with_rates

HIGH_SCORE = 0.6
KEYS = ["logical_date", "source_name", "topic_category", "treatment"]
# What is averaged: a sum and the number of its values.
AVERAGED = {"authority": "rep_norm", "final_score": "final_score_v2", "before": "hot_norm_raw", "after": "hot_norm"}
COUNTS = ["total_articles", "routine_topic_articles", "category_topic_articles", "breaking_news_articles",
          "suppressed_articles", "downweighted_articles", "high_score_records"]
STATE = T.StructType([
    T.StructField("logical_date", T.DateType()), *[T.StructField(k, T.StringType()) for k in KEYS[1:]],
    *[T.StructField(c, T.LongType()) for c in COUNTS],
    *[T.StructField(f"{part}_{a}", kind) for a in AVERAGED for part, kind in (("n", T.LongType()), ("sum", T.DoubleType()))]])


def partials(scored: DataFrame, cutoff_hour: int = 6, sign: int = 1) -> DataFrame:
    """Counts and sums of some scored rows per date, source, topic class and treatment.

    Rows of earlier dates that arrive late give more partials of their date. With ``sign`` -1 the rows are taken back:
    a correction is what was counted, taken back, and what is right, added.
    """
    keyed = scored.withColumns({
        "logical_date": logical_date_bj(F.col("published_at"), cutoff_hour), "topic_category": topic_class(),
        "treatment": treatment()})
    sums = [column for a, name in AVERAGED.items() for column in (F.count(name).alias(f"n_{a}"), F.sum(name).alias(f"sum_{a}"))]
    high = F.count_if(F.col("final_score_v2") >= HIGH_SCORE).alias("high_score_records")
    added = keyed.groupBy(*KEYS).agg(*flag_counts(), high, *sums)
    return added.select(*KEYS, *[(sign * F.col(f.name)).cast(f.dataType).alias(f.name) for f in STATE.fields[len(KEYS):]])


def merged(state: DataFrame, by: list[str]) -> DataFrame:
    """The state added up; groups of which everything was taken back are gone."""
    sums = [F.sum(f.name).alias(f.name) for f in STATE.fields[len(KEYS):]]
    return state.groupBy(*by).agg(*sums).filter("total_articles <> 0")


def compacted(state: DataFrame) -> DataFrame:
    """One row per group, to take the place of the rows of many runs."""
    return merged(state, KEYS).select(STATE.fieldNames())


def mean(name: str) -> Column:
    return F.try_divide(f"sum_{name}", f"n_{name}")


def trend(state: DataFrame) -> DataFrame:
    """As ``monitor.suppression_trend``."""
    return with_rates(merged(state, ["logical_date"]).select("logical_date", *COUNTS[:-1]))


def by_source(state: DataFrame) -> DataFrame:
    """As ``monitor.suppression_by_source``."""
    return with_rates(merged(state, ["source_name"]).select("source_name", *COUNTS[:-1]))


def effect(state: DataFrame) -> DataFrame:
    """As ``monitor.damping_effect``."""
    return merged(state, ["topic_category"]).select(
        "topic_category", F.col("total_articles").alias("article_count"), mean("before").alias("avg_before"),
        mean("after").alias("avg_after"), (mean("before") - mean("after")).alias("avg_loss"))


def quality(state: DataFrame) -> DataFrame:
    """As ``monitor.quality_by_treatment``."""
    return merged(state, ["treatment"]).select(
        "treatment", F.col("total_articles").alias("article_count"), mean("authority").alias("avg_authority"),
        mean("final_score").alias("avg_final_score"), "high_score_records")
