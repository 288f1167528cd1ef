"""The score formulas, one column function each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.timecols import hours_between
from tidewire.params import ScoringParams


def number_or(value: Column, default: float) -> Column:
    """As a double; NULL, NaN and text that is no number give the default."""
    number = value.try_cast("double")
    return F.when(number.isNull() | F.isnan(number), F.lit(float(default))).otherwise(number)


def event_size(n: Column) -> Column:
    return number_or(n, 1.0)


def floor_zero(score: Column) -> Column:
    return F.greatest(F.coalesce(score, F.lit(0.0)), F.lit(0.0))


def hot_score(n: Column, entity_hot: Column, p: ScoringParams) -> Column:
    return F.log1p(event_size(n)) + F.lit(p.entity_coefficient) * F.log1p(entity_hot)


def authority_score(rank: Column, p: ScoringParams) -> Column:
    share = (F.lit(p.rank_base) - number_or(rank, p.rank_base)) / F.lit(p.rank_scale)
    return F.greatest(F.least(share, F.lit(1.0)), F.lit(0.0))


def sentiment_score(sentiment: Column, p: ScoringParams) -> Column:
    s = number_or(sentiment, 0.0)
    return F.abs(s) * F.when(s < 0, p.negative_sentiment_factor).otherwise(1.0)


def minmax(value: Column, low: Column, high: Column) -> Column:
    """Position between the batch extremes; a constant batch gives 0.5."""
    return F.when(low == high, F.lit(0.5)).otherwise((value - low) / (high - low))


def freshness_score(published_at: Column, as_of: Column, p: ScoringParams) -> Column:
    """Exponential decay with age. A publish time after ``as_of`` gives more than 1."""
    return F.exp(-hours_between(as_of, published_at) / F.lit(p.tau_hours))


def is_suppressed(routine: Column, breaking: Column) -> Column:
    return routine & ~breaking


def is_downweighted(category: Column, routine: Column) -> Column:
    return category & ~routine


def damping(suppressed: Column, downweighted: Column, p: ScoringParams) -> Column:
    return F.when(suppressed, p.routine_damping).when(downweighted, p.category_damping).otherwise(1.0)


def final_score(hot: Column, authority: Column, concept: Column, fresh: Column, sentiment: Column,
                p: ScoringParams) -> Column:
    return (
        hot * F.lit(p.weight_hot)
        + authority * F.lit(p.weight_authority)
        + concept * F.lit(p.weight_concept)
        + fresh * F.lit(p.weight_freshness)
        + sentiment * F.lit(p.weight_sentiment)
    )


def legacy_score(hot: Column, similarity: Column, published_at: Column, as_of: Column) -> Column:
    """Earlier formula: 0.4 hot + 0.4 topic similarity + 0.2 decay over 24 hours."""
    fresh = F.exp(-hours_between(as_of, published_at) / F.lit(24.0))
    return F.lit(0.4) * hot + F.lit(0.4) * similarity + F.lit(0.2) * fresh


def cosine(left: Column, right: Column) -> Column:
    """Cosine of two numeric arrays of one length; NULL if either has no length."""
    def dot(a: Column, b: Column) -> Column:
        products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)

    return F.try_divide(dot(left, right), F.sqrt(dot(left, left)) * F.sqrt(dot(right, right)))
