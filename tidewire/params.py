"""Run parameters. Each class is the typed form of one group of settings."""

from __future__ import annotations

import contextlib
import json
import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass

DEFAULT_CUTOFF_HOUR = 6


def uri_list(value: object) -> tuple[str, ...]:
    """A configured uri list; anything that is not a list, tuple or set counts as empty."""
    if isinstance(value, (list, tuple, set, frozenset)):
        return tuple(sorted(set(value)))
    return ()


def unusual_uris(uris: Sequence[str]) -> list[str]:
    """Entries that can never match because of stray white space or a missing comma between two."""
    return [u for u in uris if u != u.strip() or "\t" in u or u.count("://") > 1]


@dataclass(frozen=True)
class ScoringParams:
    tau_hours: float = 6.0
    weight_hot: float = 0.35
    weight_authority: float = 0.25
    weight_concept: float = 0.20
    weight_freshness: float = 0.15
    weight_sentiment: float = 0.05
    entity_coefficient: float = 0.3
    negative_sentiment_factor: float = 1.25
    rank_base: int = 1_000_001
    rank_scale: float = 1_000_000.0
    routine_uris: Sequence[str] | None = ()
    category_uris: Sequence[str] | None = ()
    routine_damping: float = 0.3
    category_damping: float = 0.5
    breaking_threshold: float = 0.8
    trending_max_age_hours: float | None = None


@dataclass(frozen=True)
class SelectionParams:
    language: str = "eng"
    min_articles: int = 3
    lookback_hours: int = 24
    popular_limit: int = 30
    breaking_limit: int = 20
    breaking_hours: int = 6
    articles_per_event: int = 1
    trending_types: tuple[str, ...] = ("person", "org", "loc")
    trending_count: int = 200


@dataclass(frozen=True)
class ReportParams:
    cutoff_hour: int = DEFAULT_CUTOFF_HOUR
    per_event: int = 2
    limit: int | None = None
    score_digits: int = 4
    data_source: str = "article scores"


# The names of the two settings that runs are configured by.
CUTOFF_SETTING, CUTOFF_VARIABLE = "bj_cutoff_hour", "BJ_CUTOFF_HOUR"


def parsed(value: object, parse: Callable[[object], object], default: object) -> object:
    """A setting in its type; a value that cannot be read counts as the default."""
    try:
        return parse(value)
    except (TypeError, ValueError):
        return default


def _hour(value: object) -> int:
    hour = int(value)
    if hour not in range(24):
        raise ValueError(f"no hour of the day: {hour}")
    return hour


def cutoff_hour(getter: Callable[[str], object] | None = None) -> int:
    """Beijing day boundary: what the getter says, else the environment, else 6. A getter may fail."""
    said = None
    with contextlib.suppress(Exception):
        said = getter(CUTOFF_SETTING) if getter else None
    return parsed(os.environ.get(CUTOFF_VARIABLE) if said is None else said, _hour, DEFAULT_CUTOFF_HOUR)


def whitelist_setting(enabled_text: str | None, trusted_text: str | None) -> tuple[bool, list[str]]:
    """(use the whitelist, trusted source names) from two JSON texts.

    The switch is on unless it reads as off; it takes a list with names to be used.
    """
    on = parsed((enabled_text or "true").lower(), json.loads, True)
    names = parsed(trusted_text, json.loads, [])
    used = bool(on) and isinstance(names, list) and len(names) > 0
    return used, names if used else []
