"""Scoring, ranking, de-duplication, reporting and monitoring of event-clustered news on Spark."""

from tidewire.functions.timecols import logical_date_bj, prev_logical_date_str, utc_to_bj
from tidewire.operators.report import daily_report
from tidewire.operators.scoring import score_articles
from tidewire.operators.select import attach_event_size, select_events
from tidewire.operators.tables import insert_new, upsert_latest
from tidewire.params import ReportParams, ScoringParams, SelectionParams
from tidewire.sources.files import build_digest

__all__ = [
    "ReportParams", "ScoringParams", "SelectionParams", "attach_event_size", "build_digest", "daily_report", "insert_new",
    "logical_date_bj", "prev_logical_date_str", "score_articles", "select_events", "upsert_latest", "utc_to_bj",
]
