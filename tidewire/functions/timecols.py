"""Time columns: instants in, Beijing wall clock, logical dates and range predicates out.

The session zone must be UTC (``session.use_utc``). ``timestamp_ntz`` columns are read as UTC.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BEIJING = "Asia/Shanghai"


def instant(value: Column | datetime | str) -> Column:
    """A timestamp column from a column, a datetime (naive means UTC) or an ISO text."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, str):
        value = datetime.fromisoformat(value.replace("Z", "+00:00"))
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return F.lit(value)


def utc_to_bj(ts: Column) -> Column:
    return F.from_utc_timestamp(ts.cast("timestamp"), BEIJING)


def logical_date_bj(ts: Column, cutoff_hour: int = 6) -> Column:
    """Beijing date, where the hours before the cutoff still belong to the day before."""
    return F.to_date(utc_to_bj(ts) - F.make_dt_interval(hours=F.lit(cutoff_hour)))


def prev_logical_date_str(ts: Column, cutoff_hour: int = 6) -> Column:
    """Beijing calendar date minus one day. The cutoff is accepted and has no influence."""
    return F.date_format(F.date_sub(F.to_date(utc_to_bj(ts)), 1), "yyyy-MM-dd")


def now_prev_logical_date_str(as_of: Column | datetime | str, cutoff_hour: int = 6) -> Column:
    """The previous date as seen from ``as_of``, which stands for now."""
    return prev_logical_date_str(instant(as_of), cutoff_hour)


def logical_day_bounds(logical_date: date | str, cutoff_hour: int = 6) -> tuple[datetime, datetime]:
    """First instant of the logical day and of the next one, in UTC."""
    day = date.fromisoformat(logical_date) if isinstance(logical_date, str) else logical_date
    start = datetime.combine(day, time(cutoff_hour), ZoneInfo(BEIJING))
    end = datetime.combine(day + timedelta(days=1), time(cutoff_hour), ZoneInfo(BEIJING))
    return start.astimezone(timezone.utc), end.astimezone(timezone.utc)


def in_logical_day(df: DataFrame, column: str, logical_date: date | str, cutoff_hour: int = 6) -> Column:
    """Half-open range on the bare column, so that the scan can skip row groups."""
    start, end = (_like(df, column, t) for t in logical_day_bounds(logical_date, cutoff_hour))
    return (F.col(column) >= start) & (F.col(column) < end)


def since(df: DataFrame, column: str, as_of: Column | datetime | str, hours: float) -> Column:
    """Rows of the trailing window that ends at ``as_of``; the column itself stays bare."""
    span = F.make_dt_interval(secs=F.lit(hours * 3600.0))
    start = instant(as_of) - span
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        start = start.cast("timestamp_ntz")
    return F.col(column) >= start


def recent(df: DataFrame, as_of: Column | datetime | str, hours: float = 24) -> DataFrame:
    """Rows published in the trailing window.

    A stored ``logical_date`` is narrowed as well, so that a partitioned table opens few folders.
    Under any cutoff it is at most one day before the UTC date of the publish time.
    """
    rows = df.filter(since(df, "published_at", as_of, hours))
    if "logical_date" in df.columns:
        start = instant(as_of) - F.make_dt_interval(secs=F.lit(hours * 3600.0))
        rows = rows.filter(F.col("logical_date") >= F.date_sub(F.to_date(start), 1))
    return rows


def _like(df: DataFrame, column: str, value: datetime) -> Column:
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return F.lit(value)


def hours_between(later: Column, earlier: Column) -> Column:
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / F.lit(3_600_000_000.0)


def parse_publish_time(text: Column) -> Column:
    """ISO text to an instant, NULL if unreadable. No offset means UTC; given offsets are honoured."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))


def iso_text(ts: Column) -> Column:
    """ISO text of the instant on the Beijing wall clock, as the report prints it."""
    stamp = F.date_format(utc_to_bj(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(stamp, r"\.000000$", ""), F.lit("+08:00"))


def briefing_file_name(run_at: Column) -> Column:
    return F.concat(F.date_format(utc_to_bj(run_at), "yyyy-MM-dd_HH-mm-ss"), F.lit("_daily_briefing.md"))


def report_file_name(logical_date: Column, run_type: Column, run_at: Column) -> Column:
    return F.concat(
        F.lit("summary_"), logical_date.cast("string"), F.lit("_"), run_type, F.lit("_"),
        F.date_format(run_at.cast("timestamp"), "HH-mm-ss"), F.lit(".json"),
    )
