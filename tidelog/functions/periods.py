"""Time buckets: day, hour, ISO week and year-week labels.

All formatting follows the session time zone (pinned by
``tidelog.session.configure_session``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FORMAT = "yyyy-MM-dd"
HOUR_FORMAT = "HH"
YEAR_WEEK_MODES = ("calendar", "iso")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_bucket(ts: Column | str) -> Column:
    return F.date_format(_col(ts), DAY_FORMAT)


def hour_bucket(ts: Column | str) -> Column:
    return F.date_format(_col(ts), HOUR_FORMAT)


def week_bucket(ts: Column | str) -> Column:
    """ISO-8601 week number (1-53) as INT."""
    return F.weekofyear(_col(ts))


def year_week(ts: Column | str, mode: str = "calendar") -> Column:
    """``'YYYY-WW'`` label; NULL when the time is NULL.

    ``calendar`` pairs the calendar year with the ISO week, so the last days
    of December can land in week ``01`` of the same year (2024-12-30 ->
    ``2024-01``), merging two different weeks.  ``iso`` pairs the ISO week
    with its own week-based year (2024-12-30 -> ``2025-01``).
    """
    ts = _col(ts)
    if mode == "calendar":
        year = F.year(ts)
    elif mode == "iso":
        year = F.extract(F.lit("YEAROFWEEK"), ts)
    else:
        raise ValueError(f"year_week mode must be one of {YEAR_WEEK_MODES}, got {mode!r}")
    week = F.lpad(F.weekofyear(ts).cast("string"), 2, "0")
    return F.concat(year.cast("string"), F.lit("-"), week)


def year_week_of_day(day: Column | str, mode: str = "calendar") -> Column:
    """Year-week label of a ``process_date`` string.

    A day maps to exactly one year-week, so weekly counts can be rolled up
    from daily counts instead of re-scanning the logs.
    """
    return year_week(F.try_to_date(_col(day), DAY_FORMAT), mode)
