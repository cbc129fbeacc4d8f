"""Time expressions on TIMESTAMP_NTZ columns.

All arithmetic stays in wall-clock (NTZ) terms so results do not depend on
the session time zone.
"""
from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def hour_floor(ts: str | Column) -> Column:
    """Truncate to the hour, keeping TIMESTAMP_NTZ (``date_trunc`` would
    return a zoned TIMESTAMP)."""
    c = _col(ts)
    return F.make_timestamp_ntz(
        F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0)
    )


def add_hours(ts: str | Column, hours: int | Column) -> Column:
    amount = hours if isinstance(hours, Column) else F.lit(int(hours))
    return F.timestamp_add("HOUR", amount, _col(ts))


def add_seconds(ts: str | Column, seconds: int | Column) -> Column:
    amount = seconds if isinstance(seconds, Column) else F.lit(int(seconds))
    return F.timestamp_add("SECOND", amount, _col(ts))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from ``start`` to ``end``, cut toward zero."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def ntz_literal(value: datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal that is independent of the session zone."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")


def iso_weekday(ts: str | Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(_col(ts)) + 1


def calendar_columns(ts: str | Column = "timestamp") -> dict[str, Column]:
    """hour, ISO weekday, day of month, month and weekend flag as TINYINT."""
    c = _col(ts)
    weekday = iso_weekday(c)
    return {
        "hour": F.hour(c).cast("tinyint"),
        "day_of_week": weekday.cast("tinyint"),
        "day_of_month": F.dayofmonth(c).cast("tinyint"),
        "month": F.month(c).cast("tinyint"),
        "is_weekend": (weekday >= 6).cast("tinyint"),
    }
