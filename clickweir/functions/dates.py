"""Date and time column helpers; every conversion uses the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"
SUFFIX_FORMAT = "yyyyMMdd"
BATCH_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
BATCH_TIME_MILLIS_FORMAT = "yyyy/MM/dd HH:mm:ss:SSS"

NO_TIME = -1


def yesterday(fmt: str = DATE_FORMAT) -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), fmt)


def today() -> Column:
    """Today at midnight."""
    return F.current_date().cast("timestamp")


def is_valid_running_date(c: Column) -> Column:
    """Shape test ``dddd-dd-dd`` over the whole text; null and empty are invalid."""
    return F.coalesce(c.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), F.lit(False))


def text_to_millis(c: Column, fmt: str = DATE_FORMAT) -> Column:
    """Text to epoch millis; text that does not fit the pattern fails the query."""
    return F.unix_millis(F.to_timestamp(c, fmt))


def millis_to_text(c: Column, fmt: str = DATE_FORMAT) -> Column:
    return F.date_format(F.timestamp_millis(c), fmt)


def _server_millis(c: Column) -> Column:
    return (F.trim(c).try_cast("double") * 1000).try_cast("long")


def server_time_millis(c: Column) -> Column:
    """``seconds.millis`` text to truncated epoch millis, -1 when unparsable."""
    return F.coalesce(_server_millis(c), F.lit(NO_TIME).cast("long"))


def server_time(c: Column) -> Column:
    """``seconds.millis`` text to a timestamp, null when unparsable."""
    return F.timestamp_millis(_server_millis(c))


_PARTS = {
    "year": F.year,
    "season": F.quarter,
    "month": F.month,
    "week": F.weekofyear,  # ISO week
    "day": F.dayofmonth,
    "hour": F.hour,
}


def date_part(c: Column, part: str) -> Column:
    """One of year, season, month, week, day, hour of a timestamp."""
    if part not in _PARTS:
        raise ValueError(f"unknown date part: {part!r}")
    return _PARTS[part](c)


def first_day_of_week(c: Column) -> Column:
    """Sunday that starts the week of ``c``, at midnight."""
    day = F.to_date(c)
    return F.date_sub(day, F.dayofweek(day) - 1).cast("timestamp")


def first_day_of_month(c: Column) -> Column:
    return F.date_trunc("MONTH", c)


def _at_hour_of(day: Column, c: Column, keep_hour: bool) -> Column:
    midnight = day.cast("timestamp")
    return midnight + F.make_dt_interval(hours=F.hour(c)) if keep_hour else midnight


def first_day_of_previous_month(c: Column, keep_hour: bool = False) -> Column:
    return _at_hour_of(F.add_months(F.trunc(c, "MM"), -1), c, keep_hour)


def first_day_of_next_month(c: Column, keep_hour: bool = False) -> Column:
    return _at_hour_of(F.add_months(F.trunc(c, "MM"), 1), c, keep_hour)


def first_day_of_previous_week(c: Column, keep_hour: bool = False) -> Column:
    return _at_hour_of(F.date_sub(F.to_date(first_day_of_week(c)), 7), c, keep_hour)


def first_day_of_next_week(c: Column, keep_hour: bool = False) -> Column:
    return _at_hour_of(F.date_add(F.to_date(first_day_of_week(c)), 7), c, keep_hour)


def plus_days(c: Column, days: int) -> Column:
    """Midnight of the day ``days`` after (or before) ``c``."""
    return F.date_add(F.to_date(c), days).cast("timestamp")


def day_suffix(c: Column) -> Column:
    """``yyyyMMdd`` suffix of a per-day table name."""
    return F.date_format(F.to_date(c), SUFFIX_FORMAT)


def batch_time(fmt: str = BATCH_TIME_FORMAT) -> Column:
    return F.date_format(F.current_timestamp(), fmt)
