"""Calendar and clock expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: str | dt.date) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def day(value: str | dt.date, offset: int = 0) -> Column:
    """Date literal ``value + offset`` days, folded before planning so it reaches the scan."""
    return F.lit(as_date(value) + dt.timedelta(days=offset))


def daypart_etl(ts: Column) -> Column:
    """morning 5-11, afternoon 12-16, evening 17-21, night otherwise."""
    hour = F.hour(ts)
    return (
        F.when(hour.between(5, 11), "morning")
        .when(hour.between(12, 16), "afternoon")
        .when(hour.between(17, 21), "evening")
        .otherwise("night")
    )


def daypart_report(hour: Column) -> Column:
    """morning 5-11, afternoon 12-17, evening 18-23, night 0-4."""
    return (
        F.when(hour.between(5, 11), "morning")
        .when(hour.between(12, 17), "afternoon")
        .when(hour.between(18, 23), "evening")
        .when(hour.between(0, 4), "night")
    )


# Report labels of the four dayparts.
DAYPART_LABELS = {
    "morning": "Morning (5AM-11AM)",
    "afternoon": "Afternoon (12PM-5PM)",
    "evening": "Evening (6PM-11PM)",
    "night": "Night (12AM-4AM)",
}


def preferred_daypart(morning: Column, afternoon: Column, evening: Column, night: Column) -> Column:
    """Label of the daypart that strictly beats every later one; night when none does."""
    return (
        F.when(morning > F.greatest(afternoon, evening, night), DAYPART_LABELS["morning"])
        .when(afternoon > F.greatest(evening, night), DAYPART_LABELS["afternoon"])
        .when(evening > night, DAYPART_LABELS["evening"])
        .otherwise(DAYPART_LABELS["night"])
    )


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def weekday_monday0(ts: Column) -> Column:
    return F.weekday(ts)


def weekday_sunday0(ts: Column) -> Column:
    return F.dayofweek(ts) - 1


def time_parts(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "day_of_week": weekday_monday0(ts),
    }


def to_day(ts: Column) -> Column:
    return F.to_date(ts)


def iso_date(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def day_offset(date: Column, days: int) -> Column:
    return F.date_add(date, days)


def week_start(date: Column) -> Column:
    """Monday of the week."""
    return F.trunc(date, "week")


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))


def parse_iso(text: Column, default_ts: Column | None = None) -> Column:
    """ISO-8601 text, with or without ``Z``; null (or the default) when unreadable.

    The leading date is required because Spark also reads words like ``now`` as timestamps.
    """
    parsed = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))
    return parsed if default_ts is None else F.coalesce(parsed, default_ts)
