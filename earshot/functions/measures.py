"""Scalar measures of a play: completion, minutes, growth, scores and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Assumed track length, skip and completion limits, score weights, label limits.
ASSUMED_TRACK_MS = 180000.0
SKIP_BELOW = 0.3
COMPLETED_FROM = 0.9
ARTIST_WEIGHTS = {"recent": 0.7, "growth": 0.3}
TRACK_WEIGHTS = {"recent": 0.6, "kept": 0.2, "completion": 0.2}
WEEKLY_WEIGHTS = {"plays": 0.4, "listeners": 0.3, "completion": 0.3}
TRENDING_UP_PERCENT = 50
FALLING_PERCENT = -30


def _d(column: Column) -> Column:
    return column.cast("double")


def completion_fixed(ms: Column) -> Column:
    """Share of an assumed three-minute track, capped at 1; null when ``ms`` is null."""
    return F.when(ms.isNotNull(), F.least(F.lit(1.0), _d(ms) / ASSUMED_TRACK_MS))


def completion_capped(ms: Column, duration: Column) -> Column:
    """Share of the real duration, capped at 1; 0 when the duration is missing or not positive."""
    share = F.least(F.lit(1.0), F.try_divide(_d(ms), _d(duration)))
    return F.when(duration > 0, share).otherwise(F.lit(0.0))


def completion_raw(ms: Column, duration: Column) -> Column:
    """Uncapped share of the real duration; null for a zero duration."""
    return F.try_divide(_d(ms), _d(duration))


def completed_flag(ms: Column, duration: Column) -> Column:
    return F.coalesce(ms >= duration * COMPLETED_FROM, F.lit(False))


def minutes(ms: Column) -> Column:
    return _d(ms) / 60000.0


def pct(ratio: Column, scale: int = 2) -> Column:
    return F.round(ratio * 100, scale)


def cap(value: Column, high: float) -> Column:
    return F.when(value.isNotNull(), F.least(value, F.lit(high)))


def floor_div(a: Column, b: Column) -> Column:
    """Floor division, 0 when the divisor is not positive."""
    return F.when(b > 0, F.floor(a / b)).otherwise(0).cast("long")


def is_true(flag: Column) -> Column:
    """Null counts as false."""
    return F.coalesce(flag, F.lit(False))


def non_empty(array: Column) -> Column:
    return array.isNotNull() & (F.size(array) > 0)


def with_default(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def growth_percent(current: Column, previous: Column) -> Column:
    """Relative change in percent, 0 when there is no previous value."""
    change = F.try_divide(_d(current - previous), _d(previous)) * 100
    return F.when(previous == 0, F.lit(0.0)).otherwise(change)


def trend_label(current: Column, previous: Column) -> Column:
    change = growth_percent(current, previous)
    return (
        F.when(previous.isNull() | (previous == 0), "New")
        .when(change >= TRENDING_UP_PERCENT, "Trending Up")
        .when(change <= FALLING_PERCENT, "Falling")
        .otherwise("Stable")
    )


def artist_score(recent: Column, growth: Column) -> Column:
    return recent * ARTIST_WEIGHTS["recent"] + growth * ARTIST_WEIGHTS["growth"]


def track_score(recent: Column, skip_rate: Column, completion: Column) -> Column:
    return (
        recent * TRACK_WEIGHTS["recent"]
        + (1 - skip_rate) * 100 * TRACK_WEIGHTS["kept"]
        + completion * 100 * TRACK_WEIGHTS["completion"]
    )


def weekly_score(plays: Column, listeners: Column, completion: Column) -> Column:
    return (
        plays * WEEKLY_WEIGHTS["plays"]
        + listeners * WEEKLY_WEIGHTS["listeners"]
        + completion * 100 * WEEKLY_WEIGHTS["completion"]
    )


# Labels of the listening patterns.
LISTENER_LABELS = ("Heavy Listener", "Regular Listener", "Casual Listener", "Mixed Pattern")
WEEK_LABELS = ("Weekday Listener", "Weekend Listener")


def listener_type(avg_minutes: Column, active_days: Column) -> Column:
    heavy, regular, casual, mixed = LISTENER_LABELS
    return (
        F.when((avg_minutes > 60) & (active_days > 20), heavy)
        .when(avg_minutes.between(30, 60) & active_days.between(10, 20), regular)
        .when((avg_minutes < 30) & (active_days < 10), casual)
        .otherwise(mixed)
    )


def weekday_preference(weekday_plays: Column, weekend_plays: Column) -> Column:
    on_days, at_weekends = WEEK_LABELS
    return F.when(weekday_plays > weekend_plays, on_days).otherwise(at_weekends)
