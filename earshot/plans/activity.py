"""Active users, daily and hourly activity, summaries and leaderboards."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.functions import measures as m
from earshot.functions import time as t
from earshot.operators.filters import date_between, maybe_between, on_date
from earshot.operators.grouping import count_by, count_by_expr
from earshot.operators.joins import fill_spine, join_tracks
from earshot.operators.windows import centered_avg, rank_all

Day = str | dt.date
CHURN_DAYS = 30


def _bounds(d: Day, churn_days: int) -> tuple[dt.date, dt.date, dt.date]:
    """Monday of the week, first of the month, and first day any of the counts looks at."""
    d = t.as_date(d)
    monday = d - dt.timedelta(days=d.weekday())
    first = d.replace(day=1)
    return monday, first, min(monday, first, d - dt.timedelta(days=churn_days))


def _user_flags(plays: DataFrame, d: Day, churn_days: int) -> DataFrame:
    """Per user: active on the day, in its week, in its month, and in the days before it."""
    monday, first, earliest = _bounds(d, churn_days)
    ts = F.col("played_at")
    in_scope = plays.where(date_between(ts, earliest, d))

    def active(start: Day, end: Day) -> Column:
        return F.max(date_between(ts, start, end))

    before = t.as_date(d) - dt.timedelta(days=1)
    return in_scope.groupBy("user_id").agg(
        active(d, d).alias("today"),
        active(monday, d).alias("this_week"),
        active(first, d).alias("this_month"),
        active(t.as_date(d) - dt.timedelta(days=churn_days), before).alias("before"),
    )


def active_users(
    plays: DataFrame, users: DataFrame, day: Day, churn_days: int = CHURN_DAYS
) -> DataFrame:
    """Daily, weekly and monthly active users, new users and churned users of one day.

    One pass over the plays gives a flag row per user; new users are added as further rows.
    """
    flags = _user_flags(plays, day, churn_days).select(
        "today", "this_week", "this_month", "before", F.lit(False).alias("is_new")
    )
    fresh = new_users(users, day).select(
        *[F.lit(False).alias(c) for c in ("today", "this_week", "this_month", "before")],
        F.lit(True).alias("is_new"),
    )
    return flags.unionByName(fresh).agg(
        F.count_if("today").alias("count"),
        F.count_if("this_week").alias("weekly_active_count"),
        F.count_if("this_month").alias("monthly_active_count"),
        F.count_if("is_new").alias("new_users_count"),
        F.count_if(F.col("before") & ~F.col("today")).alias("churn_count"),
    ).select(t.day(day).alias("date"), "*")


def new_users(users: DataFrame, day: Day) -> DataFrame:
    return users.where(on_date(F.col("registered_on"), day)).select("user_id")


def churned_users(plays: DataFrame, day: Day, churn_days: int = CHURN_DAYS) -> DataFrame:
    """Users active in the days before ``day`` but not on it."""
    ts = F.col("played_at")
    start = t.as_date(day) - dt.timedelta(days=churn_days)
    before = plays.where(date_between(ts, start, t.as_date(day) - dt.timedelta(days=1)))
    today = plays.where(on_date(ts, day)).select("user_id").distinct()
    return before.select("user_id").distinct().join(today, "user_id", "left_anti")


def active_users_range(
    plays: DataFrame, users: DataFrame, start: Day, end: Day, churn_days: int = CHURN_DAYS
) -> DataFrame:
    """``active_users`` for every day of a range in one pass.

    Each distinct (user, day) is turned into a few signed steps on the calendar, and every
    count is a running sum of the steps, so no day is expanded into the windows it is in:
    a user enters the week's or month's count on the first active day in it, and is churned
    from the day after an active day until the next one, for at most ``churn_days``.
    """
    first_day, last_day = t.as_date(start), t.as_date(end)
    earliest = min(_bounds(first_day, churn_days)[2], first_day - dt.timedelta(days=churn_days))
    ts = F.col("played_at")
    days = (
        plays.where(date_between(ts, earliest, last_day))
        .select("user_id", t.to_day(ts).alias("d"))
        .distinct()
    )
    order = W.partitionBy("user_id").orderBy("d")
    seen = days.select(
        "d", F.lag("d").over(order).alias("prev"), F.lead("d").over(order).alias("next")
    )
    d, prev, following = F.col("d"), F.col("prev"), F.col("next")
    new_week = prev.isNull() | (prev < t.week_start(d))
    new_month = prev.isNull() | (prev < t.month_start(d))
    churn_end = F.least(
        F.coalesce(following, t.day_offset(d, churn_days + 1)), t.day_offset(d, churn_days + 1)
    )

    def step(at: Column, dau=0, week=0, month=0, churn=0) -> Column:
        values = {"dau": dau, "week": week, "month": month, "churn": churn, "fresh": 0}
        return F.struct(
            at.alias("date"), *[_long(v).alias(name) for name, v in values.items()]
        )

    steps = seen.select(
        F.inline(
            F.array(
                step(d, dau=1, week=new_week, month=new_month),
                step(t.day_offset(d, 1), churn=1),
                step(churn_end, churn=-1),
            )
        )
    )
    zeros = {c: F.lit(0).cast("long") for c in ("dau", "week", "month", "churn", "fresh")}
    registered = users.where(date_between(F.col("registered_on"), start, end)).select(
        F.to_date("registered_on").alias("date")
    )
    registered = registered.select("date", *[c.alias(n) for n, c in zeros.items()]).withColumn(
        "fresh", F.lit(1).cast("long")
    )
    spine = plays.sparkSession.range(1).select(
        F.explode(F.sequence(t.day(earliest), t.day(end))).alias("date"),
        *[c.alias(n) for n, c in zeros.items()],
    )
    # One row per calendar day from here on.
    daily = (
        steps.unionByName(registered)
        .unionByName(spine)
        .groupBy("date")
        .agg(*[F.sum(c).alias(c) for c in zeros])
        .where(F.col("date").between(t.day(earliest), t.day(end)))
    )

    def running(*scope: Column):
        return (
            W.partitionBy(*scope).orderBy("date").rowsBetween(W.unboundedPreceding, 0)
            if scope
            else W.partitionBy(F.lit(0)).orderBy("date").rowsBetween(W.unboundedPreceding, 0)
        )

    return daily.select(
        "date",
        F.col("dau").alias("count"),
        F.sum("week").over(running(t.week_start(F.col("date")))).alias("weekly_active_count"),
        F.sum("month").over(running(t.month_start(F.col("date")))).alias("monthly_active_count"),
        F.col("fresh").alias("new_users_count"),
        F.sum("churn").over(running()).alias("churn_count"),
    ).where(F.col("date").between(t.day(start), t.day(end)))


def _long(value) -> Column:
    return value.cast("long") if isinstance(value, Column) else F.lit(value).cast("long")


def daily_activity(plays: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """Plays per day, optionally of a date range."""
    scoped = maybe_between(plays, start, end)
    return count_by_expr(scoped, "play_count", date=t.to_day(F.col("played_at"))).orderBy("date")


def hourly_distribution(plays: DataFrame) -> DataFrame:
    """Plays per hour of day, all 24 hours, with a centred three-point trend."""
    hours = count_by_expr(plays, "play_count", hour=F.hour("played_at"))
    return centered_avg(fill_spine(hours, "hour", 0, 23), "hour", "play_count", 3, "trend").orderBy(
        "hour"
    )


def user_activity_summary(users: DataFrame, plays: DataFrame) -> DataFrame:
    """Every user with streams, distinct tracks, active days and last activity."""
    per_track = plays.groupBy("user_id", "track_id").agg(
        F.count("event_id").alias("streams"),
        # Days are bounded by the calendar.
        F.collect_set(t.to_day(F.col("played_at"))).alias("days"),
        F.max("played_at").alias("last_active"),
    )
    per_user = per_track.groupBy("user_id").agg(
        F.sum("streams").alias("total_streams"),
        F.count("track_id").alias("unique_tracks"),
        F.size(F.array_distinct(F.flatten(F.collect_set("days")))).cast("long").alias("active_days"),
        F.max("last_active").alias("last_active"),
    )
    counts = ("total_streams", "unique_tracks", "active_days")
    return (
        users.select("user_id", "username", "country")
        .join(per_user, "user_id", "left")
        .select(
            "user_id",
            "username",
            "country",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
            "last_active",
        )
    )


def artist_daily_stats(enriched: DataFrame, tracks: DataFrame) -> DataFrame:
    """Streams and listeners per artist and day."""
    counted = count_by(enriched, ["date", "track_id", "user_id"], "streams")
    return join_tracks(counted, tracks, "artist_id").groupBy("date", "artist_id").agg(
        F.sum("streams").alias("total_streams"),
        F.count_distinct("user_id").alias("unique_listeners"),
    )


def daily_leaderboard(daily_stats: DataFrame, key: str) -> DataFrame:
    """All tracks or artists of each day ranked by streams, ties by key."""
    rows = daily_stats.select("date", key, "total_streams", "unique_listeners")
    return rank_all(rows, ["date"], "total_streams", key)


def generate_analytics(history: DataFrame, as_of: Day) -> DataFrame:
    """Distinct tracks, minutes and plays per user since the day before ``as_of``."""
    ts = F.col("played_at")
    return (
        history.where(ts >= t.day(as_of, -1))
        .groupBy("user_id")
        .agg(
            F.count_distinct("track_id").alias("unique_tracks_played"),
            m.minutes(F.sum("ms_played")).alias("total_minutes_played"),
            F.count(F.lit(1)).alias("total_plays"),
        )
    )
