"""Popularity marts, user statistics, charts and listening patterns.

Each mart reads the plays once per grain it needs: windows become conditional sums, and
plays are counted per track before any dimension is joined.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.functions import measures as m
from earshot.functions import time as t
from earshot.functions.aggregates import count_where, top_by_count
from earshot.functions.text import label_count
from earshot.operators.filters import previous_window, since, trailing
from earshot.operators.grouping import (
    facet_counts,
    facet_size,
    facet_top,
    of_facet,
    ranked_labels,
    top_k,
)
from earshot.operators.joins import (
    join_albums,
    join_artists,
    join_tracks,
)
from earshot.operators.windows import share_of, streaks, top_rank
from earshot.plans.daily import taste_facets

Day = str | dt.date


def _window_counts(as_of: Day, days: int) -> list[Column]:
    ts = F.col("played_at")
    return [
        F.count(F.lit(1)).alias("total_plays"),
        count_where(since(ts, as_of, days)).alias("recent"),
        count_where(previous_window(ts, as_of, days)).alias("previous"),
    ]


def _stamp(run_ts: Column | None) -> Column:
    return (F.lit(None).cast("timestamp") if run_ts is None else run_ts).alias("last_updated")


def artist_popularity(
    plays: DataFrame,
    tracks: DataFrame,
    artists: DataFrame,
    as_of: Day,
    window_days: int = 30,
    run_ts: Column | None = None,
) -> DataFrame:
    """Plays, listeners, top track, growth and trending score per artist."""
    per_track = join_tracks(
        plays.groupBy("track_id").agg(*_window_counts(as_of, window_days)),
        tracks,
        "name",
        "artist_id",
    )
    totals = per_track.groupBy("artist_id").agg(
        F.sum("total_plays").alias("total_plays"),
        F.sum("recent").alias("recent"),
        F.sum("previous").alias("previous"),
        F.min_by(
            F.struct("track_id", "track_name"), F.struct(-F.col("total_plays"), "track_id")
        ).alias("top"),
    )
    pairs = plays.select("track_id", "user_id").distinct()
    listeners = (
        join_tracks(pairs, tracks, "artist_id")
        .groupBy("artist_id")
        .agg(F.count_distinct("user_id").alias("unique_listeners"))
    )
    growth = m.growth_percent(F.col("recent"), F.col("previous"))
    merged = totals.join(listeners, "artist_id")
    return join_artists(merged, artists, "name").select(
        "artist_id",
        "artist_name",
        "total_plays",
        "unique_listeners",
        F.col("top.track_id").alias("most_popular_track"),
        F.col("top.track_name").alias("most_popular_track_name"),
        F.col("recent").alias("plays_last_30_days"),
        F.col("previous").alias("plays_previous_30_days"),
        growth.alias("growth_percent"),
        m.artist_score(F.col("recent"), growth).alias("trending_score"),
        _stamp(run_ts),
    )


def track_popularity(
    plays: DataFrame,
    tracks: DataFrame,
    artists: DataFrame,
    as_of: Day,
    window_days: int = 30,
    run_ts: Column | None = None,
) -> DataFrame:
    """Plays, listeners, skips, completion, growth and trending score per track.

    A track's duration is the same for all its plays, so completion is averaged before the
    join and divided after it.
    """
    per_track = plays.groupBy("track_id").agg(
        *_window_counts(as_of, window_days),
        F.count_distinct("user_id").alias("unique_listeners"),
        F.avg(m.is_true(F.col("skipped")).cast("double")).alias("skip_rate"),
        F.avg("ms_played").alias("avg_ms"),
    )
    named = join_tracks(per_track, tracks, "name", "artist_id", "duration_ms")
    named = join_artists(
        named, artists, "name"
    ).withColumn(
        "avg_completion_rate",
        F.coalesce(m.completion_raw(F.col("avg_ms"), F.col("duration_ms")), F.lit(0.0)),
    )
    return named.select(
        "track_id",
        "track_name",
        "artist_id",
        "artist_name",
        "total_plays",
        "unique_listeners",
        "skip_rate",
        "avg_completion_rate",
        F.col("recent").alias("plays_last_30_days"),
        F.col("previous").alias("plays_previous_30_days"),
        m.growth_percent(F.col("recent"), F.col("previous")).alias("growth_percent"),
        m.track_score(
            F.col("recent"), F.col("skip_rate"), F.col("avg_completion_rate")
        ).alias("trending_score"),
        _stamp(run_ts),
    )


def recent_days(plays: DataFrame, as_of: Day, window_days: int) -> DataFrame:
    """Minutes per user and day since ``window_days`` before ``as_of``."""
    ts = F.col("played_at")
    return (
        plays.where(since(ts, as_of, window_days))
        .groupBy("user_id", t.to_day(ts).alias("activity_date"))
        .agg(F.sum("ms_played").alias("ms"))
        .select("user_id", "activity_date", m.minutes(F.col("ms")).alias("daily_minutes"))
    )


def listening_streaks(plays: DataFrame, as_of: Day, window_days: int = 30) -> DataFrame:
    """Runs of consecutive listening days per user; a user has at most one row per day."""
    return streaks(recent_days(plays, as_of, window_days), "user_id", "activity_date", as_of)


def user_listening_stats(
    plays: DataFrame,
    tracks: DataFrame,
    artists: DataFrame,
    as_of: Day,
    window_days: int = 30,
    run_ts: Column | None = None,
) -> DataFrame:
    """Totals, favourites, recent activity and current streak per user."""
    per_track = plays.groupBy("user_id", "track_id").agg(
        F.count(F.lit(1)).alias("plays"),
        F.sum("ms_played").alias("ms"),
        F.lit(1).cast("long").alias("tracks"),
    )
    days = recent_days(plays, as_of, window_days)
    return stats_of(per_track, days, tracks, artists, as_of, run_ts)


def stats_of(
    per_track: DataFrame,
    days: DataFrame,
    tracks: DataFrame,
    artists: DataFrame,
    as_of: Day,
    run_ts: Column | None = None,
) -> DataFrame:
    """User statistics of plays counted per track, and of the minutes of recent days."""
    additive = ["plays", "ms", "tracks"]
    facets = taste_facets(per_track, tracks, artists, ["user_id"], "plays", additive, per_track)
    totals = facets.groupBy("user_id").agg(
        *[F.sum(c).alias(c) for c in additive],
        facet_top("artist").alias("favorite_artist_id"),
        facet_top("genre").alias("favorite_genre"),
    )
    # One window over a user's days gives both the daily statistics and the streaks.
    order = W.partitionBy("user_id").orderBy("activity_date")
    islands = days.withColumn(
        "island", F.date_sub(F.col("activity_date"), F.row_number().over(order))
    )
    runs = islands.groupBy("user_id", "island").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("daily_minutes").alias("minutes"),
        F.max("activity_date").alias("last_day"),
    )
    activity = runs.groupBy("user_id").agg(
        F.sum("days").alias("active_days_last_month"),
        (F.sum("minutes") / F.sum("days")).alias("avg_daily_minutes"),
        F.max(F.when(F.col("last_day") == t.day(as_of, -1), F.col("days"))).alias("streak"),
    )
    return totals.join(activity, "user_id", "left").select(
        "user_id",
        F.col("tracks").alias("unique_tracks_played"),
        m.minutes(F.col("ms")).alias("total_minutes_played"),
        F.col("plays").alias("total_plays"),
        "favorite_artist_id",
        "favorite_genre",
        "active_days_last_month",
        "avg_daily_minutes",
        F.coalesce("streak", F.lit(0)).alias("listening_streak"),
        _stamp(run_ts),
    )


def top_tracks_weekly(
    history: DataFrame,
    tracks: DataFrame,
    artists: DataFrame,
    albums: DataFrame,
    as_of: Day,
    k: int = 100,
) -> DataFrame:
    """Chart of the seven days before ``as_of`` with the change to the week before."""
    ts = F.col("played_at")
    this_week, last_week = trailing(ts, as_of, 7), trailing(ts, as_of, 7, skip=7)
    per_track = (
        history.where(trailing(ts, as_of, 14))
        .groupBy("track_id")
        .agg(
            count_where(this_week).alias("play_count"),
            count_where(last_week).alias("prev"),
            F.count_distinct(F.when(this_week, F.col("user_id"))).alias("unique_listeners"),
            F.sum(F.when(this_week, F.col("ms_played"))).alias("ms"),
            F.avg(F.when(this_week, F.col("ms_played"))).alias("avg_ms"),
            count_where(this_week & m.is_true(F.col("skipped"))).alias("skips"),
        )
        .where(F.col("play_count") > 0)
    )
    named = join_tracks(
        per_track, tracks, "name", "artist_id", "album_id", "duration_ms"
    )
    named = join_artists(named, artists, "name")
    named = join_albums(named, albums, "name")
    completion = m.completion_raw(F.col("avg_ms"), F.col("duration_ms"))
    scored = named.withColumns(
        {
            "completion": completion,
            "score": m.weekly_score(F.col("play_count"), F.col("unique_listeners"), completion),
        }
    )
    return top_k(scored, "score", k, "track_id").select(
        "track_id",
        "track_name",
        "artist_name",
        "album_name",
        "play_count",
        "unique_listeners",
        m.minutes(F.col("ms")).alias("total_minutes_played"),
        m.pct(F.col("completion")).alias("completion_percentage"),
        m.pct(F.col("skips") / F.col("play_count")).alias("skip_percentage"),
        F.round("score", 2).alias("trending_score"),
        (F.col("play_count") - F.col("prev")).alias("weekly_change"),
        m.trend_label(F.col("play_count"), F.col("prev")).alias("trend_status"),
    )


def genre_preferences(
    history: DataFrame,
    artists: DataFrame,
    as_of: Day,
    window_days: int = 30,
    by_user: bool = False,
) -> DataFrame:
    """Plays per user and genre; plays are counted per artist before genres are unfolded.

    ``by_user`` shuffles a user's counted artists together, so that whatever groups or ranks
    the genres of a user afterwards needs no further shuffle.
    """
    recent = history.where(since(F.col("played_at"), as_of, window_days))
    per_artist = recent.groupBy("user_id", "artist_id").agg(F.count(F.lit(1)).alias("n"))
    counted = join_artists(per_artist, artists, "genres").select("user_id", "n", "genres")
    if by_user:
        counted = counted.repartition("user_id")
    return (
        counted.select("user_id", "n", F.explode("genres").alias("genre"))
        .groupBy("user_id", "genre")
        .agg(F.sum("n").alias("genre_plays"))
    )


def hour_share(history: DataFrame, as_of: Day, window_days: int = 30) -> DataFrame:
    """Share of a user's plays per hour of day (at most 24 rows per user)."""
    return _share(history, "hour_of_day", "hour", as_of, window_days)


def day_share(history: DataFrame, as_of: Day, window_days: int = 30) -> DataFrame:
    """Share of a user's plays per weekday (at most 7 rows per user)."""
    return _share(history, "day_of_week", "day", as_of, window_days)


def _share(history: DataFrame, column: str, label: str, as_of: Day, days: int) -> DataFrame:
    counted = (
        history.where(since(F.col("played_at"), as_of, days))
        .groupBy("user_id", column)
        .agg(F.count(F.lit(1)).alias(f"{label}_plays"))
    )
    return share_of(counted, ["user_id"], f"{label}_plays", f"{label}_percentage")


def user_listening_patterns(
    history: DataFrame,
    artists: DataFrame,
    users: DataFrame,
    as_of: Day,
    window_days: int = 30,
) -> DataFrame:
    """Activity, sessions, top genres, preferred daypart and listener type per user.

    Sessions, tracks, days, hours and weekdays are counted as facets of one pass.  Session
    averages are weighted by plays, as an average over plays joined to their session is.
    """
    recent = history.where(since(F.col("played_at"), as_of, window_days))
    # Plays that are alike in all facets are one row from here on.
    alike = recent.groupBy(
        "user_id",
        "session_id",
        "track_id",
        t.to_day(F.col("played_at")).alias("day"),
        "hour_of_day",
        "day_of_week",
    ).agg(
        F.count(F.lit(1)).alias("plays"),
        F.sum("ms_played").alias("ms_played"),
        F.sum("completion_rate").alias("completion_rate"),
        F.count("completion_rate").alias("completions"),
    )
    facets = facet_counts(
        alike,
        ["user_id"],
        {
            "session": F.col("session_id"),
            "track": F.col("track_id"),
            "day": F.col("day"),
            "hour": F.col("hour_of_day"),
            "weekday": F.col("day_of_week"),
        },
        weight=F.col("plays"),
        additive={
            "ms": F.col("ms_played"),
            "completion": F.col("completion_rate"),
            "completions": F.col("completions"),
        },
    )
    n, value = F.col("n"), F.col("value")
    session = of_facet("session")
    in_sessions = F.sum(F.when(session, n))

    def busiest(low: int, high: int) -> Column:
        hour = of_facet("hour") & value.try_cast("int").between(low, high)
        return F.coalesce(F.max(F.when(hour, n)), F.lit(0))

    def on_weekdays(*days: str) -> Column:
        return F.coalesce(F.sum(F.when(of_facet("weekday") & value.isin(*days), n)), F.lit(0))

    profile = facets.groupBy("user_id").agg(
        facet_size("day").alias("active_days"),
        facet_size("track").alias("unique_tracks"),
        F.try_divide(F.sum("completion"), F.sum("completions")).alias("avg_completion"),
        F.try_divide(F.sum(F.when(session, n * m.minutes(F.col("ms")))), in_sessions).alias(
            "avg_minutes"
        ),
        F.try_divide(F.sum(F.when(session, n * n)), in_sessions).alias("avg_tracks"),
        facet_size("session").alias("total_sessions"),
        busiest(5, 11).alias("morning"),
        busiest(12, 17).alias("afternoon"),
        busiest(18, 23).alias("evening"),
        busiest(0, 4).alias("night"),
        on_weekdays("1", "2", "3", "4", "5").alias("weekday_plays"),
        on_weekdays("0", "6").alias("weekend_plays"),
    )
    ranked = top_rank(
        genre_preferences(history, artists, as_of, window_days, by_user=True),
        ["user_id"],
        F.desc("genre_plays"),
        F.asc("genre"),
        k=3,
    )
    label = label_count(F.col("genre"), F.col("genre_plays"))
    genres = ranked_labels(ranked, "user_id", label, "rank", 3, "top_genres", ", ")
    people = users.select("user_id", "username", "country", "subscription_type")
    return (
        profile.join(genres, "user_id", "left").join(people, "user_id")
        .orderBy(F.desc("active_days"), F.desc("avg_minutes"), "user_id")
        .select(
            "user_id",
            "username",
            "country",
            "subscription_type",
            "active_days",
            "unique_tracks",
            m.pct(F.col("avg_completion")).alias("avg_completion_percentage"),
            F.round("avg_minutes", 2).alias("avg_session_minutes"),
            F.round("avg_tracks", 2).alias("avg_tracks_per_session"),
            "total_sessions",
            "top_genres",
            t.preferred_daypart(
                F.col("morning"), F.col("afternoon"), F.col("evening"), F.col("night")
            ).alias("preferred_time_of_day"),
            m.weekday_preference(F.col("weekday_plays"), F.col("weekend_plays")).alias(
                "weekday_weekend_preference"
            ),
            m.listener_type(F.col("avg_minutes"), F.col("active_days")).alias("listener_type"),
        )
    )


def top_artists(
    plays: DataFrame, tracks: DataFrame, artists: DataFrame, metric: str = "plays", k: int = 10
) -> DataFrame:
    """Top artists by plays or by listeners, grouped by name, so namesakes merge."""
    return _top_named(plays, tracks, artists, ["artist_name"], metric, k)


def top_tracks(
    plays: DataFrame, tracks: DataFrame, artists: DataFrame, metric: str = "plays", k: int = 10
) -> DataFrame:
    """Top tracks by plays or by listeners, grouped by track and artist name."""
    return _top_named(plays, tracks, artists, ["track_name", "artist_name"], metric, k)


def _top_named(
    plays: DataFrame, tracks: DataFrame, artists: DataFrame, names: list[str], metric: str, k: int
) -> DataFrame:
    if metric == "plays":
        rows = plays.groupBy("track_id").agg(F.count(F.lit(1)).alias("n"))
        measure = F.sum("n")
    elif metric == "listeners":
        rows = plays.select("track_id", "user_id").distinct()
        measure = F.count_distinct("user_id")
    else:
        raise ValueError(f"metric is 'plays' or 'listeners': {metric}")
    named = join_tracks(
        rows,
        tracks,
        "name",
        "artist_id",
    )
    named = join_artists(
        named, artists, "name"
    )
    return top_k(named.groupBy(*names).agg(measure.alias("metric")), "metric", k, *names)


def most_played_genre(plays: DataFrame, tracks: DataFrame, artists: DataFrame, key: str) -> DataFrame:
    """Genre with the most plays per value of ``key``, a small domain such as the hour."""
    per_track = plays.groupBy(key, "track_id").agg(F.count(F.lit(1)).alias("n"))
    tagged = join_tracks(per_track, tracks, "artist_id")
    tagged = join_artists(tagged, artists, "genres")
    return (
        tagged.select(key, "n", F.explode("genres").alias("genre"))
        .groupBy(key, "genre")
        .agg(F.sum("n").alias("n"))
        .groupBy(key)
        .agg(top_by_count(F.col("genre"), F.col("n")).alias("most_played_genre"))
    )
