"""Enriched plays and the daily user and track statistics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions import measures as m
from earshot.functions import time as t
from earshot.functions.aggregates import avg_or_zero, count_where, daypart_counts, sum_where
from earshot.operators.filters import date_between
from earshot.operators.grouping import (
    allocate,
    facet_counts,
    facet_map,
    facet_size,
    facet_top,
    top_n_string,
)
from earshot.operators.joins import (
    join_albums,
    join_artists,
    join_tracks,
)

Day = str | dt.date

ENRICHED = [
    "event_id",
    "user_id",
    "track_id",
    "timestamp",
    "date",
    "year",
    "month",
    "day",
    "hour",
    "ms_played",
    "reason_start",
    "reason_end",
    "shuffle",
    "skipped",
    "platform",
    "country",
    "time_of_day",
    "is_weekend",
    "completion_ratio",
    "processed_at",
]

DAYPART_TRACKS = [f"{p}_tracks" for p in ("morning", "afternoon", "evening", "night")]


def enrich_history(plays: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Calendar parts, daypart, weekend flag and completion ratio of each play."""
    ts = F.col("played_at")
    parts = t.time_parts(ts)
    return plays.withColumns(
        {
            "timestamp": ts,
            "date": t.to_day(ts),
            "year": parts["year"],
            "month": parts["month"],
            "day": parts["day"],
            "hour": parts["hour"],
            "time_of_day": t.daypart_etl(ts),
            "is_weekend": t.is_weekend(ts),
            "completion_ratio": m.completion_fixed(F.col("ms_played")),
            "processed_at": F.lit(None).cast("timestamp") if run_ts is None else run_ts,
        }
    ).select(*ENRICHED)


def user_daily_stats(
    enriched: DataFrame, tracks: DataFrame | None = None, artists: DataFrame | None = None
) -> DataFrame:
    """Per user and day: tracks, time, dayparts; with the dimensions also the favourites.

    The average counts only plays with a known length and is 0 without any.
    """
    measures = {
        "total_tracks": F.lit(1).cast("long"),
        "total_time_ms": F.coalesce(F.col("ms_played"), F.lit(0)).cast("long"),
        "timed": F.col("ms_played").isNotNull().cast("long"),
    }
    for part, column in zip(("morning", "afternoon", "evening", "night"), DAYPART_TRACKS):
        measures[column] = (F.col("time_of_day") == part).cast("long")
    keys = ["date", "user_id"]
    if tracks is None or artists is None:
        totals = enriched.groupBy(*keys).agg(*[F.sum(c).alias(k) for k, c in measures.items()])
        favourites = [F.lit(None).cast("string").alias(c) for c in _FAVOURITES]
    else:
        per_track = enriched.groupBy(*keys, "track_id").agg(
            *[F.sum(c).alias(k) for k, c in measures.items()]
        )
        totals = taste_facets(
            per_track, tracks, artists, keys, "total_tracks", list(measures), enriched
        )
        totals = totals.groupBy(*keys).agg(
            *[F.sum(k).alias(k) for k in measures],
            facet_top("artist").alias("favorite_artist_id"),
            facet_top("genre").alias("favorite_genre"),
        )
        favourites = [F.col(c) for c in _FAVOURITES]
    average = F.coalesce(F.try_divide(F.col("total_time_ms"), F.col("timed")), F.lit(0.0))
    return totals.select(
        *keys,
        "total_tracks",
        "total_time_ms",
        average.alias("avg_track_duration_ms"),
        *favourites,
        *DAYPART_TRACKS,
    )


_FAVOURITES = ["favorite_artist_id", "favorite_genre"]


def taste_facets(
    per_track: DataFrame,
    tracks: DataFrame,
    artists: DataFrame,
    keys: list[str],
    count: str,
    additive: list[str],
    plays: DataFrame,
) -> DataFrame:
    """Facets ``artist`` and ``genre`` of rows already aggregated to keys and track.

    A play counts once for each genre of its artist.  ``plays`` serves to find hot tracks
    when the tracks are too large to broadcast.
    """
    joined = join_tracks(
        per_track, tracks, "artist_id", how="left"
    )
    joined = join_artists(
        joined,
        artists,
        "genres",
        how="left",
    )
    return facet_counts(
        joined,
        keys,
        {"artist": F.col("artist_id")},
        ("genre", F.col("genres")),
        F.col(count),
        {name: F.col(name) for name in additive},
    )


def user_daily_stats_ext(enriched: DataFrame) -> DataFrame:
    """Per user and day with country, distinct tracks, skips and completion.

    Plays are first combined per track and country, which leaves small rows to find the
    first country in.  The average duration divides by all plays.
    """
    keys = ["date", "user_id"]
    per_track = enriched.groupBy(*keys, "track_id", "country").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("ms_played"), F.lit(0)).alias("ms"),
        count_where(m.is_true(F.col("skipped"))).alias("skips"),
        F.sum("completion_ratio").alias("completion"),
        F.count("completion_ratio").alias("completions"),
        F.min(F.struct("timestamp", "event_id")).alias("first"),
        *daypart_counts(F.col("time_of_day"), "tracks"),
    )
    stats = per_track.groupBy(*keys).agg(
        F.min_by("country", "first").alias("country"),
        F.sum("n").alias("total_tracks"),
        F.sum("ms").alias("total_time_ms"),
        F.count_distinct("track_id").alias("unique_tracks"),
        *[F.sum(c).alias(c) for c in DAYPART_TRACKS],
        F.sum("skips").alias("skipped_tracks"),
        F.coalesce(F.try_divide(F.sum("completion"), F.sum("completions")), F.lit(0.0)).alias(
            "avg_completion_rate"
        ),
    )
    return stats.select(
        *keys,
        "country",
        "total_tracks",
        "total_time_ms",
        (F.col("total_time_ms") / F.col("total_tracks")).alias("avg_track_duration_ms"),
        "unique_tracks",
        *DAYPART_TRACKS,
        "skipped_tracks",
        (F.col("total_tracks") - F.col("skipped_tracks")).alias("completed_tracks"),
        "avg_completion_rate",
    )


def track_daily_stats(enriched: DataFrame) -> DataFrame:
    """Per track and day: streams, listeners, completion and skip rate."""
    return enriched.groupBy("date", "track_id").agg(
        F.count(F.lit(1)).alias("total_streams"),
        F.count_distinct("user_id").alias("unique_listeners"),
        avg_or_zero(F.col("completion_ratio")).alias("avg_completion_rate"),
        F.avg(m.is_true(F.col("skipped")).cast("double")).alias("skip_rate"),
    )


def peak_hour(hour: Column) -> Column:
    """Hour with the most rows, the earliest on ties; the day's 24 counters are the state."""
    counters = F.array(*[F.count_if(hour == h) for h in range(24)])
    return (F.array_position(counters, F.array_max(counters)) - 1).cast("int")


def track_daily_stats_ext(enriched: DataFrame) -> DataFrame:
    """``track_daily_stats`` with listening time, top three countries and peak hour."""
    keys = ["date", "track_id"]
    listeners = (
        enriched.select(*keys, "user_id")
        .distinct()
        .groupBy(*keys)
        .agg(F.count("user_id").alias("unique_listeners"))
    )
    totals = enriched.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_streams"),
        F.coalesce(F.sum("ms_played"), F.lit(0)).alias("total_listening_time_ms"),
        avg_or_zero(F.col("completion_ratio")).alias("avg_completion_rate"),
        F.avg(m.is_true(F.col("skipped")).cast("double")).alias("skip_rate"),
        peak_hour(F.col("hour")).alias("peak_hour"),
    )
    countries = top_n_string(enriched, keys, "country", "top_countries")
    return (
        totals.join(listeners, keys)
        .join(countries, keys, "left")
        .select(
            *keys,
            "total_streams",
            "unique_listeners",
            "total_listening_time_ms",
            "avg_completion_rate",
            "skip_rate",
            F.coalesce("top_countries", F.lit("")).alias("top_countries"),
            "peak_hour",
        )
    )


def _plays_between(plays: DataFrame, start: Day, end: Day) -> DataFrame:
    """Plays of whole days ``start..end``; ``end`` is included up to midnight after it."""
    ts = F.col("played_at")
    return plays.where(date_between(ts, start, end)).withColumn("date", t.to_day(ts))


def song_daily_metrics(
    plays: DataFrame,
    tracks: DataFrame,
    artists: DataFrame,
    albums: DataFrame,
    start: Day,
    end: Day,
    skip_below: float = m.SKIP_BELOW,
) -> DataFrame:
    """Per song and day: counts, completion, and play counts by platform and country."""
    keys = ["track_id", "date"]
    timed = join_tracks(_plays_between(plays, start, end), tracks, "duration_ms").withColumn(
        "completion", m.completion_capped(F.col("ms_played"), F.col("duration_ms"))
    )
    measures = {
        "play_count": F.lit(1).cast("long"),
        "total_ms_played": F.coalesce(F.col("ms_played"), F.lit(0)).cast("long"),
        "skips": (F.coalesce("completion", F.lit(0.0)) < skip_below).cast("long"),
        "completion": F.coalesce("completion", F.lit(0.0)),
    }
    # One row per song, day, listener, platform and country before the facets unfold it.
    alike = timed.groupBy(
        *keys,
        "user_id",
        F.coalesce("platform", F.lit("unknown")).alias("platform"),
        F.coalesce("country", F.lit("unknown")).alias("country"),
    ).agg(*[F.sum(measure).alias(name) for name, measure in measures.items()])
    facets = facet_counts(
        alike,
        keys,
        {
            "platform": F.col("platform"),
            "country": F.col("country"),
            "listener": F.col("user_id"),
        },
        weight=F.col("play_count"),
        additive={name: F.col(name) for name in measures},
    )
    totals = facets.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in measures],
        facet_map("platform").alias("platforms"),
        facet_map("country").alias("countries"),
        facet_size("listener").alias("unique_listeners"),
    )
    named = join_tracks(totals, tracks, "name", "artist_id", "album_id")
    named = join_artists(named, artists, "name")
    named = join_albums(named, albums, "name")
    return named.select(
        F.col("track_id").alias("song_id"),
        "date",
        F.col("track_name").alias("song_name"),
        "artist_name",
        "album_name",
        "play_count",
        "unique_listeners",
        "total_ms_played",
        (F.col("total_ms_played") / F.col("play_count")).alias("avg_ms_played"),
        (F.col("skips") / F.col("play_count")).alias("skip_rate"),
        (F.col("completion") / F.col("play_count")).alias("avg_completion_rate"),
        "platforms",
        "countries",
    )


def user_daily_metrics(
    plays: DataFrame,
    tracks: DataFrame,
    artists: DataFrame,
    albums: DataFrame,
    start: Day,
    end: Day,
) -> DataFrame:
    """Per user and day: plays, distinct songs and artists, top artist, platforms."""
    keys = ["user_id", "date"]
    per_track = (
        _plays_between(plays, start, end)
        .groupBy(*keys, "track_id", F.coalesce("platform", F.lit("unknown")).alias("platform"))
        .agg(
            F.count(F.lit(1)).alias("plays"),
            F.coalesce(F.sum("ms_played"), F.lit(0)).alias("total_listening_time"),
        )
    )
    scoped = _plays_between(plays, start, end)
    named = join_tracks(
        per_track, tracks, "artist_id", "album_id"
    )
    named = join_artists(
        named, artists, "name"
    )
    named = join_albums(
        named, albums
    )
    facets = facet_counts(
        named,
        keys,
        {
            "platform": F.col("platform"),
            "song": F.col("track_id"),
            "artist": F.col("artist_id"),
            "artist_name": F.col("artist_name"),
        },
        weight=F.col("plays"),
        additive={c: F.col(c) for c in ("plays", "total_listening_time")},
    )
    return facets.groupBy(*keys).agg(
        F.sum("plays").alias("song_count"),
        facet_size("song").alias("unique_songs"),
        facet_size("artist").alias("unique_artists"),
        F.sum("total_listening_time").alias("total_listening_time"),
        F.coalesce(facet_top("artist_name"), F.lit("Unknown")).alias("top_artist"),
        facet_map("platform").alias("platforms"),
    )


def allocate_song_metrics(song_daily: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Spread each song-day over country and platform in proportion to both counts.

    Shares are rounded down and zero rows dropped, so they need not add up to the total.
    """
    run_ts = F.lit(None).cast("timestamp") if run_ts is None else run_ts
    by_country = song_daily.select(
        "*", F.explode("countries").alias("country", "country_plays")
    )
    by_both = by_country.select("*", F.explode("platforms").alias("platform", "platform_plays"))
    total = F.col("play_count")
    allocated = by_both.withColumn(
        "allocated", allocate(total, F.col("country_plays"), F.col("platform_plays"))
    ).where(F.col("allocated") > 0)
    return allocated.select(
        "song_id",
        "date",
        F.col("allocated").alias("play_count"),
        allocate(total, F.col("unique_listeners"), F.col("allocated")).alias("unique_listeners"),
        F.col("avg_ms_played").alias("average_play_duration"),
        "skip_rate",
        "country",
        "platform",
        run_ts.alias("created_at"),
        run_ts.alias("updated_at"),
    )


def user_listening_habits(user_daily: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Daily habits row per user, with the most used platform."""
    run_ts = F.lit(None).cast("timestamp") if run_ts is None else run_ts
    ranked = F.transform(
        F.map_entries("platforms"),
        lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("platform")),
    )
    return user_daily.select(
        "user_id",
        "date",
        "total_listening_time",
        "song_count",
        F.lit("unknown").alias("top_genre"),
        "top_artist",
        m.floor_div(F.col("total_listening_time"), F.col("song_count")).alias(
            "avg_session_duration"
        ),
        F.coalesce(F.array_min(ranked)["platform"], F.lit("unknown")).alias("platform"),
        run_ts.alias("created_at"),
        run_ts.alias("updated_at"),
    )


def user_daily_full(
    plays: DataFrame, tracks: DataFrame, artists: DataFrame, process_date: Day | None = None
) -> DataFrame:
    """Daily user row with weekdays, distinct artists, top artist and genre, explicit plays."""
    keys = ["date", "user_id"]
    timed = join_tracks(plays, tracks, "artist_id", "duration_ms", "explicit")
    ts = F.col("played_at")
    daypart = t.daypart_etl(ts)
    weekend = t.is_weekend(ts)
    completion = m.completion_capped(F.col("ms_played"), F.col("duration_ms"))
    per_artist = timed.groupBy(t.to_day(ts).alias("date"), "user_id", "artist_id").agg(
        F.count(F.lit(1)).alias("total_tracks"),
        F.coalesce(F.sum("ms_played"), F.lit(0)).alias("total_time_ms"),
        *daypart_counts(daypart, "tracks"),
        count_where(~weekend).alias("weekday_tracks"),
        count_where(weekend).alias("weekend_tracks"),
        count_where(m.is_true(F.col("explicit"))).alias("explicit_tracks"),
        F.sum(F.coalesce(completion, F.lit(0.0))).alias("completion"),
    )
    additive = [c for c in per_artist.columns if c not in (*keys, "artist_id")]
    joined = join_artists(
        per_artist,
        artists,
        "genres",
    )
    facets = facet_counts(
        joined,
        keys,
        {"artist": F.col("artist_id")},
        ("genre", F.col("genres")),
        F.col("total_tracks"),
        {c: F.col(c) for c in additive},
    )
    daily = facets.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in additive],
        facet_size("artist").alias("distinct_artists"),
        facet_top("artist").alias("top_artist_id"),
        facet_top("genre").alias("top_genre"),
    )
    return daily.select(
        *keys,
        "total_tracks",
        "total_time_ms",
        (F.col("total_time_ms") / F.col("total_tracks")).alias("avg_track_duration"),
        *DAYPART_TRACKS,
        "weekday_tracks",
        "weekend_tracks",
        "distinct_artists",
        "top_artist_id",
        "top_genre",
        "explicit_tracks",
        (F.col("completion") / F.col("total_tracks")).alias("completion_rate"),
        (t.day(process_date) if process_date else F.col("date")).alias("process_date"),
    )


def track_daily_full(
    plays: DataFrame, tracks: DataFrame, artists: DataFrame, process_date: Day | None = None
) -> DataFrame:
    """Daily track row with names, dayparts, weekdays, completion and skips."""
    keys = ["date", "track_id"]
    timed = join_tracks(plays, tracks, "duration_ms")
    ts = F.col("played_at")
    weekend = t.is_weekend(ts)
    completion = m.completion_capped(F.col("ms_played"), F.col("duration_ms"))
    daily = timed.groupBy(t.to_day(ts).alias("date"), "track_id").agg(
        F.count(F.lit(1)).alias("total_streams"),
        F.count_distinct("user_id").alias("unique_listeners"),
        F.coalesce(F.sum("ms_played"), F.lit(0)).alias("total_time_ms"),
        F.avg(F.coalesce(completion, F.lit(0.0))).alias("avg_completion_rate"),
        F.avg(m.is_true(F.col("skipped")).cast("double")).alias("skip_rate"),
        *daypart_counts(t.daypart_etl(ts), "streams"),
        count_where(~weekend).alias("weekday_streams"),
        count_where(weekend).alias("weekend_streams"),
    )
    named = join_tracks(daily, tracks, "name", "artist_id")
    named = join_artists(named, artists, "name")
    return named.select(
        *keys,
        "track_name",
        "artist_id",
        "artist_name",
        *[c for c in daily.columns if c not in keys],
        (t.day(process_date) if process_date else F.col("date")).alias("process_date"),
    )


def minutes_by_daypart(daypart: Column, weekend: Column, ms: Column) -> list[Column]:
    """Eight listening-time sums: weekday/weekend by daypart, in minutes."""
    columns = []
    for label, flag in (("weekday", ~weekend), ("weekend", weekend)):
        for part in ("morning", "afternoon", "evening", "night"):
            total = sum_where(flag & (daypart == part), F.coalesce(ms, F.lit(0)))
            columns.append(m.minutes(total).alias(f"listening_time_{label}_{part}"))
    return columns
