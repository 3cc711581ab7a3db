"""Extracts that feed the other jobs, and the processed history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions import measures as m
from earshot.functions import time as t
from earshot.operators.changes import insert_new
from earshot.operators.filters import on_date
from earshot.operators.joins import (
    join_albums,
    join_artists,
    join_tracks,
)

Day = str | dt.date


def extract_history(
    plays: DataFrame, tracks: DataFrame, artists: DataFrame, day: Day
) -> DataFrame:
    """One day's plays with track and artist attributes, in time order."""
    scoped = plays.where(on_date(F.col("played_at"), day))
    rows = join_tracks(
        scoped, tracks, "name", "artist_id", "duration_ms", "explicit", "popularity"
    )
    rows = join_artists(
        rows,
        artists,
        "name",
        "genres",
        "popularity",
    )
    return rows.select(
        "event_id",
        "user_id",
        "track_id",
        "artist_id",
        "played_at",
        "ms_played",
        "track_name",
        "artist_name",
        m.completed_flag(F.col("ms_played"), F.col("duration_ms")).alias("completed"),
        "duration_ms",
        "explicit",
        "track_popularity",
        "genres",
        "artist_popularity",
    ).orderBy("played_at", "event_id")


def extract_tracks(tracks: DataFrame, artists: DataFrame, albums: DataFrame) -> DataFrame:
    """Track catalogue with artist and album attributes."""
    rows = tracks.withColumnRenamed("name", "track_name")
    rows = join_artists(rows, artists, "name", "genres", "popularity")
    rows = join_albums(
        rows,
        albums,
        "name",
        "total_tracks",
        "album_type",
    )
    return rows.select(
        "track_id",
        "track_name",
        "artist_id",
        "artist_name",
        "album_id",
        "album_name",
        "duration_ms",
        "explicit",
        "track_number",
        "disc_number",
        "popularity",
        "release_date",
        "genres",
        "artist_popularity",
        "total_tracks",
        "album_type",
    )


def extract_active_users(users: DataFrame) -> DataFrame:
    return users.where(m.is_true(F.col("is_active"))).select(
        "user_id",
        "username",
        "email",
        "country",
        "birthdate",
        "gender",
        "subscription_type",
        F.col("registered_on").alias("registration_date"),
        F.col("is_active").alias("active"),
        F.col("last_active").alias("last_login"),
    )


STAGED = [
    "event_id",
    "user_id",
    "track_id",
    "played_at",
    "ms_played",
    "reason_start",
    "reason_end",
    "shuffle",
    "skipped",
    "platform",
    "country",
]


def incremental_extract(plays: DataFrame, staged: DataFrame, day: Day) -> DataFrame:
    """Plays of the day before ``day`` that are not staged yet, once per event id."""
    yesterday = t.as_date(day) - dt.timedelta(days=1)
    batch = plays.where(on_date(F.col("played_at"), yesterday)).select(*STAGED)
    fresh = insert_new(staged, batch, ["event_id"], F.col("played_at"))
    return fresh.withColumn("processed_date", t.day(day))


def processed_history(
    plays: DataFrame, tracks: DataFrame, users: DataFrame, run_ts: Column | None = None
) -> DataFrame:
    """Raw plays with artist, album, completion, weekday (Sunday 0), hour and user attributes."""
    ts = F.col("played_at")
    rows = join_tracks(plays.drop("country"), tracks, "artist_id", "album_id", "duration_ms")
    rows = rows.join(users.select("user_id", "country", "subscription_type"), "user_id")
    return rows.select(
        F.col("event_id").alias("id"),
        "user_id",
        "track_id",
        "artist_id",
        "album_id",
        "played_at",
        "ms_played",
        m.completion_capped(F.col("ms_played"), F.col("duration_ms")).alias("completion_rate"),
        t.weekday_sunday0(ts).alias("day_of_week"),
        F.hour(ts).alias("hour_of_day"),
        "skipped",
        "session_id",
        "country",
        "subscription_type",
        (F.lit(None).cast("timestamp") if run_ts is None else run_ts).alias("processed_at"),
    )
