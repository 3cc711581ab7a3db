"""Hourly trends, user features and reports by a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions import measures as m
from earshot.functions import time as t
from earshot.functions.aggregates import count_where
from earshot.operators.grouping import facet_size, facet_top, facet_total, of_facet, top_counts
from earshot.plans.daily import minutes_by_daypart, taste_facets
from earshot.plans.marts import most_played_genre


def hourly_trends(plays: DataFrame, tracks: DataFrame, artists: DataFrame) -> DataFrame:
    """Plays, listeners and most played genre per hour of day."""
    hourly = plays.withColumn("hour_of_day", F.hour("played_at"))
    totals = hourly.groupBy("hour_of_day").agg(
        F.count(F.lit(1)).alias("total_plays"),
        F.count_distinct("user_id").alias("unique_listeners"),
    )
    genre = most_played_genre(hourly, tracks, artists, "hour_of_day")
    return totals.join(genre, "hour_of_day", "left")


def user_features(plays: DataFrame, tracks: DataFrame, artists: DataFrame) -> DataFrame:
    """Listening minutes by weekday/weekend and daypart, and four behaviour rates per user.

    ``genre_diversity``: distinct genres per genre play; ``artist_loyalty``: share of plays
    of the most played artist; ``track_discovery_rate``: first plays of a track per play.
    """
    ts = F.col("played_at")
    times = minutes_by_daypart(t.daypart_etl(ts), t.is_weekend(ts), F.col("ms_played"))
    per_track = plays.groupBy("user_id", "track_id").agg(
        F.count(F.lit(1)).alias("plays"),
        F.lit(1).cast("long").alias("tracks"),
        count_where(m.is_true(F.col("skipped"))).alias("skips"),
        *times,
    )
    additive = [c for c in per_track.columns if c not in ("user_id", "track_id")]
    facets = taste_facets(per_track, tracks, artists, ["user_id"], "plays", additive, plays)
    summed = facets.groupBy("user_id").agg(
        *[F.sum(c).alias(c) for c in additive],
        facet_size("genre").alias("genres"),
        facet_total("genre").alias("genre_plays"),
        F.max(F.when(of_facet("artist"), F.col("n"))).alias("top_artist_plays"),
        facet_top("artist").alias("top_artist_id"),
    )

    def ratio(part: str, whole: str):
        return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole)), F.lit(0.0))

    return summed.select(
        "user_id",
        *[c for c in additive if c.startswith("listening_time")],
        ratio("genres", "genre_plays").alias("genre_diversity"),
        ratio("top_artist_plays", "plays").alias("artist_loyalty"),
        ratio("tracks", "plays").alias("track_discovery_rate"),
        ratio("skips", "plays").alias("skip_rate"),
    )


GRAINS = {"day": "day", "week": "week", "month": "month"}


def activity_by(history: DataFrame, dimension: str, grain: str = "month") -> DataFrame:
    """Plays, active users and minutes per period and subscription type, country or device."""
    period = F.to_date(F.date_trunc(GRAINS[grain], F.col("played_at").cast("timestamp")))
    return history.groupBy(period.alias("period"), dimension).agg(
        F.count(F.lit(1)).alias("plays"),
        F.count_distinct("user_id").alias("active_users"),
        m.minutes(F.coalesce(F.sum("ms_played"), F.lit(0))).alias("minutes"),
    )


def monthly_active_users(plays: DataFrame) -> DataFrame:
    month = F.to_date(F.date_trunc("month", F.col("played_at").cast("timestamp")))
    return plays.groupBy(month.alias("month")).agg(
        F.count_distinct("user_id").alias("active_users")
    )


def search_terms_top(searches: DataFrame, k: int = 5) -> DataFrame:
    """Most frequent search texts, compared in lower case."""
    return top_counts(searches, "search_query", k, "searches")


def auth_failure_rate(auth: DataFrame) -> DataFrame:
    """Attempts, failures and failure rate per authentication type."""
    failed = ~m.is_true(F.col("success"))
    return auth.groupBy("auth_type").agg(
        F.count(F.lit(1)).alias("attempts"),
        count_where(failed).alias("failures"),
        F.avg(failed.cast("double")).alias("failure_rate"),
    )


def playlist_action_counts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action_type").agg(F.count(F.lit(1)).alias("actions"))
