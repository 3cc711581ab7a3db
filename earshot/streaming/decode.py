"""Decoding and routing of the JSON event feed; works on batch and streaming frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.functions.measures import with_default
from earshot.functions.text import as_json, normalize_query, parse_location
from earshot.functions.time import parse_iso
from earshot.operators.filters import of_type
from earshot.schemas import EVENT, struct_of

# The event types of the feed.
EVENT_TYPES = ["song_play", "auth", "search", "playlist", "error"]


def decode_events(
    feed: DataFrame, *fields: str, default_ts: Column | None = None
) -> DataFrame:
    """Parse ``value`` with the union schema; ``raw_data`` keeps the original text.

    Undecodable text gives a row of nulls.  Naming ``fields`` parses only those; the metrics
    need a few.  The parsed struct is unfolded by a generator because a filter on a field
    would otherwise be pushed below the projection and parse the text a second time.
    """
    schema = struct_of(EVENT)
    if fields:
        schema = T.StructType([f for f in schema if f.name in fields])
    parsed = feed.select(
        F.col("value").alias("raw_data"), F.inline(F.array(F.from_json("value", schema)))
    )
    if "timestamp" not in parsed.columns:
        return parsed
    return parsed.withColumn("event_ts", parse_iso(F.col("timestamp"), default_ts)).drop(
        "timestamp"
    )


def is_known() -> Column:
    return F.coalesce(F.col("event_type").isin(*EVENT_TYPES), F.lit(False))


def is_storable() -> Column:
    """Whether an event belongs to one of the tables: known type, an id and a readable time."""
    return is_known() & F.col("event_ts").isNotNull() & F.col("event_id").isNotNull()


def quarantine(events: DataFrame) -> DataFrame:
    """Undecodable text, unknown event types, events without a readable time or without an id."""
    undecodable = ~is_known() & F.get_json_object("raw_data", "$").isNull()
    reason = (
        F.when(undecodable, "undecodable")
        .when(~is_known(), "unknown event type")
        .when(F.col("event_ts").isNull(), "unreadable timestamp")
        .when(F.col("event_id").isNull(), "missing id")
    )
    return events.select("raw_data", reason.alias("reason")).where(F.col("reason").isNotNull())


def accepted(events: DataFrame, event_type: str) -> DataFrame:
    return of_type(events, event_type).where(is_storable())


def platform() -> Column:
    return with_default(F.col("platform"), "unknown")


def project_song_play(events: DataFrame) -> DataFrame:
    return accepted(events, "song_play").select(
        "event_id",
        "user_id",
        "song_id",
        F.col("event_ts").alias("timestamp"),
        "session_id",
        platform().alias("platform"),
        with_default(F.col("ms_played"), 0).alias("ms_played"),
        with_default(F.col("user_agent"), "").alias("user_agent"),
        with_default(F.col("device_type"), "").alias("device_type"),
        F.coalesce(as_json(F.col("location")), F.lit("{}")).alias("location"),
        with_default(F.col("network_type"), "").alias("network_type"),
        with_default(F.col("ip_address"), "").alias("ip_address"),
        "raw_data",
    )


def located_plays(events: DataFrame) -> DataFrame:
    """Decoded plays with the country and city of their location, ``unknown`` without one."""
    plays = project_song_play(events)
    return plays.withColumns(parse_location(F.col("location"))).drop("location")


def project_auth(events: DataFrame) -> DataFrame:
    return accepted(events, "auth").select(
        "event_id",
        "user_id",
        F.col("event_ts").alias("timestamp"),
        with_default(F.col("auth_type"), "").alias("auth_type"),
        with_default(F.col("success"), False).alias("success"),
        with_default(F.col("ip_address"), "").alias("ip_address"),
        with_default(F.col("user_agent"), "").alias("user_agent"),
        with_default(F.col("country"), "").alias("country"),
        "raw_data",
    )


def project_search(events: DataFrame) -> DataFrame:
    return accepted(events, "search").select(
        "event_id",
        "user_id",
        F.col("event_ts").alias("timestamp"),
        normalize_query(F.col("search_query")).alias("search_query"),
        with_default(F.col("result_count"), 0).alias("result_count"),
        platform().alias("platform"),
        with_default(F.col("user_agent"), "").alias("user_agent"),
        "raw_data",
    )


def project_playlist(events: DataFrame) -> DataFrame:
    return accepted(events, "playlist").select(
        "event_id",
        "user_id",
        "playlist_id",
        F.col("event_ts").alias("timestamp"),
        with_default(F.col("action_type"), "").alias("action_type"),
        "song_id",
        platform().alias("platform"),
        "raw_data",
    )


def project_error(events: DataFrame) -> DataFrame:
    """Error events in the layout of the ``system_errors`` table."""
    return accepted(events, "error").select(
        F.col("event_id").alias("error_id"),
        platform().alias("service"),
        with_default(F.col("error_type"), "unknown").alias("error_code"),
        with_default(F.col("error_message"), "").alias("error_message"),
        F.col("event_ts").alias("timestamp"),
    )


PROJECTIONS = {
    "song_play": project_song_play,
    "auth": project_auth,
    "search": project_search,
    "playlist": project_playlist,
    "error": project_error,
}

# Table name of each event type.
TABLES = {
    "song_play": "song_plays",
    "auth": "auth_events",
    "search": "search_events",
    "playlist": "playlist_events",
    "error": "system_errors",
}


def route(events: DataFrame) -> dict[str, DataFrame]:
    """One projected frame per event type, and the quarantined rest."""
    routed = {kind: project(events) for kind, project in PROJECTIONS.items()}
    routed["quarantine"] = quarantine(events)
    return routed


def route_counts(events: DataFrame) -> DataFrame:
    """Rows per target table, in one pass."""
    table = reduce(
        lambda rest, kind: F.when(F.col("event_type") == kind, TABLES[kind]).otherwise(rest),
        EVENT_TYPES,
        F.lit("quarantine"),
    )
    target = F.when(is_storable(), table).otherwise("quarantine").alias("table_name")
    return events.groupBy(target).agg(F.count(F.lit(1)).alias("rows"))
