"""Schemas of the listening data model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRACKS = """track_id string, name string, album_id string, artist_id string, duration_ms int,
    explicit boolean, track_number int, popularity int, danceability double, energy double, `key` int,
    loudness double, mode int, speechiness double, acousticness double, instrumentalness double,
    liveness double, valence double, tempo double, time_signature int"""

PIPELINE_EXECUTIONS = """pipeline_name string, environment string, status string,
    start_time timestamp, end_time timestamp, duration_seconds bigint, records_processed bigint,
    execution_date date"""

ETL_LOGS = """etl_task string, table_name string, start_datetime timestamp, end_datetime timestamp,
    records_processed bigint, status string, log_message string"""

# One schema that covers the five event types; a type's missing fields are null.
EVENT = """event_id string, event_type string, user_id string, timestamp string, platform string,
    user_agent string, ip_address string, country string,
    song_id string, session_id string, ms_played bigint, device_type string, network_type string,
    location struct<latitude:double,longitude:double,city:string,country:string>,
    auth_type string, success boolean,
    search_query string, result_count int,
    playlist_id string, action_type string,
    error_type string, error_message string, error_severity string,
    metadata string"""


def struct_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def project_schema(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Cast ``df`` to ``schema`` by column name; absent columns become null."""
    fields = struct_of(schema) if isinstance(schema, str) else schema

    def column(field: T.StructField) -> Column:
        source = F.col(f"`{field.name}`") if field.name in df.columns else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in fields])


def named(df: DataFrame, *names: str) -> DataFrame:
    """Name columns by position, for sources that return unnamed rows."""
    return df.toDF(*names)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Adapter between the two vocabularies, e.g. ``song_id`` and ``track_id``."""
    return df.withColumnsRenamed({old: new for old, new in mapping.items() if old in df.columns})


# Names used by the event feeds on the left, by the history tables on the right.
SONG_TO_TRACK = {
    "song_id": "track_id",
    "timestamp": "played_at",
    "song_name": "track_name",
}
