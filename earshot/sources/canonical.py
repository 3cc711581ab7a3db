"""The listening model's tables, derived from the Parquet tables given for testing.

events -> plays and the event feed; part -> tracks, artists, albums; customer ->
users; orders and lineitem -> playlists and their tracks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Domains used when the given tables are re-labelled.
COUNTRIES = ["US", "GB", "DE", "FR", "BR", "JP", "SE"]
PLATFORMS = ["android", "ios", "web", "desktop_windows", "smarttv"]
ERROR_TYPES = [
    "network_error",
    "api_error",
    "authentication_error",
    "playback_error",
    "database_error",
    "client_error",
]
PLAYLIST_ACTIONS = ["create", "add_song", "remove_song", "rename", "delete"]
EVENT_TYPES = {
    "view": "song_play",
    "signup": "auth",
    "click": "search",
    "purchase": "playlist",
    "error": "error",
}


def pick(values: list[str], index: Column) -> Column:
    array = F.array(*[F.lit(v) for v in values])
    return F.element_at(array, (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


@dataclass(frozen=True)
class Canonical:
    spark: SparkSession
    path: str

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{table}.parquet")

    def stream(self, table: str) -> DataFrame:
        """The table as a file stream, whether it is one Parquet file or a folder of them."""
        path = f"{self.path}/{table}.parquet"
        reader = self.spark.readStream.schema(self.read(table).schema)
        location = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        filesystem = location.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if filesystem.getFileStatus(location).isDirectory():
            return reader.parquet(path)
        return reader.option("pathGlobFilter", f"{table}.parquet").parquet(self.path)

    @cached_property
    def plays(self) -> DataFrame:
        """Raw streaming history, one row per event."""
        k = F.from_json("props", "k bigint")["k"]
        return self.read("events").select(
            "event_id",
            "user_id",
            k.alias("track_id"),
            F.col("ts").alias("played_at"),
            F.floor(F.col("value") * 3000).cast("long").alias("ms_played"),
            F.concat_ws("-", F.col("user_id"), F.date_format("ts", "yyyy-MM-dd")).alias(
                "session_id"
            ),
            F.col("event_type").alias("device"),
            F.lit("playbtn").alias("reason_start"),
            F.when(F.col("value") < 10, "forwarded").otherwise("trackdone").alias("reason_end"),
            (F.pmod(F.col("event_id"), F.lit(3)) == 0).alias("shuffle"),
            (F.col("value") < 10).alias("skipped"),
            pick(PLATFORMS, F.col("event_id")).alias("platform"),
            F.when(
                F.pmod(F.col("event_id"), F.lit(50)) != 0, pick(COUNTRIES, F.col("user_id"))
            ).alias("country"),
        )

    @cached_property
    def tracks(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("track_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("album_id"),
            F.col("p_brand").alias("artist_id"),
            F.floor(F.col("p_retailprice") * 200).cast("long").alias("duration_ms"),
            (F.pmod(F.col("p_size"), F.lit(5)) == 0).alias("explicit"),
            F.col("p_size").alias("track_number"),
            F.lit(1).alias("disc_number"),
            F.pmod(F.col("p_partkey"), F.lit(101)).cast("int").alias("popularity"),
            F.date_add(
                F.lit("2020-01-01").cast("date"),
                F.pmod(F.col("p_partkey"), F.lit(1000)).cast("int"),
            ).alias("release_date"),
        )

    @cached_property
    def artists(self) -> DataFrame:
        """Words are made distinct per artist before they are collected; the first word of a
        part carries its count and size."""
        words = self.read("part").select(
            F.col("p_brand").alias("artist_id"),
            "p_size",
            F.posexplode(F.split("p_name", " ")).alias("at", "word"),
        )
        per_word = words.groupBy("artist_id", "word").agg(
            F.count_if(F.col("at") == 0).alias("parts"),
            F.sum(F.when(F.col("at") == 0, F.col("p_size"))).alias("size"),
        )
        return (
            per_word.groupBy("artist_id")
            .agg(
                F.sort_array(F.collect_list("word")).alias("genres"),
                F.pmod(F.sum("parts"), F.lit(101)).cast("int").alias("popularity"),
                F.sum("size").alias("followers"),
            )
            .select(
                "artist_id", F.col("artist_id").alias("name"), "popularity", "genres", "followers"
            )
        )

    @cached_property
    def albums(self) -> DataFrame:
        return (
            self.read("part")
            .groupBy(F.col("p_type").alias("album_id"))
            .agg(F.min("p_brand").alias("artist_id"), F.count(F.lit(1)).alias("total_tracks"))
            .select(
                "album_id",
                F.col("album_id").alias("name"),
                "artist_id",
                F.lit("2020-01-01").cast("date").alias("release_date"),
                "total_tracks",
                F.when(F.col("total_tracks") > 300, "compilation")
                .otherwise("album")
                .alias("album_type"),
            )
        )

    @cached_property
    def users(self) -> DataFrame:
        key = F.col("c_custkey")
        registered = F.date_add(
            F.lit("2024-01-01").cast("date"), F.pmod(key, F.lit(30)).cast("int")
        )
        return (
            self.read("customer")
            .select(
                key.alias("user_id"),
                F.col("c_name").alias("username"),
                F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
                F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("country"),
                F.date_add(
                    F.lit("1970-01-01").cast("date"), F.pmod(key, F.lit(10000)).cast("int")
                ).alias("birthdate"),
                pick(["female", "male", "other"], key).alias("gender"),
                F.col("c_mktsegment").alias("subscription_type"),
                registered.alias("registered_on"),
                (F.col("c_acctbal") > 0).alias("is_active"),
                F.date_add(registered, 7).alias("last_active"),
            )
        )

    @cached_property
    def playlists(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_orderkey").alias("playlist_id"),
            F.concat(F.lit("playlist "), F.col("o_orderkey").cast("string")).alias("name"),
            F.col("o_custkey").alias("user_id"),
            (F.col("o_orderstatus") != "P").alias("is_public"),
            F.col("o_orderdate").alias("created_at"),
        )

    @cached_property
    def playlist_tracks(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("playlist_id"),
            F.col("l_partkey").alias("track_id"),
            F.col("l_shipdate").alias("added_at"),
            F.col("l_linenumber").alias("position"),
        )

    @cached_property
    def event_values(self) -> DataFrame:
        return event_values(self.read("events"))


def event_values(events: DataFrame) -> DataFrame:
    """The events as the JSON messages of the feed; works on a streaming frame too."""
    kind = F.col("event_type")
    event_id = F.col("event_id")
    k = F.from_json("props", "k bigint")["k"]
    is_play, is_auth = kind == "view", kind == "signup"
    is_search, is_list, is_error = kind == "click", kind == "purchase", kind == "error"
    mapped = F.lit("unmapped")
    for given, name in EVENT_TYPES.items():
        mapped = F.when(kind == given, name).otherwise(mapped)
    query = F.concat(
        F.when(F.pmod(event_id, F.lit(2)) == 0, "Best Songs ").otherwise("best songs "),
        F.pmod(k, F.lit(20)).cast("string"),
    )
    action = pick(PLAYLIST_ACTIONS, event_id)
    message = F.struct(
        event_id.cast("string").alias("event_id"),
        mapped.alias("event_type"),
        F.col("user_id").cast("string").alias("user_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.when(~is_auth & (F.pmod(event_id, F.lit(40)) != 0), pick(PLATFORMS, event_id)).alias(
            "platform"
        ),
        F.when(is_play | (is_list & action.isin("add_song", "remove_song")), k.cast("string")).alias(
            "song_id"
        ),
        F.when(is_play, F.floor(F.col("value") * 3000).cast("long")).alias("ms_played"),
        F.when(
            is_play,
            F.struct(pick(COUNTRIES, F.col("user_id")).alias("country")),
        ).alias("location"),
        F.when(is_auth, F.lit("password")).alias("auth_type"),
        F.when(is_auth, F.pmod(event_id, F.lit(20)) != 0).alias("success"),
        F.when(is_auth, pick(COUNTRIES, F.col("user_id"))).alias("country"),
        F.when(is_search, query).alias("search_query"),
        F.when(is_search, F.pmod(event_id, F.lit(200)).cast("int")).alias("result_count"),
        F.when(is_list, F.pmod(event_id, F.lit(500)).cast("string")).alias("playlist_id"),
        F.when(is_list, action).alias("action_type"),
        F.when(is_error, pick(ERROR_TYPES, event_id)).alias("error_type"),
        F.when(is_error, F.lit("request failed")).alias("error_message"),
    )
    return events.select(F.to_json(message).alias("value"))
