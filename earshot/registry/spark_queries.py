"""Every registered query: (spark, folder of the given tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.operators import changes, quality, sessions
from earshot.operators.filters import date_between
from earshot.operators.grouping import union_counts
from earshot.operators.joins import lookup_with_default
from earshot.plans import activity, daily, extracts, features, marts
from earshot.plans.upkeep import UserUpkeep
from earshot.session import scratch_path
from earshot.sinks import checked, writers
from earshot.sinks.keyed import KeyedTable
from earshot.sources import readers, splits
from earshot.sources.canonical import Canonical, event_values
from earshot.streaming import decode, ingest, late_sessions, metrics

AS_OF = "2024-01-29"
START, END = "2024-01-10", "2024-01-16"
GROWTH_DAYS = 10
RUN_TS = "2024-01-29 06:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp_ntz")


def comparable(df: DataFrame) -> DataFrame:
    """Plain columns for comparison: doubles rounded, maps and arrays as text."""

    def plain(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(F.round(column, 9), 6)
        elif isinstance(field.dataType, T.MapType):
            pairs = F.transform(
                F.array_sort(F.map_entries(column)),
                lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")),
            )
            column = F.concat_ws(",", pairs)
        elif isinstance(field.dataType, T.ArrayType):
            column = F.concat_ws(",", column)
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema])


def _enriched(c: Canonical) -> DataFrame:
    return daily.enrich_history(c.plays, run_ts())


def _history(c: Canonical) -> DataFrame:
    return extracts.processed_history(c.plays, c.tracks, c.users, run_ts())


def _song_daily(c: Canonical) -> DataFrame:
    return daily.song_daily_metrics(c.plays, c.tracks, c.artists, c.albums, START, END)


def _user_daily(c: Canonical) -> DataFrame:
    return daily.user_daily_metrics(c.plays, c.tracks, c.artists, c.albums, START, END)


def _decoded(c: Canonical, *fields: str) -> DataFrame:
    return decode.decode_events(c.event_values, *fields)


def _lookup(c: Canonical) -> DataFrame:
    rows = lookup_with_default(c.plays, c.tracks, c.artists, c.albums)
    return rows.select(
        "event_id",
        "track_id",
        "ms_played",
        "track_name",
        "artist_name",
        "album_name",
        "duration_ms",
        "track_popularity",
        "completion_rate",
    )


def _upsert(c: Canonical) -> DataFrame:
    """Stored statistics up to one day, updated with a later, overlapping range."""

    def stats(start: str, end: str, stamp: str) -> DataFrame:
        rows = daily.user_daily_metrics(c.plays, c.tracks, c.artists, c.albums, start, end)
        return changes.with_audit(
            daily.user_listening_habits(rows),
            F.lit(stamp).cast("timestamp_ntz"),
            "created_at",
            "updated_at",
        )

    stored = stats("2024-01-10", "2024-01-14", "2024-01-15 00:00:00")
    updates = stats("2024-01-13", "2024-01-16", "2024-01-17 00:00:00")
    return changes.upsert(stored, updates, ["user_id", "date"])


def _generate_analytics(c: Canonical) -> DataFrame:
    """Three columns refreshed for recently active users, the others kept."""
    target = marts.user_listening_stats(
        c.plays.where(F.col("played_at") < F.lit("2024-01-25").cast("date")),
        c.tracks,
        c.artists,
        "2024-01-25",
    ).drop("last_updated")
    updates = activity.generate_analytics(c.plays, AS_OF)
    return changes.upsert(target, updates, ["user_id"])


def _insert_new(c: Canonical) -> DataFrame:
    """A batch with every row twice against a target that has a part of it."""
    columns = ["event_id", "user_id", "track_id", "played_at"]
    target = c.plays.where(F.col("played_at") < F.lit("2024-01-15").cast("date")).select(*columns)
    batch = c.plays.where(F.col("played_at") >= F.lit("2024-01-10").cast("date")).select(*columns)
    return changes.insert_new(target, batch.unionByName(batch), ["event_id"], F.col("played_at"))


def _incremental(c: Canonical) -> DataFrame:
    """The batch before ``AS_OF`` where the plays up to noon are staged already."""
    noon = F.lit("2024-01-28 12:00:00").cast("timestamp_ntz")
    staged = c.plays.where(F.col("played_at") < noon).select("event_id")
    return extracts.incremental_extract(c.plays, staged, AS_OF)


def _upsert_counters(c: Canonical) -> DataFrame:
    """Counters of the first half of January plus the deltas of the second half."""
    events = _decoded(c, "event_type", "timestamp", "song_id", "search_query", "error_type")
    middle = F.lit("2024-01-16").cast("timestamp")
    stored = ingest.counter_deltas(events.where(F.col("event_ts") < middle)).withColumn(
        "last_updated", F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    )
    deltas = ingest.counter_deltas(events.where(F.col("event_ts") >= middle))
    return changes.upsert_counters(stored, deltas, run_ts())


def _snapshot(c: Canonical) -> DataFrame:
    """Users snapshot in which every seventh user changed plan after the first load."""
    attributes = ["username", "country", "subscription_type"]
    first = changes.build_dim(c.users, "user_id", attributes)
    history = first.withColumns(
        {
            "valid_from": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
            "valid_to": F.lit(None).cast("timestamp_ntz"),
        }
    )
    moved = c.users.withColumn(
        "subscription_type",
        F.when(F.pmod("user_id", F.lit(7)) == 0, "PREMIUM").otherwise(F.col("subscription_type")),
    )
    current = changes.build_dim(moved, "user_id", attributes)
    return changes.snapshot_scd2(history, current, "user_id", run_ts()).drop("row_hash")


def _dq_unique(c: Canonical) -> DataFrame:
    return quality.union(
        quality.check_unique(c.users, "users", "user_id"),
        quality.check_unique(c.artists, "artists", "artist_id"),
        quality.check_unique(c.albums, "albums", "album_id"),
        quality.check_unique(c.tracks, "tracks", "track_id"),
        quality.check_unique(c.tracks, "tracks", "name"),
        quality.check_unique(c.plays, "streaming_history", "event_id"),
        quality.check_unique(c.playlist_tracks, "playlist_tracks", "playlist_id", "track_id"),
    )


NOT_NULL = {
    "users": ("user_id", "username", "country"),
    "tracks": ("track_id", "name", "album_id", "artist_id"),
    "streaming_history": ("event_id", "user_id", "track_id", "played_at", "country"),
}


def _dq_not_null(c: Canonical) -> DataFrame:
    tables = {"users": c.users, "tracks": c.tracks, "streaming_history": c.plays}
    return quality.union(
        *[quality.check_not_null(df, name, *NOT_NULL[name]) for name, df in tables.items()]
    )


def _dq_fk(c: Canonical) -> DataFrame:
    return quality.union(
        quality.check_fk(c.albums, "albums", "artist_id", c.artists),
        quality.check_fk(c.tracks, "tracks", "album_id", c.albums),
        quality.check_fk(c.tracks, "tracks", "artist_id", c.artists),
        quality.check_fk(c.plays, "streaming_history", "user_id", c.users),
        quality.check_fk(c.plays, "streaming_history", "track_id", c.tracks),
        quality.check_fk(c.playlists, "playlists", "user_id", c.users),
        quality.check_fk(c.playlist_tracks, "playlist_tracks", "playlist_id", c.playlists),
        quality.check_fk(c.playlist_tracks, "playlist_tracks", "track_id", c.tracks),
    )


def _dq_range(c: Canonical) -> DataFrame:
    return quality.union(
        quality.check_range(
            c.tracks,
            "tracks",
            duration_ms=(1, None),
            popularity=(0, 100),
            track_number=(1, 40),
        ),
        quality.check_range(
            _history(c),
            "processed",
            ms_played=(0, None),
            completion_rate=(0.0, 1.0),
            day_of_week=(0, 6),
            hour_of_day=(0, 23),
        ),
        quality.check_in(c.plays, "streaming_history", platform=["android", "ios", "web"]),
    )


def _dq_invariants(c: Canonical) -> DataFrame:
    users = daily.user_daily_full(c.plays, c.tracks, c.artists)
    tracks = daily.track_daily_full(c.plays, c.tracks, c.artists)
    return quality.union(
        quality.check_user_invariants(users), quality.check_track_invariants(tracks)
    )


def _dq_checks(c: Canonical) -> DataFrame:
    return quality.union(
        _dq_unique(c),
        _dq_fk(c),
        quality.check_table(c.users, "users", *NOT_NULL["users"]),
        quality.check_table(
            c.tracks, "tracks", *NOT_NULL["tracks"], minimum=20, rows_name="tracks"
        ),
        quality.check_table(
            c.plays,
            "streaming_history",
            *NOT_NULL["streaming_history"],
            dates=(AS_OF, "2024-03-01"),
            minimum=20,
            rows_name="plays",
        ),
    )


def _dq_observed(c: Canonical) -> DataFrame:
    """Row checks of the tables, counted by the passes that write them; plays come in two batches."""
    base = scratch_path(c.spark, "checked")

    def not_null(table: str) -> dict[str, Column]:
        return {f"not_null:{table}.{name}": quality.is_missing(name) for name in NOT_NULL[table]}

    plays = checked.TableChecks(
        not_null("streaming_history")
        | {
            "in:streaming_history.platform": quality.not_in("platform", ["android", "ios", "web"]),
            "range:streaming_history.ms_played": quality.outside("ms_played", 0, None),
        },
        dates=(AS_OF, "2024-03-01"),
        minimum=20,
        rows_name="plays",
    )
    tracks = checked.TableChecks(
        not_null("tracks") | {"range:tracks.popularity": quality.outside("popularity", 0, 100)},
        minimum=20,
        rows_name="tracks",
    )
    users = checked.TableChecks(not_null("users"))
    checked.write_checked(c.users, f"{base}/users", [], users, f"{base}/counts/users")
    checked.write_checked(c.tracks, f"{base}/tracks", [], tracks, f"{base}/counts/tracks")
    dated = c.plays.withColumn("date", F.to_date("played_at"))
    early = F.coalesce(F.col("date") < F.lit("2024-01-15").cast("date"), F.lit(True))
    for batch_id, batch in enumerate((dated.where(early), dated.where(~early))):
        checked.write_checked(
            batch, f"{base}/plays", ["date"], plays, f"{base}/counts/plays", batch_id
        )
    return checked.read_checks(c.spark, *[f"{base}/counts/{t}" for t in ("users", "tracks", "plays")])


def _dq_report(c: Canonical) -> DataFrame:
    return quality.dq_report(_dq_checks(c))


def _table_counts(c: Canonical) -> DataFrame:
    return union_counts(
        {
            "raw.users": c.users,
            "raw.artists": c.artists,
            "raw.albums": c.albums,
            "raw.tracks": c.tracks,
            "raw.playlists": c.playlists,
            "raw.playlist_tracks": c.playlist_tracks,
            "raw.streaming_history": c.plays,
        }
    )


def _gap_days(c: Canonical) -> DataFrame:
    return quality.find_gap_days(c.plays, "2023-12-25", "2024-02-05")


def _feed(c: Canonical) -> DataFrame:
    """The events table as a stream of JSON messages."""
    return event_values(c.stream("events"))


def _run(c: Canonical, name: str, stream: DataFrame, mode: str) -> DataFrame:
    base = scratch_path(c.spark, name)
    return ingest.run_to_files(stream, f"{base}/out", f"{base}/progress", mode)


def _stream_running_totals(c: Canonical) -> DataFrame:
    events = decode.decode_events(_feed(c), "event_type", "user_id", "song_id")
    totals = metrics.running_totals(events)
    return _run(c, "running-totals", totals, "complete")


def _stream_platforms(c: Canonical) -> DataFrame:
    events = decode.decode_events(_feed(c), "event_type", "platform")
    counts = metrics.events_by_platform(events)
    return _run(c, "platforms", counts, "complete")


def _stream_route_counts(c: Canonical) -> DataFrame:
    counts = decode.route_counts(
        decode.decode_events(_feed(c), "event_id", "event_type", "timestamp")
    )
    return _run(c, "route-counts", counts, "complete")


def _stream_sessions(c: Canonical) -> DataFrame:
    """All sessions: a row that marks the end of the input closes the last ones."""
    plays = c.stream("events").select(
        "user_id",
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.floor(F.col("value") * 3000).cast("long").alias("ms_played"),
    )
    ended = ingest.with_end_of_input(plays, scratch_path(c.spark, "end-of-input"), "event_ts")
    closed = _run(c, "sessions", ingest.stream_sessions(ended), "append")
    return closed.select(
        "user_id",
        F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        F.col("session_end").cast("timestamp_ntz").alias("session_end"),
        "tracks_in_session",
        "ms_in_session",
    )


def _out_of_order(c: Canonical) -> late_sessions.SessionTables:
    """All plays as a stream of two deliveries: every third play comes after all others."""
    base = scratch_path(c.spark, "late-sessions")
    plays = c.plays.select(
        "event_id", "user_id", F.col("played_at").cast("timestamp").alias("event_ts"), "ms_played"
    )
    second = F.col("event_id") % 3 == 0
    for delivery in (plays.where(~second), plays.where(second)):
        delivery.drop("event_id").write.mode("append").parquet(f"{base}/landing")
        feed = c.spark.readStream.schema(plays.drop("event_id").schema).parquet(f"{base}/landing")
        query = late_sessions.start_sessions(
            feed, f"{base}/tables", f"{base}/progress", {"availableNow": True}
        )
        query.awaitTermination()
    return late_sessions.SessionTables(c.spark, f"{base}/tables")


def _stream_sessions_late(c: Canonical) -> DataFrame:
    """Sessions of plays that come out of order, repaired with those that came late."""
    found = late_sessions.repaired_sessions(_out_of_order(c))
    return found.select(
        "user_id",
        F.col("first").cast("timestamp_ntz").alias("session_start"),
        (F.col("last").cast("timestamp_ntz") + F.expr("INTERVAL 30 MINUTES")).alias("session_end"),
        F.col("plays").alias("tracks_in_session"),
        F.col("ms").alias("ms_in_session"),
    )


def _stream_late_plays(c: Canonical) -> DataFrame:
    """Plays per user in sessions and in the side table: together all plays."""
    tables = _out_of_order(c)
    known = tables.closed().drop("batch_id").unionByName(tables.open())
    return (
        known.select("user_id", F.col("plays").alias("in_sessions"), F.lit(0).alias("late"))
        .unionByName(tables.late().select("user_id", F.lit(0).alias("in_sessions"), F.lit(1).alias("late")))
        .groupBy("user_id")
        .agg(F.sum("in_sessions").alias("in_sessions"), F.sum("late").alias("late"))
    )


#: Parts that the days are dealt to, in no order of time.
UPKEEP_BATCHES = 3


def _upkeep(c: Canonical, *kept: str) -> UserUpkeep:
    """States of all plays, added in batches of days out of order."""
    states = UserUpkeep(c.spark, scratch_path(c.spark, "upkeep"), fan=2, kept=kept)
    day = F.coalesce(F.unix_date(F.to_date("played_at")), F.lit(0))
    part = F.pmod(day * 7, F.lit(UPKEEP_BATCHES))
    for batch in range(UPKEEP_BATCHES):
        states.add(batch, c.plays.where(part == batch))
    return states


def _stream_dedupe(c: Canonical) -> DataFrame:
    """The feed delivered twice, ingested once: rows per target table."""
    feed = _feed(c)
    base = scratch_path(c.spark, "ingest")
    query = ingest.start_ingest(
        feed.unionByName(_feed(c)), f"{base}/tables", f"{base}/progress", {"availableNow": True}
    )
    query.awaitTermination()
    return union_counts(
        {
            table: ingest.read_ingested(c.spark, f"{base}/tables", table)
            for table in decode.TABLES.values()
        }
    )


def _stream_ingest_accounting(c: Canonical) -> DataFrame:
    """Rows stored per table and set aside, of a feed in two deliveries.

    The first has all events but those of one type.  The second has all again, every third
    with a time of two days later, and each event once more without its id.
    """
    base = scratch_path(c.spark, "accounting")
    events = c.read("events")
    later = F.when(F.col("event_id") % 3 == 0, F.expr("ts + INTERVAL 2 DAYS")).otherwise(F.col("ts"))
    nameless = F.regexp_replace("value", '"event_id":"[^"]*",', "").alias("value")
    deliveries = [
        event_values(events.where(F.col("event_type") != "purchase")).select("value"),
        event_values(events.withColumn("ts", later))
        .select("value")
        .unionByName(event_values(events).select(nameless)),
    ]
    for delivery in deliveries:
        delivery.write.mode("append").parquet(f"{base}/landing")
        feed = c.spark.readStream.schema("value string").parquet(f"{base}/landing")
        query = ingest.start_ingest(
            feed, f"{base}/tables", f"{base}/progress", {"availableNow": True}
        )
        query.awaitTermination()
    tables = [*decode.TABLES.values(), "quarantine"]
    return union_counts({t: ingest.read_ingested(c.spark, f"{base}/tables", t) for t in tables})


#: Files that the counters' feed is cut into, one per batch.
COUNTER_BATCHES = 4


def _stream_counters(c: Canonical) -> DataFrame:
    """Counters of the feed in several batches, stored as deltas that are summed in levels."""
    base = scratch_path(c.spark, "counters")
    feed = event_values(c.read("events")).select("value").repartition(COUNTER_BATCHES)
    feed.write.text(f"{base}/landing")
    fields = ("event_type", "song_id", "search_query", "error_type")
    query = (
        decode.decode_events(readers.read_event_files(c.spark, f"{base}/landing", 1), *fields)
        .writeStream.foreachBatch(ingest.write_counter_batch(f"{base}/deltas", fan=2))
        .option("checkpointLocation", f"{base}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return ingest.read_counters(c.spark, f"{base}/deltas")


def _stream_report(c: Canonical) -> DataFrame:
    events = decode.decode_events(
        _feed(c), "event_type", "user_id", "song_id", "platform", "search_query", "error_type"
    )
    return metrics.report(_run(c, "report", metrics.report_members(events), "complete"))


def _dated(c: Canonical) -> DataFrame:
    plays = c.plays.select("event_id", "user_id", "ms_played", "played_at")
    return plays.withColumn("date", F.to_date("played_at"))


def _sink_partitioned(c: Canonical) -> DataFrame:
    """Written by day twice; the second write replaces its own days only."""
    path = scratch_path(c.spark, "partitioned")
    writers.write_partitioned(_dated(c), path, ["date"])
    later = _dated(c).where(F.col("date") >= F.lit("2024-01-15").cast("date"))
    writers.write_partitioned(later, path, ["date"])
    return c.spark.read.parquet(path)


def _sink_upsert(c: Canonical) -> DataFrame:
    """An absent target filled, then a week's rows changed in place."""
    path = scratch_path(c.spark, "upserted")
    keys = ["event_id", "date"]
    writers.upsert_partitions(path, _dated(c), keys)
    week = F.col("date").between("2024-01-08", "2024-01-14")
    changed = _dated(c).where(week).withColumn("ms_played", F.col("ms_played") + 1)
    writers.upsert_partitions(path, changed, keys)
    return c.spark.read.parquet(path)


def _sink_append_new(c: Canonical) -> DataFrame:
    """The same rows appended twice are stored once."""
    path = scratch_path(c.spark, "appended")
    for _ in range(2):
        writers.append_new(path, _dated(c), ["event_id"], F.col("played_at"))
    return c.spark.read.parquet(path)


def _sink_staging(c: Canonical) -> DataFrame:
    """All days staged, loaded, and a load that finds nothing more to do."""
    base = scratch_path(c.spark, "staging")
    writers.write_partitioned(_dated(c), f"{base}/staged", ["date"])
    for _ in range(2):
        writers.load_staged_days(f"{base}/staged", f"{base}/final")
    return c.spark.read.parquet(f"{base}/final")


def _sink_versions(c: Canonical) -> DataFrame:
    """A table without a first version, filled, upserted and read in another session."""
    base = scratch_path(c.spark, "versions")
    users = c.users.select("user_id", "username", "country")
    writers.upsert_table(c.spark, base, users, ["user_id"])
    moved = users.withColumn("country", F.concat("country", F.lit("!")))
    writers.upsert_table(c.spark, base, moved, ["user_id"])
    return writers.current_version(c.spark, base)


def _sink_keyed(c: Canonical) -> DataFrame:
    """All plays committed by key, a week's changed, and all once more under other ids."""
    table = KeyedTable(c.spark, scratch_path(c.spark, "keyed"), ["event_id"], file_rows=20_000)
    plays = c.plays.select("event_id", "user_id", "ms_played", "played_at")
    table.upsert(plays)
    week = plays.where(date_between(F.col("played_at"), "2024-01-08", "2024-01-14"))
    table.upsert(week.withColumn("ms_played", F.col("ms_played") + 1))
    table.upsert(plays.withColumn("event_id", -F.col("event_id") - 1))
    table.expire(1)
    return table.read()


def _sink_insert_new(c: Canonical) -> DataFrame:
    """Plays delivered twice, in another order and with other values, are stored as they first came."""
    table = KeyedTable(c.spark, scratch_path(c.spark, "inserted"), ["event_id"], file_rows=20_000)
    plays = c.plays.select("event_id", "user_id", "ms_played", "played_at")
    table.insert_new(plays.where(F.col("ms_played") >= 30_000), F.col("played_at"))
    again = plays.withColumn("ms_played", -F.col("ms_played"))
    table.insert_new(again.union(again), F.col("played_at"))
    return table.read()


def _split_scan(c: Canonical) -> DataFrame:
    """Whether ranges of order keys hold every line once, and none over 1.5 times the mean."""
    lines = c.read("lineitem")
    ranges = splits.split_predicates(lines.select("l_orderkey"), "l_orderkey", 16)
    hits = F.array(*[F.expr(f"coalesce({condition}, false)") for condition in ranges])
    held = lines.select(F.filter(F.sequence(F.lit(0), F.lit(len(ranges) - 1)), lambda i: hits[i]).alias("at"))
    sizes = held.groupBy("at").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.size("at") != 1, F.col("n")).otherwise(0)).alias("not_in_one_range"),
        (F.max("n") <= 1.5 * F.avg("n")).alias("balanced"),
    )


def _files_json(c: Canonical) -> DataFrame:
    path = scratch_path(c.spark, "json")
    writers.write_json(c.users.select("user_id", "username", "country"), path)
    return readers.read_files(c.spark, path, "json", "user_id long, username string, country string")


def _projected(kind: str) -> Callable[[Canonical], DataFrame]:
    def rows(c: Canonical) -> DataFrame:
        projected = decode.PROJECTIONS[kind](_decoded(c)).drop("raw_data")
        return projected.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))

    return rows


_QUERIES: dict[str, Callable[[Canonical], DataFrame]] = {
    # daily statistics
    "enrich_history": _enriched,
    "user_daily_stats": lambda c: daily.user_daily_stats(_enriched(c), c.tracks, c.artists),
    "user_daily_stats_ext": lambda c: daily.user_daily_stats_ext(_enriched(c)),
    "track_daily_stats": lambda c: daily.track_daily_stats(_enriched(c)),
    "track_daily_stats_ext": lambda c: daily.track_daily_stats_ext(_enriched(c)),
    "song_daily_metrics": _song_daily,
    "user_daily_metrics": _user_daily,
    "allocate_song_metrics": lambda c: daily.allocate_song_metrics(_song_daily(c), run_ts()),
    "user_listening_habits": lambda c: daily.user_listening_habits(_user_daily(c), run_ts()),
    "user_daily_full": lambda c: daily.user_daily_full(c.plays, c.tracks, c.artists),
    "track_daily_full": lambda c: daily.track_daily_full(c.plays, c.tracks, c.artists),
    # users
    "active_users": lambda c: activity.active_users(c.plays, c.users, AS_OF),
    "active_users_range": lambda c: activity.active_users_range(
        c.plays, c.users, "2024-01-05", "2024-02-03"
    ),
    "new_users": lambda c: activity.new_users(c.users, AS_OF),
    "churned_users": lambda c: activity.churned_users(c.plays, AS_OF),
    "user_activity_summary": lambda c: activity.user_activity_summary(c.users, c.plays),
    # marts and charts
    "artist_popularity": lambda c: marts.artist_popularity(
        c.plays, c.tracks, c.artists, AS_OF, GROWTH_DAYS, run_ts()
    ),
    "track_popularity": lambda c: marts.track_popularity(
        c.plays, c.tracks, c.artists, AS_OF, GROWTH_DAYS, run_ts()
    ),
    "user_listening_stats": lambda c: marts.user_listening_stats(
        c.plays, c.tracks, c.artists, AS_OF, 30, run_ts()
    ),
    "upkeep_streaks": lambda c: _upkeep(c, "runs").listening_streaks(AS_OF),
    "upkeep_user_stats": lambda c: _upkeep(c, "tracks", "days").user_listening_stats(
        c.tracks, c.artists, AS_OF, 30, run_ts()
    ),
    "upkeep_active_users": lambda c: _upkeep(c, "words").active_users_range(
        c.users, "2024-01-05", "2024-02-03"
    ),
    "listening_streaks": lambda c: marts.listening_streaks(c.plays, AS_OF),
    "top_tracks_weekly": lambda c: marts.top_tracks_weekly(
        c.plays, c.tracks, c.artists, c.albums, AS_OF
    ),
    "user_listening_patterns": lambda c: marts.user_listening_patterns(
        _history(c), c.artists, c.users, AS_OF
    ),
    "genre_preferences": lambda c: marts.genre_preferences(
        _history(c), c.artists, AS_OF
    ),
    "hour_share": lambda c: marts.hour_share(_history(c), AS_OF),
    "day_share": lambda c: marts.day_share(_history(c), AS_OF),
    "session_stats": lambda c: sessions.session_stats(_history(c)),
    "sessionize_gap": lambda c: sessions.gap_sessions(c.plays),
    "sessionize_plays": lambda c: sessions.sessionize(
        c.plays.select("event_id", "user_id", "played_at", "ms_played")
    ),
    "top_artists_plays": lambda c: marts.top_artists(c.plays, c.tracks, c.artists),
    "top_artists_listeners": lambda c: marts.top_artists(
        c.plays, c.tracks, c.artists, "listeners"
    ),
    "top_tracks_plays": lambda c: marts.top_tracks(c.plays, c.tracks, c.artists),
    "top_tracks_listeners": lambda c: marts.top_tracks(c.plays, c.tracks, c.artists, "listeners"),
    # activity
    "daily_activity": lambda c: activity.daily_activity(c.plays),
    "daily_activity_range": lambda c: activity.daily_activity(c.plays, START, END),
    "hourly_distribution": lambda c: activity.hourly_distribution(c.plays),
    "top_tracks_daily": lambda c: activity.daily_leaderboard(
        daily.track_daily_stats(_enriched(c)), "track_id"
    ),
    "top_artists_daily": lambda c: activity.daily_leaderboard(
        activity.artist_daily_stats(_enriched(c), c.tracks), "artist_id"
    ),
    "hourly_trends": lambda c: features.hourly_trends(c.plays, c.tracks, c.artists),
    "user_features": lambda c: features.user_features(c.plays, c.tracks, c.artists),
    "activity_by_subscription": lambda c: features.activity_by(
        _history(c), "subscription_type", "week"
    ),
    "activity_by_country": lambda c: features.activity_by(_history(c), "country", "month"),
    "activity_by_device": lambda c: features.activity_by(c.plays, "device", "day"),
    "monthly_active_users": lambda c: features.monthly_active_users(c.plays),
    # extracts and changes
    "extract_history": lambda c: extracts.extract_history(c.plays, c.tracks, c.artists, AS_OF),
    "extract_tracks": lambda c: extracts.extract_tracks(c.tracks, c.artists, c.albums),
    "extract_active_users": lambda c: extracts.extract_active_users(c.users),
    "incremental_extract": _incremental,
    "processed_history": _history,
    "lookup_with_default": _lookup,
    "upsert_result": _upsert,
    "insert_new_result": _insert_new,
    "upsert_counters": _upsert_counters,
    "generate_analytics": _generate_analytics,
    "snapshot_scd2": _snapshot,
    # event feed
    "events_by_platform": lambda c: metrics.events_by_platform(
        _decoded(c, "event_type", "platform")
    ),
    "search_counts": lambda c: metrics.search_counts(
        _decoded(c, "event_type", "search_query")
    ),
    "search_terms_top": lambda c: features.search_terms_top(
        decode.project_search(_decoded(c)), 5
    ),
    "errors_by_type": lambda c: metrics.errors_by_type(
        _decoded(c, "event_type", "error_type")
    ),
    "running_totals": lambda c: metrics.running_totals(
        _decoded(c, "event_type", "user_id", "song_id")
    ),
    "auth_failure_rate": lambda c: features.auth_failure_rate(decode.project_auth(_decoded(c))),
    "playlist_action_counts": lambda c: features.playlist_action_counts(
        decode.project_playlist(_decoded(c))
    ),
    "project_song_play": _projected("song_play"),
    "project_auth": _projected("auth"),
    "project_search": _projected("search"),
    "project_playlist": _projected("playlist"),
    "project_error": _projected("error"),
    "stream_running_totals": _stream_running_totals,
    "stream_events_by_platform": _stream_platforms,
    "stream_route_counts": _stream_route_counts,
    "stream_sessions": _stream_sessions,
    "stream_sessions_late": _stream_sessions_late,
    "stream_late_plays": _stream_late_plays,
    "stream_dedupe": _stream_dedupe,
    "stream_ingest_accounting": _stream_ingest_accounting,
    "stream_counters": _stream_counters,
    "stream_report": _stream_report,
    "play_locations": lambda c: decode.located_plays(_decoded(c)).select(
        "event_id", "country", "city"
    ),
    # sinks, read back
    "sink_partitioned": _sink_partitioned,
    "sink_upsert_partitions": _sink_upsert,
    "sink_append_new": _sink_append_new,
    "sink_staging": _sink_staging,
    "sink_versions": _sink_versions,
    "sink_keyed": _sink_keyed,
    "sink_insert_new": _sink_insert_new,
    "files_json": _files_json,
    "split_scan": _split_scan,
    # quality
    "table_counts": _table_counts,
    "dq_unique": _dq_unique,
    "dq_not_null": _dq_not_null,
    "dq_fk": _dq_fk,
    "dq_range": _dq_range,
    "dq_invariants": _dq_invariants,
    "dq_checks": _dq_checks,
    "dq_observed": _dq_observed,
    "dq_report": _dq_report,
    "gap_days": _gap_days,
    "duplicates": lambda c: quality.find_duplicates(
        c.playlist_tracks, ["playlist_id", "track_id"]
    ),
}


def queries() -> dict[str, Query]:
    def bind(plan: Callable[[Canonical], DataFrame]) -> Query:
        return lambda spark, folder: comparable(plan(Canonical(spark, folder)))

    return {name: bind(plan) for name, plan in _QUERIES.items()}
