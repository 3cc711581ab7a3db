from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from earshot.operators import sessions
from earshot.sources.readers import read_event_files
from earshot.streaming import decode, ingest, metrics

NOW = {"availableNow": True}


def play(i, user="u1", song="s1", when="2024-01-01T10:00:00", **extra):
    return {"event_id": f"p{i}", "event_type": "song_play", "user_id": user, "song_id": song, "timestamp": when, **extra}


LINES = [
    play(1, platform="web", ms_played=1000, location={"country": "US", "city": "X"}),
    play(2, user="u2", song="s2"),
    {"event_id": "a1", "event_type": "auth", "user_id": "u3", "timestamp": "2024-01-01T10:00:01Z", "auth_type": "google", "success": False, "metadata": {"attempt_number": 2}},
    {"event_id": "s1", "event_type": "search", "user_id": "u1", "timestamp": "2024-01-01T10:00:02", "search_query": "Jazz", "platform": "ios"},
    {"event_id": "l1", "event_type": "playlist", "user_id": "u1", "timestamp": "2024-01-01T10:00:03", "action_type": "create", "playlist_id": "pl", "platform": "ios"},
    {"event_id": "e1", "event_type": "error", "user_id": "u9", "timestamp": "2024-01-01T10:00:04", "error_type": "api_error", "platform": "ios"},
    {"event_id": "x1", "event_type": "dance", "user_id": "u1", "timestamp": "2024-01-01T10:00:05"},
    play(3, when="not a time"),
    {**play(9), "event_id": None},
]
TEXT = [json.dumps(line) for line in LINES] + ["{broken"]


@pytest.fixture
def events(spark):
    feed = spark.createDataFrame([(line,) for line in TEXT], "value string")
    return decode.decode_events(feed)


def test_projections_and_defaults(events):
    plays = {r.event_id: r for r in decode.project_song_play(events).collect()}
    assert set(plays) == {"p1", "p2"}
    assert plays["p1"].location == '{"city":"X","country":"US"}' or json.loads(
        plays["p1"].location
    ) == {"city": "X", "country": "US"}
    assert (plays["p2"].platform, plays["p2"].ms_played, plays["p2"].location) == ("unknown", 0, "{}")
    assert json.loads(plays["p1"].raw_data)["ms_played"] == 1000
    auth = decode.project_auth(events).first()
    assert (auth.success, auth.auth_type, auth.country) == (False, "google", "")
    assert auth.timestamp == dt.datetime(2024, 1, 1, 10, 0, 1)
    search = decode.project_search(events).first()
    assert (search.search_query, search.result_count) == ("jazz", 0)
    assert decode.project_playlist(events).first().song_id is None
    assert decode.project_error(events).first().error_code == "api_error"


def test_quarantine(events):
    reasons = sorted(r.reason for r in decode.quarantine(events).collect())
    assert reasons == ["missing id", "undecodable", "unknown event type", "unreadable timestamp"]
    counts = dict(rows(decode.route_counts(events)))
    assert counts == {"song_plays": 2, "auth_events": 1, "search_events": 1, "playlist_events": 1, "system_errors": 1, "quarantine": 4}


def test_metrics(events):
    assert dict(rows(metrics.running_totals(events))) == {"song_plays_count": 4, "unique_users": 3, "unique_songs": 2}
    assert dict(rows(metrics.events_by_platform(events))) == {"web": 1, "ios": 3, "unknown": 4}
    assert rows(metrics.search_counts(events)) == [("jazz", 1)]
    assert rows(metrics.errors_by_type(events)) == [("api_error", 1)]
    top = metrics.top_of(metrics.events_by_platform(events), "platform", 1)
    assert rows(top) == [("unknown", 4)]
    report = rows(metrics.report(metrics.report_members(events), 2))
    assert report == [
        ("errors", "api_error", 1),
        ("platforms", "ios", 3),
        ("platforms", "unknown", 4),
        ("searches", "jazz", 1),
        ("totals", "song_plays_count", 4),
        ("totals", "unique_songs", 2),
        ("totals", "unique_users", 3),
    ]
    assert dict(rows(metrics.approximate_totals(events))) == {"unique_users": 3, "unique_songs": 2}


def write_lines(path, name, lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")


def test_ingest_is_once_per_event_across_restarts(spark, tmp_path):
    source, tables, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")

    def run():
        query = ingest.start_ingest(read_event_files(spark, str(source)), tables, progress, NOW)
        query.awaitTermination()

    write_lines(source, "1.json", TEXT + TEXT)
    run()
    # The same events again, one of them with another date, one new play, one late by months.
    moved = json.dumps(play(1, when="2024-01-09T10:00:00"))
    write_lines(source, "2.json", [*TEXT, moved, json.dumps(play(4)), json.dumps(play(5, when="2023-06-01T00:00:00"))])
    run()
    plays = ingest.read_ingested(spark, tables, "song_plays")
    assert rows(plays, "event_id") == [("p1",), ("p2",), ("p4",), ("p5",)]
    assert ingest.read_ingested(spark, tables, "auth_events").count() == 1
    assert ingest.read_ingested(spark, tables, "quarantine").count() == 12


def test_ingest_goes_on_after_a_batch_without_a_type(spark, tmp_path):
    source, tables, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")

    def run():
        query = ingest.start_ingest(read_event_files(spark, str(source)), tables, progress, NOW)
        query.awaitTermination()

    write_lines(source, "1.json", [json.dumps(play(1))])
    run()
    assert ingest.read_ingested(spark, tables, "search_events").count() == 0
    write_lines(source, "2.json", TEXT)
    run()
    write_lines(source, "3.json", ["{broken"])
    run()
    counts = {t: ingest.read_ingested(spark, tables, t).count() for t in [*decode.TABLES.values(), "quarantine"]}
    assert counts == {
        "song_plays": 2,
        "auth_events": 1,
        "search_events": 1,
        "playlist_events": 1,
        "system_errors": 1,
        "quarantine": 5,
    }


def test_repeated_batch_replaces_itself(spark, tmp_path):
    batch = decode.decode_events(spark.createDataFrame([(t,) for t in TEXT], "value string"))
    write = ingest.write_event_batch(str(tmp_path / "t"))
    write(batch, 0)
    write(batch, 0)
    assert rows(spark.read.parquet(str(tmp_path / "t/song_plays")), "event_id") == [("p1",), ("p2",)]
    counters = ingest.write_counter_batch(str(tmp_path / "c"))
    counters(batch, 0)
    counters(batch, 0)
    counters(batch, 1)
    got = rows(ingest.read_counters(spark, str(tmp_path / "c")))
    assert ("song_play", "s1", 6) in got and ("search", "jazz", 2) in got and len(got) == 4
    ingest.compact_counters(spark, str(tmp_path / "c"), 1)
    assert rows(ingest.read_counters(spark, str(tmp_path / "c"))) == got
    counters(batch, 2)
    ingest.compact_counters(spark, str(tmp_path / "c"), 3)
    more = rows(ingest.read_counters(spark, str(tmp_path / "c")))
    assert more == [(a, b, n * 3 // 2) for a, b, n in got]


def test_report_of_a_running_metric(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "1.json", TEXT)
    seen = []
    query = metrics.metrics_query(
        decode.decode_events(read_event_files(spark, str(source))),
        metrics.events_by_platform,
        lambda batch, _: seen.append(rows(metrics.top_of(batch, "platform", 2))),
        str(tmp_path / "progress"),
        NOW,
    )
    query.awaitTermination()
    assert seen[-1] == [("ios", 3), ("unknown", 4)]


def test_stream_dedupe_within_watermark(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "1.json", [json.dumps(play(1)), json.dumps(play(1)), json.dumps(play(2))])
    stream = ingest.dedupe(decode.decode_events(read_event_files(spark, str(source))))
    out = ingest.run_to_files(stream, str(tmp_path / "out"), str(tmp_path / "progress"))
    assert rows(out, "event_id") == [("p1",), ("p2",)]


def test_stream_sessions_equal_batch_sessions(spark, canonical, tmp_path):
    """Time-ordered files, one per trigger; a late marker event closes all sessions."""
    source = tmp_path / "in"
    source.mkdir()
    plays = canonical.plays.select("user_id", F.col("played_at").cast("timestamp").alias("event_ts"), "ms_played")
    schema = plays.schema
    ordered = plays.toPandas().sort_values("event_ts")
    third = len(ordered) // 3 + 1
    for i in range(3):
        part = ordered.iloc[i * third : (i + 1) * third]
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(source / f"{i}"))
    marker = [(-1, dt.datetime(2024, 6, 1), 0)]
    spark.createDataFrame(marker, schema).coalesce(1).write.parquet(str(source / "3"))
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    )
    closed = ingest.run_to_files(
        ingest.stream_sessions(stream), str(tmp_path / "out"), str(tmp_path / "progress")
    )
    got = rows(closed.where("user_id >= 0"), "user_id", "tracks_in_session", "ms_in_session")
    batch = sessions.gap_sessions(canonical.plays)
    expected = rows(
        batch.select("user_id", "tracks_in_session", F.round(F.col("session_minutes") * 60000).cast("long").alias("ms"))
    )
    assert got == expected
