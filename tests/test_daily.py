"""Golden rows, cyclic plays and edge cases of the daily statistics."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows

from earshot.operators import quality
from earshot.plans import daily

PLAY = """event_id string, user_id string, track_id string, played_at timestamp, ms_played int,
    reason_start string, reason_end string, shuffle boolean, skipped boolean, platform string,
    country string"""


def plays_of(spark, data):
    return spark.createDataFrame(data, PLAY)


@pytest.fixture
def golden(spark):
    ts = dt.datetime(2023, 5, 1, 14, 30)
    return plays_of(
        spark,
        [
            ("event1", "user1", "track1", ts, 120000, "trackdone", "endplay", False, False, "mobile", "US"),
            ("event2", "user1", "track2", ts, 180000, "playbtn", "trackdone", False, False, "mobile", "US"),
            ("event3", "user1", "track3", ts, 60000, "playbtn", "forwarded", False, True, "mobile", "US"),
        ],
    )


def test_golden_user(golden):
    row = daily.user_daily_stats(daily.enrich_history(golden)).first()
    assert (row.total_tracks, row.total_time_ms, row.avg_track_duration_ms) == (3, 360000, 120000.0)
    assert (row.morning_tracks, row.afternoon_tracks, row.evening_tracks, row.night_tracks) == (
        0,
        3,
        0,
        0,
    )
    assert row.favorite_artist_id is None


def test_golden_tracks(golden):
    stats = {r.track_id: r for r in daily.track_daily_stats(daily.enrich_history(golden)).collect()}
    assert len(stats) == 3
    assert stats["track3"].total_streams == 1 and stats["track3"].skip_rate == 1.0
    assert stats["track2"].avg_completion_rate == 1.0


def test_null_lengths(spark):
    ts = dt.datetime(2023, 5, 1, 23, 0)
    plays = plays_of(
        spark,
        [
            ("a", "u", "t", ts, None, None, None, None, None, None, None),
            ("b", "u", "t", ts, 90000, None, None, None, None, None, "SE"),
        ],
    )
    enriched = daily.enrich_history(plays)
    base = daily.user_daily_stats(enriched).first()
    assert (base.total_tracks, base.avg_track_duration_ms, base.night_tracks) == (2, 90000.0, 2)
    ext = daily.user_daily_stats_ext(enriched).first()
    assert ext.avg_track_duration_ms == 45000.0 and ext.avg_completion_rate == 0.5
    assert ext.completed_tracks == 2 and ext.country is None
    track = daily.track_daily_stats_ext(enriched).first()
    assert (track.top_countries, track.peak_hour, track.skip_rate) == ("SE:1", 23, 0.0)
    only_null = daily.enrich_history(plays.where("event_id = 'a'"))
    assert daily.user_daily_stats(only_null).first().avg_track_duration_ms == 0.0
    assert daily.track_daily_stats(only_null).first().avg_completion_rate == 0.0


def cyclic(spark, n):
    plays = [
        (
            f"event{i}",
            f"user{i % 5 + 1}",
            f"track{i % 5 + 1}",
            dt.datetime(2023, 1, i % 28 + 1, i % 24),
            180000 + 1000 * i,
            None,
            None,
            False,
            i % 3 == 0,
            "web",
            ["US", "GB", None][i % 3],
        )
        for i in range(1, n + 1)
    ]
    tracks = spark.createDataFrame(
        [(f"track{k}", f"Track {k}", f"artist{k}", "album1", 200000 + 500 * k, k == 5) for k in range(1, 6)],
        "track_id string, name string, artist_id string, album_id string, duration_ms long, explicit boolean",
    )
    artists = spark.createDataFrame(
        [(f"artist{k}", f"Artist {k}", [f"genre{k}", f"genre{(k + 2) % 5 + 1}"]) for k in range(1, 6)],
        "artist_id string, name string, genres array<string>",
    )
    return plays_of(spark, plays), tracks, artists


@pytest.mark.parametrize("n", [50, 5000])
def test_invariants(spark, n):
    plays, tracks, artists = cyclic(spark, n)
    users = daily.user_daily_full(plays, tracks, artists)
    per_track = daily.track_daily_full(plays, tracks, artists)
    ext = daily.user_daily_stats_ext(daily.enrich_history(plays))
    checks = quality.union(
        quality.check_user_invariants(users),
        quality.check_track_invariants(per_track),
        quality.check_user_invariants(ext, "ext"),
    )
    assert {r.check_name for r in checks.collect() if r.violations} == set()
    assert users.count() <= n and sum(r.total_tracks for r in users.collect()) == n


@pytest.mark.parametrize("duration,ms,completion", [(200000, 1000, 0.005), (200000, 400000, 1.0), (200000, 0, 0.0), (0, 5000, 0.0)])
def test_edge_completion(spark, duration, ms, completion):
    plays = plays_of(
        spark,
        [("a", "u", "t", dt.datetime(2023, 5, 6, 8), ms, None, None, None, False, None, None)],
    )
    tracks = spark.createDataFrame(
        [("t", "T", "x", "al", duration, True)],
        "track_id string, name string, artist_id string, album_id string, duration_ms long, explicit boolean",
    )
    artists = spark.createDataFrame([("x", "X", ["pop"])], "artist_id string, name string, genres array<string>")
    row = daily.user_daily_full(plays, tracks, artists).first()
    assert row.completion_rate == pytest.approx(completion)
    assert (row.weekend_tracks, row.explicit_tracks, row.top_genre, row.top_artist_id) == (1, 1, "pop", "x")


def test_allocation_and_habits(spark):
    song_daily = spark.createDataFrame(
        [("s", dt.date(2024, 1, 1), 10, 7, 100.0, 0.5, {"web": 6, "ios": 4}, {"US": 9, "GB": 1})],
        """song_id string, date date, play_count long, unique_listeners long, avg_ms_played double,
        skip_rate double, platforms map<string,long>, countries map<string,long>""",
    )
    got = rows(
        daily.allocate_song_metrics(song_daily), "country", "platform", "play_count", "unique_listeners"
    )
    # US/web 5.4, US/ios 3.6; both GB shares are below one play and dropped.
    assert got == [("US", "ios", 3, 2), ("US", "web", 5, 3)]
    users = spark.createDataFrame(
        [("u", dt.date(2024, 1, 1), 3, 3, 2, 1001, "A", {"web": 1, "ios": 1, "tv": 1})],
        """user_id string, date date, song_count long, unique_songs long, unique_artists long,
        total_listening_time long, top_artist string, platforms map<string,long>""",
    )
    habits = daily.user_listening_habits(users).first()
    assert (habits.avg_session_duration, habits.platform, habits.top_genre) == (333, "ios", "unknown")


def test_range_includes_whole_end_day(spark):
    plays, tracks, artists = cyclic(spark, 50)
    albums = spark.createDataFrame([("album1", "Album")], "album_id string, name string")
    got = daily.song_daily_metrics(plays, tracks, artists, albums, "2023-01-02", "2023-01-02")
    expected = plays.where("to_date(played_at) = DATE '2023-01-02'").count()
    assert sum(r.play_count for r in got.collect()) == expected > 0
