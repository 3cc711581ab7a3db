from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from earshot.operators import changes, filters, grouping, joins, quality, sessions, windows
from earshot.plans import activity, marts

D = dt.date


def ts(day: int, hour: int = 0, minute: int = 0):
    return dt.datetime(2024, 1, day, hour, minute)


def skewed(spark, n=3000):
    """A third of the rows on one key, some keys without a dimension row, some null."""
    chooser = random.Random(7)
    data = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{chooser.randrange(40)}")
        data.append((i, key, i % 11))
    return spark.createDataFrame(data, "id long, track_id string, v long")


def test_a_hot_key_is_split_by_its_size(spark, shuffled_joins):
    """A third of the rows on one track: no task of the join gets all of them."""
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        plays = spark.range(120_000, numPartitions=32).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("track_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        tracks = spark.range(120_000).select(F.col("id").alias("track_id"), F.lit("a").alias("artist_id"))
        joined = joins.join_tracks(plays, tracks, "artist_id")
        placed = joined.withColumn("p", F.spark_partition_id()).groupBy("p")
        sizes = [r["n"] for r in placed.agg(F.count("*").alias("n"), F.max("payload")).collect()]
        assert sum(sizes) == 120_000
        assert max(sizes) < 40_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_fill_spine_and_trend(spark):
    hours = spark.createDataFrame([(0, 6), (1, 3), (23, 9)], "hour int, play_count long")
    filled = windows.centered_avg(
        joins.fill_spine(hours, "hour", 0, 23), "hour", "play_count", 3, "trend"
    )
    got = {r.hour: (r.play_count, r.trend) for r in filled.collect()}
    assert len(got) == 24
    assert got[0] == (6, None) and got[23] == (9, None)
    assert got[1] == (3, 3.0) and got[2] == (0, 1.0) and got[22] == (0, 3.0)


def test_rank_all_equals_row_number(spark):
    chooser = random.Random(3)
    data = [(D(2024, 1, 1 + (i % 3 == 0)), f"t{i:04d}", chooser.randrange(5)) for i in range(2000)]
    df = spark.createDataFrame(data, "date date, track_id string, n long").repartition(7)
    order = [F.desc("n"), F.asc("track_id")]
    expected = rows(windows.rank_within(df, ["date"], *order), "date", "track_id", "rank")
    assert rows(windows.rank_all(df, ["date"], "n", "track_id"), "date", "track_id", "rank") == expected
    numbers = spark.range(20_000).select(
        F.lit("d").alias("date"), F.col("id").alias("track_id"), (F.col("id") % 2).alias("n")
    )
    ranked = windows.rank_all(numbers, ["date"], "n", "track_id")
    assert ranked.where("n = 1").agg(F.max("rank")).first()[0] == 10_000
    wrong = ranked.where("rank <> if(n = 1, (track_id + 1) / 2, 10000 + track_id / 2 + 1)")
    assert wrong.count() == 0


def test_streaks(spark):
    days = [("u", D(2024, 1, d)) for d in (3, 4, 5, 8, 9)] + [("v", D(2024, 1, 10))]
    df = spark.createDataFrame(days, "user_id string, day date")
    got = rows(
        windows.streaks(df, "user_id", "day", "2024-01-10"), "user_id", "streak_length", "is_current"
    )
    # A run through the reference day itself is not current.
    assert got == [("u", 2, True), ("u", 3, False), ("v", 1, False)]


def brute_sessions(plays, gap):
    out, last, number = {}, {}, {}
    for user, when, event in sorted(plays):
        if user not in last or when - last[user] > gap:
            number[user] = number.get(user, 0) + 1
        last[user] = when
        out[event] = number[user]
    return out


def test_sessions_against_brute_force(spark):
    chooser = random.Random(11)
    start = dt.datetime(2024, 1, 1)
    plays = []
    for i in range(1500):
        user = "hot" if i % 3 == 0 else f"u{chooser.randrange(5)}"
        plays.append((user, start + dt.timedelta(minutes=chooser.randrange(20000)), i))
    # Gaps of exactly the limit, and just above it.
    for k, offset in enumerate((0, 30 * 60, 60 * 60 + 1)):
        plays.append(("edge", start + dt.timedelta(seconds=offset), 2000 + k))
    df = spark.createDataFrame(
        [(u, w, e, 60000) for u, w, e in plays],
        "user_id string, played_at timestamp_ntz, event_id long, ms_played long",
    )
    expected = brute_sessions(plays, dt.timedelta(minutes=30))
    got = {r.event_id: r.session_no for r in sessions.sessionize(df).collect()}
    assert got == expected
    assert [got[2000], got[2001], got[2002]] == [1, 1, 2]
    per_session = sessions.gap_sessions(df)
    assert per_session.agg(F.sum("tracks_in_session")).first()[0] == len(plays)
    assert per_session.count() == len({(u, expected[e]) for u, _, e in plays})


def test_filters(spark):
    df = spark.createDataFrame(
        [(i, w) for i, w in enumerate([ts(1), ts(1, 23), ts(2), ts(3), ts(8), ts(9)])],
        "id int, played_at timestamp_ntz",
    )
    t = F.col("played_at")

    def ids(condition):
        return [r.id for r in df.where(condition).orderBy("id").collect()]

    assert ids(filters.on_date(t, "2024-01-01")) == [0, 1]
    assert ids(filters.date_between(t, "2024-01-01", "2024-01-02")) == [0, 1, 2]
    assert ids(filters.trailing(t, "2024-01-09", 7)) == [2, 3, 4]
    assert ids(filters.since(t, "2024-01-09", 1)) == [4, 5]
    # The instant on the boundary belongs to both windows.
    assert ids(filters.previous_window(t, "2024-01-09", 1)) == [4]
    assert filters.maybe_between(df, None, "2024-01-02").count() == 6
    assert filters.maybe_between(df, "2024-01-01", "2024-01-02").count() == 3


def test_date_filter_reaches_the_scan(canonical, capsys):
    canonical.plays.where(filters.on_date(F.col("played_at"), "2024-01-05")).select(
        "user_id"
    ).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


def test_grouping_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("a", None), ("b", None), ("b", "z")], "k string, v string"
    )
    assert rows(grouping.most_frequent(df, "k", "v", "top")) == [("a", "x"), ("b", "z")]
    assert rows(grouping.top_n_string(df, "k", "v", "top")) == [("a", "x:1,y:1"), ("b", "z:1")]
    maps = {r.k: r.m for r in grouping.freq_map(df, "k", "v", "m").collect()}
    assert maps == {"a": {"x": 1, "y": 1, "unknown": 1}, "b": {"z": 1, "unknown": 1}}


def test_facets(spark):
    df = spark.createDataFrame(
        [("u", "a", ["p", "q"], 2, 10), ("u", "b", ["q"], 3, 5), ("u", None, None, 1, 1)],
        "k string, artist string, genres array<string>, n long, ms long",
    )
    facets = grouping.facet_counts(
        df,
        "k",
        {"artist": F.col("artist")},
        ("genre", F.col("genres")),
        F.col("n"),
        {"ms": F.col("ms")},
    )
    row = facets.groupBy("k").agg(
        F.sum("ms").alias("ms"),
        grouping.facet_top("artist").alias("artist"),
        grouping.facet_top("genre").alias("genre"),
        grouping.facet_size("artist").alias("artists"),
        grouping.facet_total("genre").alias("genre_plays"),
    ).first()
    assert tuple(row) == ("u", 16, "b", "q", 2, 7)


def test_upsert_keeps_created_and_other_columns(spark):
    target = spark.createDataFrame(
        [(1, 10, "x", "old", "old"), (2, 20, "y", "old", "old")],
        "k int, n int, extra string, created_at string, updated_at string",
    )
    updates = spark.createDataFrame(
        [(2, None, "new", "new"), (3, 30, "new", "new")],
        "k int, n int, created_at string, updated_at string",
    )
    assert rows(changes.upsert(target, updates, ["k"])) == [
        (1, 10, "x", "old", "old"),
        (2, None, "y", "old", "new"),
        (3, 30, None, "new", "new"),
    ]
    only_n = changes.upsert(target, updates, ["k"], update_cols=["n"])
    assert rows(only_n)[1] == (2, None, "y", "old", "old")


def test_insert_new_and_dedupe(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "b"), (2, "d"), (2, "c")], "k int, v string")
    assert rows(changes.insert_new(target, batch, ["k"], F.col("v"))) == [(2, "c")]


def test_counters(spark):
    target = spark.createDataFrame(
        [("play", "s1", 2, "old"), ("play", "s2", 1, "old")],
        "metric_type string, entity_id string, count long, last_updated string",
    )
    deltas = spark.createDataFrame(
        [("play", "s1", 3), ("play", "s3", 1), ("play", "s1", 1)],
        "metric_type string, entity_id string, count long",
    )
    assert rows(changes.upsert_counters(target, deltas, F.lit("now"))) == [
        ("play", "s1", 6, "now"),
        ("play", "s2", 1, "old"),
        ("play", "s3", 1, "now"),
    ]


def test_scd2(spark):
    def dim(data):
        return changes.build_dim(spark.createDataFrame(data, "id int, plan string"), "id", ["plan"])

    history = dim([(1, "free"), (2, "free")]).withColumns(
        {"valid_from": F.lit("2024-01-01").cast("timestamp"), "valid_to": F.lit(None).cast("timestamp")}
    )
    now = F.lit("2024-02-01").cast("timestamp")
    after = changes.snapshot_scd2(history, dim([(1, "premium"), (2, "free"), (3, "duo")]), "id", now)
    got = rows(after, "id", "plan", "valid_from", "valid_to")
    jan, feb = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    assert got == [(1, "free", jan, feb), (1, "premium", feb, None), (2, "free", jan, None), (3, "duo", feb, None)]
    # A second run without changes leaves the history as it is.
    later = F.lit("2024-03-01").cast("timestamp")
    again = changes.snapshot_scd2(after, dim([(1, "premium"), (2, "free"), (3, "duo")]), "id", later)
    assert rows(again, "id", "plan", "valid_from", "valid_to") == got


def test_active_users_range_equals_single_days(spark, canonical):
    plays, users = canonical.plays, canonical.users
    columns = ["date", "count", "weekly_active_count", "monthly_active_count", "new_users_count", "churn_count"]
    ranged = rows(activity.active_users_range(plays, users, "2024-01-27", "2024-02-03"), *columns)
    single = []
    for day in ("2024-01-27", "2024-01-30", "2024-02-01", "2024-02-03"):
        single += rows(activity.active_users(plays, users, day), *columns)
    assert set(single) <= set(ranged) and len(ranged) == 8


def test_namesakes_merge(spark):
    tracks = spark.createDataFrame(
        [(1, "Song", "a1"), (2, "Song", "a2")], "track_id int, name string, artist_id string"
    )
    artists = spark.createDataFrame([("a1", "Same"), ("a2", "Same")], "artist_id string, name string")
    plays = spark.createDataFrame(
        [(1, "u"), (1, "u"), (2, "u"), (2, "v")], "track_id int, user_id string"
    )
    assert rows(marts.top_artists(plays, tracks, artists)) == [("Same", 4)]
    assert rows(marts.top_artists(plays, tracks, artists, "listeners")) == [("Same", 2)]
    with pytest.raises(ValueError):
        marts.top_tracks(plays, tracks, artists, "minutes")


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, None, 50), (None, "c", None)], "k int, v string, n int")
    parent = spark.createDataFrame([("a",)], "v string")
    results = quality.union(
        quality.check_unique(df, "t", "k"),
        quality.check_not_null(df, "t", "k", "v"),
        quality.check_range(df, "t", n=(0, 10)),
        quality.check_in(df, "t", v=["a", "b"]),
        quality.check_fk(df, "t", "v", parent),
        quality.check_schemas(spark, ["default", "no_such_schema"]),
        quality.check_flow(df, df.where("k > 5")),
    )
    got = {r.check_name: (r.violations, r.status) for r in results.collect()}
    assert got == {
        "unique:t.k": (1, "failure"),
        "not_null:t.k": (1, "failure"),
        "not_null:t.v": (1, "failure"),
        "range:t.n": (1, "failure"),
        "in:t.v": (1, "failure"),
        "fk:t.v": (1, "failure"),
        "schema:default": (0, "success"),
        "schema:no_such_schema": (1, "failure"),
        "min_rows:raw": (0, "success"),
        "min_rows:mart": (1, "failure"),
    }
    assert quality.dq_report(results).first().success_rate == pytest.approx(20.0)


def test_require_rows(canonical):
    assert quality.require_rows_for_date(canonical.plays, "2024-01-05") > 0
    with pytest.raises(ValueError):
        quality.require_rows_for_date(canonical.plays, "2025-01-05")


def test_sessionize_keeps_plays_without_user_or_time(spark):
    data = [(1, "u", ts(1, 10), 5), (2, None, ts(1, 10), 5), (3, "u", None, 5), (4, "u", ts(1, 10, 20), 5)]
    plays = spark.createDataFrame(data, "event_id int, user_id string, played_at timestamp, ms_played int")
    got = {r.event_id: r.session_no for r in sessions.sessionize(plays).collect()}
    assert set(got) == {1, 2, 3, 4} and got[1] == got[4] is not None and got[2] is None


def test_first_row_of_equal_order_is_defined(spark):
    data = [("k", 1, "b"), ("k", 1, "a"), ("k", 2, "0")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "key string, at int, v string").repartition(3)
        assert rows(changes.dedupe_first(df, ["key"], F.col("at"))) == [("k", 1, "a")]


def test_country_of_equal_times_is_that_of_the_smallest_event(spark):
    from earshot.plans import daily

    data = [(i, "u", 1, dt.datetime(2024, 1, 1), 1000, c) for i, c in ((2, "AT"), (1, "ZA"), (3, "BE"))]
    plays = spark.createDataFrame(
        data, "event_id int, user_id string, track_id int, timestamp timestamp, ms_played long, country string"
    ).withColumns(
        {
            "date": F.to_date("timestamp"),
            "skipped": F.lit(False),
            "completion_ratio": F.lit(1.0),
            "time_of_day": F.lit("morning"),
        }
    )
    assert daily.user_daily_stats_ext(plays).first()["country"] == "ZA"
