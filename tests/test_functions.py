from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from earshot.functions import measures as m
from earshot.functions import text
from earshot.functions import time as t


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def at(hour: int, day: int = 1):
    return F.lit(f"2024-01-{day:02d} {hour:02d}:30:00").cast("timestamp_ntz")


@pytest.mark.parametrize(
    "hour,etl,report",
    [
        (0, "night", "night"),
        (4, "night", "night"),
        (5, "morning", "morning"),
        (11, "morning", "morning"),
        (12, "afternoon", "afternoon"),
        (16, "afternoon", "afternoon"),
        (17, "evening", "afternoon"),
        (18, "evening", "evening"),
        (21, "evening", "evening"),
        (22, "night", "evening"),
        (23, "night", "evening"),
    ],
)
def test_dayparts(spark, hour, etl, report):
    assert value(spark, t.daypart_etl(at(hour))) == etl
    assert value(spark, t.daypart_report(F.lit(hour))) == report


def test_weekdays(spark):
    # 2024-01-06 is a Saturday, 2024-01-07 a Sunday, 2024-01-08 a Monday.
    assert [value(spark, t.is_weekend(at(1, d))) for d in (5, 6, 7, 8)] == [
        False,
        True,
        True,
        False,
    ]
    assert value(spark, t.weekday_monday0(at(1, 8))) == 0
    assert value(spark, t.weekday_sunday0(at(1, 7))) == 0
    assert value(spark, t.week_start(F.to_date(at(1, 7)))) == dt.date(2024, 1, 1)
    assert value(spark, t.month_start(F.to_date(at(1, 7)))) == dt.date(2024, 1, 1)


@pytest.mark.parametrize(
    "counts,label",
    [
        ((3, 1, 1, 1), "Morning (5AM-11AM)"),
        ((3, 3, 1, 1), "Afternoon (12PM-5PM)"),
        ((3, 3, 3, 1), "Evening (6PM-11PM)"),
        ((3, 3, 3, 3), "Night (12AM-4AM)"),
        ((0, 0, 0, 0), "Night (12AM-4AM)"),
    ],
)
def test_preferred_daypart(spark, counts, label):
    assert value(spark, t.preferred_daypart(*[F.lit(c) for c in counts])) == label


def test_parse_iso(spark):
    assert value(spark, t.parse_iso(F.lit("2024-01-02T03:04:05.678901Z"))) == dt.datetime(
        2024, 1, 2, 3, 4, 5, 678901
    )
    assert value(spark, t.parse_iso(F.lit("yesterday"))) is None
    default = F.lit("2024-01-01 00:00:00").cast("timestamp")
    assert value(spark, t.parse_iso(F.lit("?"), default)) == dt.datetime(2024, 1, 1)


def test_seconds_between(spark):
    assert value(spark, t.seconds_between(at(1), at(3))) == 7200


@pytest.mark.parametrize(
    "ms,duration,fixed,capped,raw,done",
    [
        (1000, 200000, 1000 / 180000, 0.005, 0.005, False),
        (400000, 200000, 1.0, 1.0, 2.0, True),
        (0, 200000, 0.0, 0.0, 0.0, False),
        (180000, 200000, 1.0, 0.9, 0.9, True),
        (1000, 0, 1000 / 180000, 0.0, None, True),
        (None, 200000, None, None, None, False),
    ],
)
def test_completion(spark, ms, duration, fixed, capped, raw, done):
    a, b = F.lit(ms).cast("long"), F.lit(duration).cast("long")
    assert value(spark, m.completion_fixed(a)) == pytest.approx(fixed)
    assert value(spark, m.completion_raw(a, b)) == pytest.approx(raw)
    assert value(spark, m.completed_flag(a, b)) == done
    if ms is not None:
        assert value(spark, m.completion_capped(a, b)) == pytest.approx(capped)


def test_growth_and_labels(spark):
    assert value(spark, m.growth_percent(F.lit(5), F.lit(0))) == 0.0
    assert value(spark, m.growth_percent(F.lit(5), F.lit(4))) == 25.0
    labels = [
        value(spark, m.trend_label(F.lit(now), F.lit(before)))
        for now, before in ((5, 0), (6, 4), (5, 4), (7, 10), (8, 10))
    ]
    assert labels == ["New", "Trending Up", "Stable", "Falling", "Stable"]


def test_scores(spark):
    assert value(spark, m.artist_score(F.lit(10), F.lit(50.0))) == pytest.approx(22.0)
    assert value(spark, m.track_score(F.lit(10), F.lit(0.25), F.lit(0.5))) == pytest.approx(31.0)
    assert value(spark, m.weekly_score(F.lit(10), F.lit(5), F.lit(0.5))) == pytest.approx(20.5)
    assert value(spark, m.track_score(F.lit(1), F.lit(None).cast("double"), F.lit(1.0))) is None


@pytest.mark.parametrize(
    "minutes,days,label",
    [
        (61.0, 21, "Heavy Listener"),
        (30.0, 10, "Regular Listener"),
        (60.0, 20, "Regular Listener"),
        (29.9, 9, "Casual Listener"),
        (61.0, 5, "Mixed Pattern"),
    ],
)
def test_listener_type(spark, minutes, days, label):
    assert value(spark, m.listener_type(F.lit(minutes), F.lit(days))) == label


def test_small_helpers(spark):
    assert value(spark, m.floor_div(F.lit(7), F.lit(2))) == 3
    assert value(spark, m.floor_div(F.lit(7), F.lit(0))) == 0
    assert value(spark, m.is_true(F.lit(None).cast("boolean"))) is False
    assert value(spark, m.non_empty(F.array().cast("array<string>"))) is False
    assert value(spark, m.cap(F.lit(2.0), 1.0)) == 1.0
    assert value(spark, m.weekday_preference(F.lit(2), F.lit(2))) == "Weekend Listener"
    assert value(spark, text.label_count(F.lit("rock"), F.lit(3))) == "rock (3)"
    assert value(spark, text.normalize_query(F.lit("Hello"))) == "hello"


def test_parse_location(spark):
    for location, country in (('{"country": "US"}', "US"), ("{oops", "unknown"), (None, "unknown")):
        parsed = text.parse_location(F.lit(location).cast("string"))
        assert value(spark, parsed["country"]) == country
        assert value(spark, parsed["city"]) == "unknown"
