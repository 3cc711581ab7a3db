from __future__ import annotations

import datetime as dt
import random
from itertools import pairwise

import pytest
from conftest import rows
from pyspark.sql import functions as F

from earshot.operators import day_runs
from earshot.plans import activity, marts
from earshot.plans.upkeep import UserUpkeep

AS_OF = "2024-01-29"
START = dt.date(2023, 12, 20)
DAYS = "k long, d date"


def days_of(seed, n=80, keys=3, span=60):
    draw = random.Random(seed)
    return [(draw.randint(1, keys), START + dt.timedelta(days=draw.randint(0, span))) for _ in range(n)]


def plain_runs(days):
    found = []
    for key, day in sorted(set(days)):
        if found and found[-1][0] == key and (day - found[-1][2]).days == 1:
            found[-1] = (key, found[-1][1], day)
        else:
            found.append((key, day, day))
    return found


def test_runs_merge_in_any_order_and_with_overlap(spark):
    days = days_of(1)
    pieces = [days[::2], days[1::3], days[2::3], days[:20], []]  # together all, some twice
    states = [day_runs.day_runs(spark.createDataFrame(p, DAYS), "k", F.col("d")) for p in pieces]
    expected = sorted(plain_runs([d for p in pieces for d in p]), key=repr)
    for order in (states, states[::-1]):
        merged = order[0]
        for state in order[1:]:
            merged = day_runs.merge_runs(merged.unionByName(state), "k")
        assert rows(merged, "k", "first_day", "last_day") == expected


def test_streaks_are_clipped_to_the_window(spark):
    runs = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), dt.date(2024, 1, 5)), (1, dt.date(2023, 12, 1), dt.date(2023, 12, 9)), (2, dt.date(2024, 1, 4), dt.date(2024, 1, 9))],
        "k long, first_day date, last_day date",
    )
    day = lambda text: F.lit(text).cast("date")
    found = rows(day_runs.clipped_streaks(runs, "k", day("2024-01-03"), day("2024-01-09")))
    assert found == [
        (1, 3, dt.date(2024, 1, 3), dt.date(2024, 1, 5), False),
        (2, 6, dt.date(2024, 1, 4), dt.date(2024, 1, 9), True),
    ]


def test_words_answer_whether_a_key_was_active(spark):
    days = days_of(3, n=12, keys=2)
    parts = [day_runs.day_words(spark.createDataFrame(p, DAYS), "k", F.col("d")) for p in (days[:7], days[5:])]
    words = day_runs.merge_words(parts[0].unionByName(parts[1]), "k")
    assert words.where("bits = 0").isEmpty()
    spans = [(a, b) for a, b in pairwise(sorted({START + dt.timedelta(days=7 * i) for i in range(12)}))]
    spans += [(START, START), (START, START + dt.timedelta(days=90)), (START - dt.timedelta(days=40), START - dt.timedelta(days=1))]
    for first, last in spans:
        hit = day_runs.active_between(F.struct("block", "bits"), F.lit(first), F.lit(last))
        found = {r["k"] for r in words.where(hit).select("k").distinct().collect()}
        assert found == {k for k, d in days if first <= d <= last}, (first, last)


def test_words_take_days_before_1970_and_null_keys(spark):
    days = [(1, dt.date(1969, 12, 31)), (1, None), (None, dt.date(2024, 1, 1))]
    word = day_runs.day_words(spark.createDataFrame(days, DAYS), "k", F.col("d")).collect()
    assert [tuple(r) for r in word] == [(1, -1, 1 << 31)]


@pytest.fixture
def kept(spark, canonical, tmp_path):
    """States of the given plays, day by day in a random order, the last batch added twice."""
    states = UserUpkeep(spark, str(tmp_path / "states"), fan=2)
    part = F.pmod(F.xxhash64(F.to_date("played_at")), F.lit(4))
    for batch in (0, 1, 2, 3, 3):
        states.add(batch, canonical.plays.where(part == batch))
    return states


def test_reports_equal_those_over_all_plays(kept, canonical):
    c = canonical
    assert rows(kept.listening_streaks(AS_OF)) == rows(marts.listening_streaks(c.plays, AS_OF))
    range_of = ("2023-12-30", "2024-02-10")
    plain = activity.active_users_range(c.plays, c.users, *range_of)
    assert rows(kept.active_users_range(c.users, *range_of)) == rows(plain, *kept.active_users_range(c.users, *range_of).columns)
    columns = ["user_id", "unique_tracks_played", "total_plays", "favorite_artist_id", "favorite_genre", "listening_streak"]
    stats = kept.user_listening_stats(c.tracks, c.artists, AS_OF)
    assert rows(stats, *columns) == rows(marts.user_listening_stats(c.plays, c.tracks, c.artists, AS_OF), *columns)


def test_states_are_small_and_few(kept, canonical):
    users = canonical.plays.select("user_id").distinct().count()
    assert kept.words.read().count() <= 2 * 4 * users
    assert len(kept.words.runs()) <= 3 and len(kept.tracks.runs()) <= 3


def test_nothing_added_yet(spark, canonical, tmp_path):
    states = UserUpkeep(spark, str(tmp_path / "none"))
    assert states.listening_streaks(AS_OF).count() == 0
    counts = states.active_users_range(canonical.users, "2024-01-05", "2024-01-07")
    assert counts.where("count + weekly_active_count + churn_count > 0").isEmpty() and counts.count() == 3
