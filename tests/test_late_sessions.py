from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from earshot.operators import sessions
from earshot.streaming import late_sessions

SCHEMA = "user_id long, event_ts timestamp, ms_played long"
START = dt.datetime(2024, 1, 1)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def batch_sessions(plays, gap=30):
    """Sessions of plain (user, time, ms) rows: (user, first, last, plays, ms)."""
    found = []
    for user, when, ms in sorted(p for p in plays if p[0] is not None and p[1] is not None):
        if found and found[-1][0] == user and when - found[-1][2] <= dt.timedelta(minutes=gap):
            found[-1] = (user, found[-1][1], when, found[-1][3] + 1, found[-1][4] + ms)
        else:
            found.append((user, when, when, 1, ms))
    return found


@pytest.fixture
def feed(spark, tmp_path):
    """Hands batches to the writer as a stream would."""
    path = str(tmp_path / "sessions")
    write = late_sessions.write_session_batch(path)

    def deliver(batch_id, plays):
        write(spark.createDataFrame(plays, SCHEMA).coalesce(2), batch_id)
        return late_sessions.SessionTables(spark, path)

    return deliver


def test_late_plays_go_aside_and_are_merged_in(feed):
    feed(0, [(1, at(0), 10), (1, at(20), 10), (2, at(5), 7)])
    tables = feed(1, [(1, at(200), 10), (2, at(195), 1)])
    assert rows(tables.closed(), "user_id", "first", "last", "plays") == [(1, at(0), at(20), 2), (2, at(5), at(5), 1)]
    # One joins two sessions of user 1, one is in time, two say nothing of a session.
    tables = feed(2, [(1, at(40), 5), (1, at(195), 5), (None, at(1), 1), (3, None, 1)])
    assert rows(tables.late(), "user_id", "reason") == [(1, "late"), (3, "no time"), (None, "no user")]
    found = rows(late_sessions.repaired_sessions(tables), "user_id", "first", "last", "plays", "ms")
    assert found == [
        (1, at(0), at(40), 3, 25),
        (1, at(195), at(200), 2, 15),
        (2, at(5), at(5), 1, 7),
        (2, at(195), at(195), 1, 1),
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_sessions_and_side_table_are_all_plays_in_any_order(spark, feed, seed):
    draw = random.Random(seed)
    plays = [(draw.randint(1, 4), at(draw.randint(0, 3000)), draw.randint(1, 99)) for _ in range(300)]
    plays.sort(key=lambda p: p[1] + dt.timedelta(minutes=draw.choice([0, 0, 5, 40, 900])))
    for batch in range(6):
        tables = feed(batch, plays[batch * 50 : batch * 50 + 50])
    n_late = tables.late().count()
    in_sessions = tables.closed().drop("batch_id").unionByName(tables.open()).agg(F.sum("plays")).first()[0]
    assert n_late > 10 and in_sessions + n_late == 300
    found = late_sessions.repaired_sessions(tables).select("user_id", "first", "last", "plays", "ms")
    assert sorted(tuple(r) for r in found.collect()) == batch_sessions(plays)


def test_a_repeated_batch_writes_the_same(feed):
    feed(0, [(1, at(0), 1)])
    feed(1, [(1, at(100), 1), (1, at(50), 1)])
    once = rows(late_sessions.repaired_sessions(feed(2, [(1, at(300), 1), (1, at(3), 1)])))
    tables = feed(2, [(1, at(300), 1), (1, at(3), 1)])
    assert rows(late_sessions.repaired_sessions(tables)) == once
    assert tables.late().count() == 1 and tables.closed().agg(F.sum("plays")).first()[0] == 3


def test_batches_without_plays(feed):
    assert feed(0, []).open().count() == 0
    feed(1, [(1, at(0), 1)])
    tables = feed(2, [])
    assert tables.open().count() == 1 and late_sessions.repaired_sessions(tables).count() == 1


def test_merging_is_associative(spark):
    draw = random.Random(5)
    plays = [(1, at(draw.randint(0, 2000)), 1) for _ in range(120)]
    parts = [sessions.slot_intervals(spark.createDataFrame(plays[k::3], SCHEMA), "event_ts") for k in range(3)]
    merged = sessions.merge_intervals
    left = merged(merged(parts[0].unionByName(parts[1])).unionByName(parts[2]))
    right = merged(parts[0].unionByName(merged(parts[2].unionByName(parts[1]))))
    expected = batch_sessions(plays)
    names = ("user_id", "first", "last", "plays", "ms")
    assert rows(left, *names) == rows(right, *names) == sorted(expected, key=repr)
