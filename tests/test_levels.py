from __future__ import annotations

import json

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from earshot.sinks import files
from earshot.sinks.levels import LevelledRuns
from earshot.sources.readers import read_event_files
from earshot.streaming import event_ids, ingest
from earshot.streaming.event_ids import SeenIds

NOW = {"availableNow": True}


def summed(deltas, *_):
    return deltas.groupBy("k").agg(F.sum("n").alias("n"))


@pytest.fixture
def counted(spark, tmp_path):
    return LevelledRuns(spark, str(tmp_path / "runs"), "k string, n long", summed, fan=4)


def deltas(spark, **counts):
    return spark.createDataFrame(list(counts.items()), "k string, n long").coalesce(1)


def test_a_hundred_batches_leave_few_folders(spark, counted):
    most = 0
    for batch in range(100):
        counted.add(batch, deltas(spark, a=1, b=batch))
        most = max(most, len(files.names(spark, counted.path)))
    assert rows(summed(counted.read())) == [("a", 100), ("b", sum(range(100)))]
    # Four levels of at most four runs, and merged runs that wait for the next batch.
    assert most <= 4 * 4 + 4 * 3 and len(counted.runs()) <= 10
    assert max(level for level, _, _ in counted.runs()) == 3


def test_a_break_between_merge_and_removal_counts_nothing_twice(spark, counted):
    for batch in range(4):
        counted.add(batch, deltas(spark, a=1))
    counted.tidy(4)  # merges, and leaves the removal to the next batch
    assert files.names(spark, counted.path) == ["l0-0-0", "l0-1-1", "l0-2-2", "l0-3-3", "l1-0-3"]
    assert rows(counted.read()) == [("a", 4)]
    counted.add(4, deltas(spark, a=1))
    assert files.names(spark, counted.path) == ["l0-4-4", "l1-0-3"]
    assert rows(summed(counted.read())) == [("a", 5)]


def test_an_unfinished_merge_does_not_count(spark, counted):
    for batch in range(4):
        counted.add(batch, deltas(spark, a=1))
    deltas(spark, a=99).write.parquet(f"{counted.path}/l1-0-3")
    files.delete(spark, f"{counted.path}/l1-0-3/_SUCCESS")
    assert rows(summed(counted.read())) == [("a", 4)]
    counted.add(4, deltas(spark, a=1))
    assert rows(summed(counted.read())) == [("a", 5)] and (1, 0, 3) in counted.runs()


def test_a_repeated_batch_replaces_itself(spark, counted):
    for batch in (0, 1, 2, 3, 4, 4, 4):
        counted.add(batch, deltas(spark, a=1))
    assert rows(summed(counted.read())) == [("a", 5)]
    assert rows(summed(counted.read(before=4))) == [("a", 4)]
    counted.compact(5)
    assert [run[1:] for run in counted.runs()] == [(0, 4)] and rows(counted.read()) == [("a", 5)]


def test_nothing_stored_yet_reads_as_empty(counted):
    assert counted.read().count() == 0 and counted.runs() == []
    counted.compact(3)


def test_filters_hold_all_their_ids_and_few_others():
    draw = np.random.default_rng(1)
    hashes = draw.integers(-(2**63), 2**63 - 1, 20_000)
    bits = event_ids.bloom_filter(hashes[:10_000])
    assert event_ids.may_hold(bits, hashes[:10_000]).all()
    assert event_ids.may_hold(bits, hashes[10_000:]).mean() < 0.03
    assert len(bits) <= 10_000 * event_ids.BITS_PER_ID / 8 + 8
    assert not event_ids.may_hold(event_ids.bloom_filter(hashes[:0]), hashes).any()


def keys(spark, ids):
    found = spark.createDataFrame([(str(i),) for i in ids], "event_id string").coalesce(1)
    return found.select(F.lit("auth").alias("event_type"), "event_id")


def test_ids_of_all_batches_are_known_whatever_has_been_merged(spark, tmp_path):
    seen = SeenIds(spark, str(tmp_path / "ids"), buckets=5, fan=2)
    for batch in range(9):
        # Each batch has ten new ids and all those of the first batch again.
        fresh = seen.unseen(keys(spark, [*range(10), *range(10 * batch, 10 * batch + 10)]).distinct(), batch)
        assert sorted(int(r["event_id"]) for r in fresh.collect()) == list(range(10 * batch, 10 * batch + 10))
        seen.add(fresh, batch)
    assert seen.ids.read().count() == 90 and len(seen.ids.runs()) <= 6
    assert [r[1:] for r in seen.ids.runs()] == [r[1:] for r in seen.filters.runs()]
    # The last batch once more decides as it did.
    assert seen.unseen(keys(spark, range(75, 95)), 8).count() == 15
    assert seen.unseen(keys(spark, range(75, 95)), 9).count() == 5


def test_a_false_alarm_of_a_filter_loses_no_event(spark, tmp_path, monkeypatch):
    seen = SeenIds(spark, str(tmp_path / "ids"), buckets=3)
    seen.add(seen.hashed(keys(spark, range(50))), 0)
    monkeypatch.setattr(seen, "suspects", lambda hashed, before: hashed)
    assert seen.unseen(keys(spark, range(40, 60)), 1).count() == 10


def test_ingest_keeps_no_ids_in_memory_and_reads_the_feed_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def deliver(name, ids):
        lines = [
            json.dumps({"event_id": f"e{i}", "event_type": "search", "user_id": "u", "timestamp": "2024-01-01T00:00:00"})
            for i in ids
        ]
        (source / name).write_text("\n".join(lines) + "\n")
        query = ingest.start_ingest(
            read_event_files(spark, str(source)), str(tmp_path / "out"), str(tmp_path / "progress"), NOW
        )
        query.awaitTermination()
        progress = [p for p in query.recentProgress if p["numInputRows"]]
        assert all(p["stateOperators"] == [] and len(p["sources"]) == 1 for p in progress)
        assert sum(p["numInputRows"] for p in progress) == len(lines)

    deliver("1.json", range(100))
    deliver("2.json", range(100, 1100))  # ten times as many
    deliver("3.json", [*range(0, 1100, 7), 5000])
    stored = ingest.read_ingested(spark, str(tmp_path / "out"), "search_events")
    assert stored.count() == 1101 == stored.select("event_id").distinct().count()
