"""Physical plans of the registered queries."""

from __future__ import annotations

import pytest
from conftest import SMALL

from earshot.registry import spark_queries

BATCH = {n: q for n, q in spark_queries.queries().items() if not n.startswith("stream_")}
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonEval", "ArrowEval", "InPandas")


def plan_of(spark, name):
    return BATCH[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(BATCH))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(spark, name)
    assert not [word for word in UNWANTED if word in plan]


@pytest.mark.parametrize("name", ["enrich_history", "processed_history", "extract_active_users"])
def test_row_level_reports_do_not_shuffle(spark, name):
    assert "Exchange hashpartitioning" not in plan_of(spark, name)


def test_marts_count_before_they_join(spark):
    plan = plan_of(spark, "track_popularity")
    assert plan.count("FileScan parquet") == 3
    assert plan.index("BroadcastHashJoin") < plan.index("HashAggregate(keys=[track_id")


def test_top_k_and_group_limits(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "top_tracks_weekly")
    assert "WindowGroupLimit" in plan_of(spark, "track_daily_stats_ext")


JOINED = [
    "song_daily_metrics",
    "user_daily_metrics",
    "lookup_with_default",
    "user_daily_full",
    "extract_history",
    "artist_popularity",
    "user_listening_stats",
    "genre_preferences",
    "top_tracks_listeners",
]


@pytest.mark.parametrize("name", JOINED)
def test_plays_are_read_at_most_twice(spark, shuffled_joins, name):
    scans = plan_of(spark, name).count("/events.parquet]")
    assert 1 <= scans <= 2


def test_patterns_shuffle_little(spark, shuffled_joins):
    plan = plan_of(spark, "user_listening_patterns")
    assert plan.count("/events.parquet]") <= 2 and plan.count("Exchange ") <= 14


def test_no_expansion_of_plays_for_distinct_counts(spark):
    assert "Expand" not in plan_of(spark, "user_activity_summary")
