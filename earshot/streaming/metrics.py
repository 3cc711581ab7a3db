"""Running metrics of the feed: totals, counts by platform, query and error type.

The same functions serve a batch frame and a stream.  On a stream they need complete or
update output; their state grows with the distinct keys, as "since the start" implies.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from earshot.functions.text import normalize_query
from earshot.operators.filters import of_type
from earshot.operators.grouping import count_by, top_k
from earshot.streaming.decode import EVENT_TYPES, platform

REPORT_INTERVAL = "30 seconds"
REPORT_TOP = 5


def known(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type").isin(*EVENT_TYPES))


def metric_members(events: DataFrame) -> DataFrame:
    """(metric, member) pairs whose distinct members are counted: users and songs.

    Errors do not count towards the users.
    """
    plays, users = F.col("event_type") == "song_play", F.col("event_type") != "error"
    pairs = F.array(
        F.struct(F.lit("unique_users").alias("metric"), F.when(users, F.col("user_id")).alias("member")),
        F.struct(F.lit("unique_songs").alias("metric"), F.when(plays, F.col("song_id")).alias("member")),
    )
    return known(events).select(F.inline(pairs)).where(F.col("member").isNotNull())


def running_totals(events: DataFrame) -> DataFrame:
    """Rows (metric, value): song plays, distinct users and distinct songs.

    Exact: duplicates of a member are dropped first, then the members are counted.
    """
    plays = of_type(events, "song_play").select(
        F.lit("song_plays_count").alias("metric"), F.lit(None).cast("string").alias("member")
    )
    members = metric_members(events).dropDuplicates(["metric", "member"])
    return count_by(plays.unionByName(members), "metric", "value")


def approximate_totals(events: DataFrame) -> DataFrame:
    """The distinct counts with a fixed-size sketch per metric instead of all members."""
    return metric_members(events).groupBy("metric").agg(
        F.approx_count_distinct("member").alias("value")
    )


def events_by_platform(events: DataFrame) -> DataFrame:
    """Counts per platform; events without one (all auth events) are ``unknown``."""
    return count_by(known(events).withColumn("platform", platform()), "platform", "events")


def search_counts(events: DataFrame) -> DataFrame:
    searches = of_type(events, "search").withColumn(
        "search_query", normalize_query(F.col("search_query"))
    )
    return count_by(searches, "search_query", "searches")


def errors_by_type(events: DataFrame) -> DataFrame:
    errors = of_type(events, "error").withColumn(
        "error_type", F.coalesce("error_type", F.lit("unknown"))
    )
    return count_by(errors, "error_type", "errors")


def top_of(counts: DataFrame, key: str, n: int = REPORT_TOP) -> DataFrame:
    """First ``n`` rows of a counts frame, for the report of one batch."""
    measure = next(c for c in counts.columns if c != key)
    return top_k(counts, measure, n, key)


def report_members(events: DataFrame) -> DataFrame:
    """(section, key, member, n): what one running report counts, from one reading of the feed.

    Rows with a member stand for a distinct count of their key, rows without one for a plain
    count.
    """
    plays, searches = F.col("event_type") == "song_play", F.col("event_type") == "search"
    errors = F.col("event_type") == "error"
    nobody = F.lit(None).cast("string")

    def row(section: str, key: Column, member: Column, where: Column) -> Column:
        return F.when(
            where,
            F.struct(
                F.lit(section).alias("section"), key.alias("key"), member.alias("member")
            ),
        )

    rows = F.array_compact(
        F.array(
            row("totals", F.lit("song_plays_count"), nobody, plays),
            row("totals", F.lit("unique_users"), F.col("user_id"), ~errors & F.col("user_id").isNotNull()),
            row("totals", F.lit("unique_songs"), F.col("song_id"), plays & F.col("song_id").isNotNull()),
            row("platforms", platform(), nobody, F.lit(True)),
            row("searches", normalize_query(F.col("search_query")), nobody, searches),
            row("errors", F.coalesce("error_type", F.lit("unknown")), nobody, errors),
        )
    )
    return known(events).select(F.inline(rows)).groupBy("section", "key", "member").agg(
        F.count(F.lit(1)).alias("n")
    )


def report(members: DataFrame, top: int = REPORT_TOP) -> DataFrame:
    """(section, key, value): totals, most used platforms, most frequent queries, all errors."""
    counts = members.groupBy("section", "key").agg(
        F.when(F.count("member") > 0, F.count("member")).otherwise(F.sum("n")).alias("value")
    )
    parts = [counts.where(F.col("section").isin("totals", "errors"))]
    parts += [
        top_k(counts.where(F.col("section") == section), "value", top, "key")
        for section in ("platforms", "searches")
    ]
    return reduce(DataFrame.unionByName, parts)


def metrics_query(
    events: DataFrame,
    metric: Callable[[DataFrame], DataFrame],
    report: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Report the complete state of one metric at every trigger (30 seconds by default)."""
    return (
        metric(events)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": REPORT_INTERVAL}))
        .foreachBatch(report)
        .start()
    )
