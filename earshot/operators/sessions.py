"""Listening sessions: given ids, and ids inferred from a gap of inactivity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.functions.measures import minutes

GAP_MINUTES = 30


def session_stats(plays: DataFrame) -> DataFrame:
    """Start, end, tracks, minutes and average completion per (user, session_id)."""
    return plays.groupBy("user_id", "session_id").agg(
        F.min("played_at").alias("session_start"),
        F.max("played_at").alias("session_end"),
        F.count(F.lit(1)).alias("tracks_in_session"),
        minutes(F.sum("ms_played")).alias("session_minutes"),
        F.avg("completion_rate").alias("avg_completion_rate"),
    )


def _slots(plays: DataFrame, gap_minutes: int) -> DataFrame:
    """Sessions at the grain of (user, time slot).

    A slot is as wide as the gap, so its plays are always in one session and can be
    aggregated first.  A user's slots are then bounded by the clock, not by the plays.
    """
    width = gap_minutes * 60
    slotted = plays.withColumn(
        "_slot", F.floor(F.unix_timestamp(F.col("played_at").cast("timestamp")) / width)
    )
    per_slot = slotted.groupBy("user_id", "_slot").agg(
        F.min("played_at").alias("_first"),
        F.max("played_at").alias("_last"),
        F.count(F.lit(1)).alias("_plays"),
        F.sum("ms_played").alias("_ms"),
    )
    order = W.partitionBy("user_id").orderBy("_slot")
    pause = F.unix_micros(F.col("_first").cast("timestamp")) - F.unix_micros(
        F.lag("_last").over(order).cast("timestamp")
    )
    starts = F.coalesce(pause > width * 1_000_000, F.lit(True)).cast("int")
    return per_slot.withColumn("_starts", starts).withColumn(
        "session_no", F.sum("_starts").over(order)
    )


def gap_sessions(plays: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """One row per inferred session; a pause longer than the gap starts a new one."""
    return (
        _slots(plays, gap_minutes)
        .groupBy("user_id", "session_no")
        .agg(
            F.min("_first").alias("session_start"),
            F.max("_last").alias("session_end"),
            F.sum("_plays").alias("tracks_in_session"),
            minutes(F.sum("_ms")).alias("session_minutes"),
        )
    )


def sessionize(plays: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Every play with the number of its inferred session within the user's history.

    The plays meet their session on (user, slot), so a very active user stays spread out.
    A play without a user or a time is kept with a null session number.
    """
    width = gap_minutes * 60
    slot = F.floor(F.unix_timestamp(F.col("played_at").cast("timestamp")) / width)
    numbers = _slots(plays, gap_minutes).select("user_id", "_slot", "session_no")
    return plays.withColumn("_slot", slot).join(numbers, ["user_id", "_slot"], "left").drop("_slot")


def slot_intervals(plays: DataFrame, ts: str, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Plays as intervals (user_id, first, last, plays, ms), one per user and time slot.

    A slot is as wide as the gap, so its plays are in one session, and a user's intervals are
    bounded by the clock.
    """
    slot = F.floor(F.unix_timestamp(ts) / (gap_minutes * 60))
    return (
        plays.groupBy("user_id", slot.alias("_slot"))
        .agg(
            F.min(ts).alias("first"),
            F.max(ts).alias("last"),
            F.count(F.lit(1)).alias("plays"),
            F.coalesce(F.sum("ms_played"), F.lit(0)).alias("ms"),
        )
        .drop("_slot")
    )


def merge_intervals(intervals: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Intervals of a user that overlap or lie within the gap of each other, as one.

    Merging is associative: sessions may be merged again with later intervals, in any order.
    """
    order = W.partitionBy("user_id").orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(W.unboundedPreceding, -1))
    pause = F.unix_micros("first") - F.unix_micros(reached)
    starts = F.coalesce(pause > gap_minutes * 60_000_000, F.lit(True)).cast("int")
    return (
        intervals.withColumn("_starts", starts)
        .withColumn("_session", F.sum("_starts").over(order.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy("user_id", "_session")
        .agg(
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.sum("plays").alias("plays"),
            F.sum("ms").alias("ms"),
        )
        .drop("_session")
    )
