"""Window computations and distributed ranking."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.functions.time import day as day_literal


def rank_within(df: DataFrame, keys: list[str], *order: Column, out: str = "rank") -> DataFrame:
    """Row number within small groups (a user's hours, genres or artists)."""
    return df.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def top_rank(
    df: DataFrame, keys: list[str], *order: Column, k: int = 1, out: str = "rank"
) -> DataFrame:
    """First ``k`` rows per group; Spark limits each group before the shuffle."""
    return rank_within(df, keys, *order, out=out).where(F.col(out) <= k)


#: Neighbouring keys of one value that are numbered in one task.
RANK_RANGE = 4096


def rank_all(
    df: DataFrame, groups: list[str], measure: str, key: str, out: str = "rank"
) -> DataFrame:
    """Row number of every row of groups of any size, by ``measure`` downwards and ``key``.

    Rows are counted per group, value and range of keys; a row's number is its place in its
    range plus the running sum of the ranges before.  So neither a large group nor a value
    that most of its rows have is sorted in one task: ranges hold at most ``RANK_RANGE``
    whole numbers, or the strings of one prefix.
    """
    numeric = df.schema[key].dataType.typeName() in ("byte", "short", "integer", "long")
    piece = F.floor(F.col(key) / RANK_RANGE) if numeric else F.substring(key, 1, 4)
    cut = [*groups, measure, "_piece"]
    rows = df.withColumn("_piece", piece)
    before = W.partitionBy(*groups).orderBy(F.desc(measure), "_piece")
    offsets = (
        rows.groupBy(*cut)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(before) - F.col("_n"))
        .drop("_n")
    )
    place = F.row_number().over(W.partitionBy(*cut).orderBy(key))
    return (
        rows.join(offsets, cut)
        .withColumn(out, (F.col("_before") + place).cast("long"))
        .drop("_piece", "_before")
    )


def share_of(df: DataFrame, keys: list[str], count: str, out: str, per: float = 100.0) -> DataFrame:
    """Percentage of each counted row in its group's total."""
    total = F.sum(count).over(W.partitionBy(*keys))
    return df.withColumn(out, F.col(count) * F.lit(per) / total)


def streaks(df: DataFrame, key: str, day: str, as_of: str | dt.date) -> DataFrame:
    """Runs of consecutive days per key; ``df`` has distinct (key, day) rows.

    A run is current when its last day is the day before ``as_of``.
    """
    order = W.partitionBy(key).orderBy(day)
    islands = df.select(
        key, day, F.date_sub(F.col(day), F.row_number().over(order)).alias("_island")
    )
    return (
        islands.groupBy(key, "_island")
        .agg(
            F.count(F.lit(1)).alias("streak_length"),
            F.min(day).alias("streak_start"),
            F.max(day).alias("streak_end"),
        )
        .withColumn("is_current", F.col("streak_end") == day_literal(as_of, -1))
        .drop("_island")
    )


def centered_avg(df: DataFrame, order: str, column: str, points: int, out: str) -> DataFrame:
    """Centred moving average, null where the frame is incomplete.

    Meant for a fixed spine (24 hours): the window has no partition key.
    """
    half = points // 2
    frame = W.partitionBy(F.lit(0)).orderBy(order).rowsBetween(-half, half)
    complete = F.count(column).over(frame) == points
    return df.withColumn(out, F.when(complete, F.avg(column).over(frame)))
