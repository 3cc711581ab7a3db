"""Days on which a key was active, as states that merge: runs of days, and words of day bits.

Both may be built from any pieces of the past, such as one per day, and merged in any order and
with any overlap; so a day that is added costs its own rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Days of one word.
WORD_DAYS = 32


def merge_runs(runs: DataFrame, key: str) -> DataFrame:
    """Runs (key, first_day, last_day) that overlap or follow on each other, as one."""
    order = W.partitionBy(key).orderBy("first_day", "last_day")
    reached = F.max("last_day").over(order.rowsBetween(W.unboundedPreceding, -1))
    starts = F.coalesce(F.datediff("first_day", reached) > 1, F.lit(True)).cast("int")
    return (
        runs.withColumn("_starts", starts)
        .withColumn("_run", F.sum("_starts").over(order.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy(key, "_run")
        .agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
        .drop("_run")
    )


def day_runs(df: DataFrame, key: str, day: Column) -> DataFrame:
    """The runs of the rows of ``df``; rows are first made one per key and day."""
    days = df.select(key, day.alias("first_day")).where(F.col("first_day").isNotNull()).distinct()
    return merge_runs(days.withColumn("last_day", F.col("first_day")), key)


def clipped_streaks(runs: DataFrame, key: str, first: Column, yesterday: Column) -> DataFrame:
    """Streaks from the day ``first`` on, of merged runs; a run that ends ``yesterday`` is current."""
    start = F.greatest("first_day", first)
    return runs.where(F.col("last_day") >= first).select(
        key,
        (F.datediff("last_day", start) + 1).cast("long").alias("streak_length"),
        start.alias("streak_start"),
        F.col("last_day").alias("streak_end"),
        (F.col("last_day") == yesterday).alias("is_current"),
    )


def day_words(df: DataFrame, key: str, day: Column) -> DataFrame:
    """Words (key, block, bits): bit i of a block is its day i."""
    number = df.where(F.col(key).isNotNull()).select(key, F.unix_date(day).alias("_day"))
    block = F.floor(F.col("_day") / WORD_DAYS).cast("int").alias("block")
    bit = F.expr(f"shiftleft(1L, pmod(_day, {WORD_DAYS}))")
    return number.where("_day IS NOT NULL").groupBy(key, block).agg(F.bit_or(bit).alias("bits"))


def merge_words(words: DataFrame, key: str) -> DataFrame:
    return words.groupBy(key, "block").agg(F.bit_or("bits").alias("bits"))


def block_of(day: Column) -> Column:
    return F.floor(F.unix_date(day) / WORD_DAYS).cast("int")


def active_between(word: Column, first: Column, last: Column) -> Column:
    """Whether a word (a struct of block and bits) has a day from ``first`` to ``last``."""
    origin = word["block"] * WORD_DAYS
    low = F.greatest(F.unix_date(first) - origin, F.lit(0))
    high = F.least(F.unix_date(last) - origin, F.lit(WORD_DAYS - 1))
    ones = F.call_function("shiftleft", F.lit(1).cast("long"), high - low + 1) - 1
    mask = F.call_function("shiftleft", ones, low)
    return F.when(low <= high, word["bits"].bitwiseAND(mask) != 0).otherwise(F.lit(False))
