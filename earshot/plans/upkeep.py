"""User reports kept up day by day from mergeable states, in place of all plays.

A day (or any other batch of plays) adds its own rows to four tables of levelled runs:

* ``tracks``: plays and time per user and track;
* ``days``: time and number of plays per user and day;
* ``runs``: runs of consecutive listening days per user;
* ``words``: 32 days of a user as the bits of one word.

The reports merge what few runs there are, and equal those over all plays, in whatever order the
days came.  A batch that is added again replaces itself; a play must be in one batch only.
"""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions import measures as m
from earshot.functions import time as t
from earshot.operators import day_runs
from earshot.operators.filters import Day, date_between
from earshot.plans import activity, marts
from earshot.sinks.levels import FAN, LevelledRuns

TRACKS = "user_id {user}, track_id {track}, plays long, ms long"
DAYS = "user_id {user}, activity_date date, plays long, ms long"
RUNS = "user_id {user}, first_day date, last_day date"
WORDS = "user_id {user}, block int, bits long"


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("plays").alias("plays"), F.sum("ms").alias("ms"))


STATES = ("tracks", "days", "runs", "words")


class UserUpkeep:
    """The states below ``path``; ``user`` and ``track`` are the types of the ids.

    ``kept`` names the states that batches are added to: ``listening_streaks`` needs runs,
    ``active_users_range`` words, and ``user_listening_stats`` tracks and days.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        user: str = "long",
        track: str = "long",
        fan: int = FAN,
        kept: tuple[str, ...] = STATES,
    ) -> None:
        self.kept = kept

        def runs(name: str, schema: str, merge) -> LevelledRuns:
            filled = schema.format(user=user, track=track)
            return LevelledRuns(spark, f"{path}/{name}", filled, merge, fan)

        self.tracks = runs("tracks", TRACKS, lambda rows, *_: _sums(rows, "user_id", "track_id"))
        self.days = runs("days", DAYS, lambda rows, *_: _sums(rows, "user_id", "activity_date"))
        self.runs = runs("runs", RUNS, lambda rows, *_: day_runs.merge_runs(rows, "user_id"))
        self.words = runs("words", WORDS, lambda rows, *_: day_runs.merge_words(rows, "user_id"))

    def add(self, batch_id: int, plays: DataFrame) -> None:
        """Adds a batch of plays; batches are numbered as they come, whatever days they hold."""
        day = t.to_day(F.col("played_at"))
        # What the four states need of the plays, counted once.
        counted = (
            plays.groupBy("user_id", "track_id", day.alias("activity_date"))
            .agg(F.count(F.lit(1)).alias("plays"), F.sum("ms_played").alias("ms"))
            .persist(StorageLevel.MEMORY_AND_DISK)
        )
        date = F.col("activity_date")
        dated = counted.where(date.isNotNull())
        states = {
            "tracks": _sums(counted, "user_id", "track_id"),
            "days": _sums(dated, "user_id", "activity_date"),
            "runs": day_runs.day_runs(dated, "user_id", date),
            "words": day_runs.day_words(dated, "user_id", date),
        }
        try:
            for name in self.kept:
                getattr(self, name).add(batch_id, states[name])
        finally:
            counted.unpersist()

    def listening_streaks(self, as_of: Day, window_days: int = 30) -> DataFrame:
        """As ``marts.listening_streaks`` over all plays that were added."""
        merged = day_runs.merge_runs(self.runs.read(), "user_id")
        first = t.day(as_of, -window_days)
        return day_runs.clipped_streaks(merged, "user_id", first, t.day(as_of, -1))

    def user_listening_stats(
        self,
        tracks: DataFrame,
        artists: DataFrame,
        as_of: Day,
        window_days: int = 30,
        run_ts: Column | None = None,
    ) -> DataFrame:
        """As ``marts.user_listening_stats`` over all plays that were added."""
        per_track = _sums(self.tracks.read(), "user_id", "track_id").withColumn(
            "tracks", F.lit(1).cast("long")
        )
        recent = self.days.read().where(F.col("activity_date") >= t.day(as_of, -window_days))
        days = _sums(recent, "user_id", "activity_date").select(
            "user_id", "activity_date", m.minutes(F.col("ms")).alias("daily_minutes")
        )
        return marts.stats_of(per_track, days, tracks, artists, as_of, run_ts)

    def active_users_range(
        self, users: DataFrame, start: Day, end: Day, churn_days: int = activity.CHURN_DAYS
    ) -> DataFrame:
        """As ``activity.active_users_range``, by tests of day bits.

        A user's words in the range are one row; each day of the range tests a few bits of it,
        and only the counts per day are shuffled.
        """
        first, last = t.as_date(start), t.as_date(end)
        earliest = first.replace(day=1) - dt.timedelta(days=max(churn_days, 7))
        blocks = F.col("block").between(
            day_runs.block_of(t.day(earliest)), day_runs.block_of(t.day(last))
        )
        # At most one word for each 32 days of the range.
        words = (
            day_runs.merge_words(self.words.read().where(blocks), "user_id")
            .groupBy("user_id")
            .agg(F.collect_list(F.struct("block", "bits")).alias("words"))
        )
        days = F.explode(F.sequence(t.day(start), t.day(end))).alias("date")
        date = F.col("date")

        def active(since: Column, until: Column) -> Column:
            return F.exists("words", lambda w: day_runs.active_between(w, since, until))

        today = active(date, date)
        before = active(t.day_offset(date, -churn_days), t.day_offset(date, -1))
        counts = (
            words.select(days, "words")
            .groupBy("date")
            .agg(
                F.count_if(today).alias("count"),
                F.count_if(active(t.week_start(date), date)).alias("weekly_active_count"),
                F.count_if(active(t.month_start(date), date)).alias("monthly_active_count"),
                F.count_if(before & ~today).alias("churn_count"),
            )
        )
        fresh = (
            users.where(date_between(F.col("registered_on"), start, end))
            .groupBy(F.to_date("registered_on").alias("date"))
            .agg(F.count(F.lit(1)).alias("new_users_count"))
        )
        spine = users.sparkSession.range(1).select(days)

        def known(name: str) -> Column:
            return F.coalesce(name, F.lit(0).cast("long")).alias(name)

        return (
            spine.join(counts, "date", "left")
            .join(fresh, "date", "left")
            .select(
                "date",
                known("count"),
                known("weekly_active_count"),
                known("monthly_active_count"),
                known("new_users_count"),
                known("churn_count"),
            )
        )
