"""Sessions of a play stream in which no play is lost, however late it comes.

Each batch merges its plays, as one interval per user and time slot, with the sessions that are
still open.  A session is closed and written for good once the latest time seen lies ``delay``
beyond its end.  A play older than that when it arrives may belong to a session that has been
written; it goes to the side table ``late``, as do plays without a user or a time, which say so in
``reason``.  So plays in closed sessions, in open ones and in the side table are all plays.

``repaired_sessions`` merges late plays into the sessions, for which only users with late plays
are grouped anew; as merging is associative, the result is that of all plays in order.

What a batch needs of the past is a table of the open sessions and one row with the latest time:
a batch costs its own rows and the open sessions.  All its tables are folders of the batch, so
one that runs again replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from earshot.operators.sessions import GAP_MINUTES, merge_intervals, slot_intervals
from earshot.sinks import files
from earshot.sinks.writers import read_or_empty

DELAY_MINUTES = 10

SESSION = "first timestamp, last timestamp, plays long, ms long"
#: The latest time seen, in microseconds: whole numbers need no time zone on the driver.
CLOCK = "latest long"


class SessionTables:
    """The tables of sessions below ``path``; ``user_type`` is the type of ``user_id``."""

    def __init__(self, spark: SparkSession, path: str, user_type: str = "long") -> None:
        self.spark, self.path = spark, path.rstrip("/")
        session = f"user_id {user_type}, {SESSION}"
        self.schemas = {
            "closed": session,
            "open": session,
            "late": f"user_id {user_type}, event_ts timestamp, ms_played long, reason string",
            "clock": CLOCK,
        }

    def write(self, name: str, batch_id: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}/batch_id={batch_id}")

    def of_batch(self, name: str, batch_id: int) -> DataFrame:
        """What one batch has written; nothing if there was no such batch."""
        return read_or_empty(
            self.spark, f"{self.path}/{name}/batch_id={batch_id}", self.schemas[name]
        )

    def closed(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/closed", self.schemas["closed"])

    def late(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/late", self.schemas["late"])

    def open(self) -> DataFrame:
        """The sessions that the last finished batch left open."""
        clocks = files.names(self.spark, f"{self.path}/clock")
        done = [
            int(name.partition("=")[2])
            for name in clocks
            if files.exists(self.spark, f"{self.path}/clock/{name}/_SUCCESS")
        ]
        return self.of_batch("open", max(done, default=-1))


def _time(micros: int | None, minutes: int) -> Column:
    """A time some minutes from the given one; null if there is none."""
    moved = None if micros is None else micros + minutes * 60_000_000
    return F.timestamp_micros(F.lit(moved).cast("long"))


def write_session_batch(
    path: str, gap_minutes: int = GAP_MINUTES, delay_minutes: int = DELAY_MINUTES
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for plays with ``user_id``, ``event_ts`` and ``ms_played``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tables = SessionTables(spark, path, batch.schema["user_id"].dataType.simpleString())
        before = tables.of_batch("clock", batch_id - 1).agg(F.max("latest")).first()[0]
        batch = batch.select("user_id", "event_ts", F.col("ms_played").cast("long").alias("ms_played"))
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        # Closed sessions ended before this time, so plays from then on cannot touch them.
        horizon = _time(before, -delay_minutes)
        reason = (
            F.when(F.col("user_id").isNull(), "no user")
            .when(F.col("event_ts").isNull(), "no time")
            .when(F.coalesce(F.col("event_ts") < horizon, F.lit(False)), "late")
        )
        judged = batch.withColumn("reason", reason)
        timely = slot_intervals(judged.where("reason IS NULL"), "event_ts", gap_minutes)
        held = tables.of_batch("open", batch_id - 1).unionByName(timely)
        latest = batch.agg(F.max(F.unix_micros("event_ts"))).first()[0]
        latest = max((t for t in (before, latest) if t is not None), default=None)
        sessions = merge_intervals(held, gap_minutes).persist(StorageLevel.MEMORY_AND_DISK)
        over = F.col("last") < _time(latest, -gap_minutes - delay_minutes)
        over = F.coalesce(over, F.lit(False))
        try:
            tables.write("late", batch_id, judged.where("reason IS NOT NULL"))
            tables.write("closed", batch_id, sessions.where(over))
            tables.write("open", batch_id, sessions.where(~over))
            clock = spark.range(1).select(F.lit(latest).cast("long").alias("latest"))
            tables.write("clock", batch_id, clock.coalesce(1))
        finally:
            sessions.unpersist()
            batch.unpersist()
        # The batch before is what a repeated one would need; older states are done with.
        for name in ("open", "clock"):
            files.delete(spark, f"{path.rstrip('/')}/{name}/batch_id={batch_id - 2}")

    return write


def start_sessions(
    plays: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    gap_minutes: int = GAP_MINUTES,
    delay_minutes: int = DELAY_MINUTES,
) -> StreamingQuery:
    """Sessions of a play stream, written below ``path``."""
    return (
        plays.writeStream.foreachBatch(write_session_batch(path, gap_minutes, delay_minutes))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def repaired_sessions(tables: SessionTables, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """All sessions, closed and open, with late plays merged in.

    Only sessions of users who have late plays are grouped again.
    """
    late = tables.late().where(F.col("reason") == "late")
    added = slot_intervals(late, "event_ts", gap_minutes)
    users = added.select("user_id").distinct()
    known = tables.closed().drop("batch_id").unionByName(tables.open())
    touched = known.join(users, "user_id", "left_semi").unionByName(added)
    untouched = known.join(users, "user_id", "left_anti")
    return untouched.unionByName(merge_intervals(touched, gap_minutes))
