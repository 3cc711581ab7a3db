"""Writing the feed to its tables, once per event, and keeping counters."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from earshot.operators.changes import dedupe_first
from earshot.sinks.levels import FAN, LevelledRuns
from earshot.sinks.writers import read_or_empty, write_partitioned
from earshot.streaming.decode import (
    PROJECTIONS,
    TABLES,
    decode_events,
    is_storable,
    quarantine,
)
from earshot.streaming.event_ids import KEYS, SeenIds

WATERMARK = "1 hour"


def dedupe(events: DataFrame, key: str = "event_id", watermark: str = WATERMARK) -> DataFrame:
    """Drop repeated events inside a stream with bounded state.

    Events later than the watermark are dropped too; ``start_ingest`` looks ids up in a table
    instead, so that nothing is lost.
    """
    return events.withWatermark("event_ts", watermark).dropDuplicatesWithinWatermark([key])


def write_event_batch(base_path: str, fan: int = FAN) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function writing each event type to its own Parquet table, once per event.

    An event id is stored once, whenever and with whatever date it is delivered again; the
    ids of earlier batches are looked up in ``<base_path>/_ids``.  Events that cannot be
    stored are all kept in the quarantine.  The batch is decoded once.

    Tables are partitioned by event date and batch, and none of them is read.  A repeated batch
    replaces its own partitions and ids, so a restart neither loses nor repeats rows.  A type
    without rows in the batch writes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = SeenIds(batch.sparkSession, f"{base_path}/_ids", fan=fan)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        once = dedupe_first(batch.where(is_storable()), list(KEYS), F.col("event_ts"))
        once = once.persist(StorageLevel.MEMORY_AND_DISK)
        fresh = seen.unseen(once.select(*KEYS), batch_id).persist(StorageLevel.MEMORY_AND_DISK)
        storable = once
        if seen.filters.runs(batch_id):
            storable = once.join(fresh.select(*KEYS), list(KEYS), "left_semi")
        aside = quarantine(batch).withColumn("batch_id", F.lit(batch_id))
        steps = [
            partial(write_partitioned, aside, f"{base_path}/quarantine", ["batch_id"]),
            partial(seen.add, fresh, batch_id),
        ]
        for kind, table in TABLES.items():
            dated = PROJECTIONS[kind](storable).withColumns(
                {"batch_id": F.lit(batch_id), "date": F.to_date("timestamp")}
            )
            steps.append(
                partial(write_partitioned, dated, f"{base_path}/{table}", ["date", "batch_id"])
            )
        try:
            _at_once(batch.sparkSession, steps)
        finally:
            for kept in (fresh, once, batch):
                kept.unpersist()

    return write


def _at_once(spark: SparkSession, steps: list[Callable[[], None]]) -> None:
    """Runs independent jobs side by side, as each alone would leave executors idle."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        for job in running:
            job.result()


def table_schema(spark: SparkSession, name: str) -> StructType:
    """The schema of an ingest table, whether or not it has rows yet."""
    events = decode_events(spark.createDataFrame([], "value string"))
    batch_id = F.lit(0).alias("batch_id")
    if name == "quarantine":
        return quarantine(events).select("*", batch_id).schema
    kind = next(kind for kind, table in TABLES.items() if table == name)
    return PROJECTIONS[kind](events).select("*", batch_id, F.to_date("timestamp").alias("date")).schema


def read_ingested(spark: SparkSession, base_path: str, name: str) -> DataFrame:
    """One of the tables that the ingest has written; empty if it has no rows yet."""
    return read_or_empty(spark, f"{base_path}/{name}", table_schema(spark, name))


def start_ingest(
    feed: DataFrame, base_path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Decode, drop repeated ids, route and write; progress is kept in the checkpoint.

    The numbers of its batches tell ids of earlier batches from its own, so the tables belong to one
    checkpoint.
    """
    return (
        decode_events(feed)
        .writeStream.foreachBatch(write_event_batch(base_path))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def counter_deltas(events: DataFrame) -> DataFrame:
    """Counts to add per (metric_type, entity_id): song plays, searches and errors."""
    entity = (
        F.when(F.col("event_type") == "song_play", F.col("song_id"))
        .when(F.col("event_type") == "search", F.lower("search_query"))
        .when(F.col("event_type") == "error", F.col("error_type"))
    )
    return (
        events.select(F.col("event_type").alias("metric_type"), entity.alias("entity_id"))
        .where(F.col("entity_id").isNotNull())
        .groupBy("metric_type", "entity_id")
        .agg(F.count(F.lit(1)).alias("count"))
    )


COUNTERS = "metric_type string, entity_id string, count long"


def _counted(deltas: DataFrame, *_) -> DataFrame:
    return deltas.groupBy("metric_type", "entity_id").agg(F.sum("count").alias("count"))


def counter_runs(spark: SparkSession, path: str, fan: int = FAN) -> LevelledRuns:
    """The counters' deltas: a run per batch, summed in levels."""
    return LevelledRuns(spark, path, COUNTERS, _counted, fan)


def write_counter_batch(path: str, fan: int = FAN) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function storing one batch's deltas; a repeated batch replaces them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        counter_runs(batch.sparkSession, path, fan).add(batch_id, counter_deltas(batch))

    return write


def compact_counters(spark: SparkSession, path: str, before: int) -> None:
    """Sums the deltas of all batches below ``before`` into one run, before a long read."""
    counter_runs(spark, path).compact(before)


def read_counters(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Current counters, from a few runs on each of log(batches) levels."""
    return _counted(counter_runs(spark, path).read(before))


def with_end_of_input(stream: DataFrame, path: str, time: str, **marker) -> DataFrame:
    """``stream`` and, from a file at ``path``, one row whose ``time`` column is far ahead.

    Once it has been read, the watermark has passed all other rows, so whatever is still
    open is emitted; the marker itself stays open and never is.
    """
    spark = stream.sparkSession
    schema = stream.schema
    values = [
        F.lit("2999-01-01").cast(f.dataType) if f.name == time else F.lit(marker.get(f.name)).cast(f.dataType)
        for f in schema
    ]
    row = spark.range(1).select(*[v.alias(f.name) for v, f in zip(values, schema, strict=True)])
    row.write.mode("overwrite").parquet(path)
    return stream.unionByName(spark.readStream.schema(schema).parquet(path))


def stream_sessions(plays: DataFrame, gap: str = "30 minutes", watermark: str = "10 minutes"):
    """Sessions of a play stream, emitted once the watermark has passed their end.

    ``plays`` has ``user_id``, ``event_ts`` (timestamp) and ``ms_played``.
    """
    session = F.session_window("event_ts", gap)
    return (
        plays.withWatermark("event_ts", watermark)
        .groupBy("user_id", session.alias("session"))
        .agg(
            F.count(F.lit(1)).alias("tracks_in_session"),
            F.sum("ms_played").alias("ms_in_session"),
        )
        .select(
            "user_id",
            F.col("session.start").alias("session_start"),
            F.col("session.end").alias("session_end"),
            "tracks_in_session",
            "ms_in_session",
        )
    )


def run_to_files(
    stream: DataFrame, path: str, checkpoint: str, output_mode: str = "append"
) -> DataFrame:
    """Process all available input, write the result to ``path`` and return it as a table.

    Complete output replaces the table at every batch; append output is written by batch id.
    """
    spark = stream.sparkSession
    schema = stream.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        target = path if output_mode == "complete" else f"{path}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(target)

    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(path).select(*schema.names)
