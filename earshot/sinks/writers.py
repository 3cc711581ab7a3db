"""Sinks: partitioned Parquet, tables and views, JDBC, JSON, keyed upserts and run logs."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from earshot.functions.time import day as day_literal
from earshot.functions.time import seconds_between
from earshot.operators import changes
from earshot.schemas import ETL_LOGS, PIPELINE_EXECUTIONS, project_schema
from earshot.sinks import files

BATCH_SIZE = 1000
BUCKETS = 10


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The Parquet table at ``path``, or an empty one if nothing has been written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **properties) -> None:
    """Append aggregates to a database table; each task is one transaction."""
    df.write.format("jdbc").option("url", url).option("dbtable", table).option(
        "batchsize", BATCH_SIZE
    ).options(**properties).mode(mode).save()


def zero_padded_day(df: DataFrame, ts: str) -> DataFrame:
    """Path columns ``year``, ``month``, ``day`` with two-digit month and day."""
    return df.withColumns(
        {
            "year": F.date_format(ts, "yyyy"),
            "month": F.date_format(ts, "MM"),
            "day": F.date_format(ts, "dd"),
        }
    )


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "overwrite") -> None:
    """Parquet partitioned by path.  Overwriting replaces only the partitions present in ``df``.

    The rebalance hint lets AQE merge small and split large write tasks, so a day that holds
    most of the rows is still written by many tasks.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in by])
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_report(results: DataFrame, path: str) -> None:
    """Quality results as JSON lines."""
    results.write.mode("overwrite").json(path)


def materialize(
    df: DataFrame,
    name: str,
    partition_by: list[str] | None = None,
    bucket_by: list[str] | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Save as a table; bucketing lets later joins on the bucket columns skip a shuffle."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)


CURRENT = "_current"


def publish(df: DataFrame, base_path: str, view: str | None = None) -> str:
    """Write ``df`` to a new folder, then make it the current version of the table.

    The number of the version is recorded in a small table below ``base_path``, so a later
    session finds it; readers see the old rows or the new ones, never a half-written
    folder, and ``df`` may itself read the current version.
    """
    spark, base = df.sparkSession, base_path.rstrip("/")
    name = uuid.uuid4().hex
    df.write.parquet(f"{base}/version={name}")
    numbers = _versions(spark, base)
    number = (numbers.agg(F.max("number")).first()[0] or 0) + 1
    entry = spark.range(1).select(F.lit(number).alias("number"), F.lit(name).alias("version"))
    entry.coalesce(1).write.mode("append").parquet(f"{base}/{CURRENT}")
    if view:
        current_version(spark, base).createOrReplaceTempView(view)
    return f"{base}/version={name}"


def _versions(spark: SparkSession, base: str) -> DataFrame:
    return read_or_empty(spark, f"{base}/{CURRENT}", "number int, version string")


def current_version(spark: SparkSession, base_path: str) -> DataFrame:
    """The rows that were published last, in this session or another."""
    base = base_path.rstrip("/")
    last = _versions(spark, base).orderBy(F.desc("number"), F.desc("version")).first()
    if last is None:
        raise FileNotFoundError(f"nothing has been published at {base}")
    return spark.read.parquet(f"{base}/version={last['version']}")


def upsert_table(
    spark: SparkSession,
    base_path: str,
    updates: DataFrame,
    keys: list[str],
    update_cols: list[str] | None = None,
    view: str | None = None,
) -> str:
    """Upsert into the current version of a table and publish the merged one.

    An absent table counts as empty.
    """
    try:
        target = current_version(spark, base_path)
    except FileNotFoundError:
        target = updates.limit(0)
    return publish(changes.upsert(target, updates, keys, update_cols), base_path, view)


#: Partitions that one upsert may touch and still name them in its read.
MOST_PARTITIONS = 10_000


def upsert_partitions(
    path: str, updates: DataFrame, keys: list[str], partition: str = "date"
) -> None:
    """Upsert into Parquet partitioned by a key column, rewriting only the touched partitions.

    The touched partition values are looked up first and named in the read, so the others
    are not scanned.  The dynamic overwrite replaces them when all tasks are done.  An absent
    target counts as empty.
    """
    touched = updates.select(partition).distinct().limit(MOST_PARTITIONS + 1).collect()
    target = read_or_empty(updates.sparkSession, path, updates.schema)
    if len(touched) <= MOST_PARTITIONS:
        target = target.where(F.col(partition).isin([row[0] for row in touched]))
    else:
        target = target.join(updates.select(partition).distinct(), partition, "left_semi")
    write_partitioned(
        changes.upsert(target.select(*updates.columns), updates, keys), path, [partition]
    )


def append_new(path: str, batch: DataFrame, keys: list[str], *order) -> DataFrame:
    """Insert if absent: append rows whose key the Parquet target does not have yet."""
    target = read_or_empty(batch.sparkSession, path, batch.schema)
    fresh = changes.insert_new(target, batch, keys, *order)
    fresh.write.mode("append").parquet(path)
    return fresh


def load_staged(
    staging_path: str, final_path: str, d: str | dt.date, schema: StructType | str | None = None
) -> None:
    """Load one staged day into the final table, then empty its staging partition.

    A repeated run finds no staged rows and leaves the loaded day alone, also if no other day
    is staged.  ``schema`` is that of the staging table; without it the files there tell it.
    """
    spark = SparkSession.active()
    folder = f"{staging_path.rstrip('/')}/date={d}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    filesystem = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not filesystem.exists(hadoop_path):
        return
    reader = spark.read.option("basePath", staging_path)
    staging = (reader.schema(schema) if schema else reader).parquet(folder)
    loaded = changes.load_staged(staging, day_literal(d))
    write_partitioned(loaded, final_path, ["date"])
    filesystem.delete(hadoop_path, True)


def load_staged_days(
    staging_path: str, final_path: str, schema: StructType | str | None = None
) -> None:
    """Load all staged days in one pass, each into its own partition, then empty their staging.

    Days staged meanwhile are left for the next run, as are days loaded earlier.
    """
    spark = SparkSession.active()
    base = staging_path.rstrip("/")
    folders = [f"{base}/{name}" for name in files.names(spark, base) if name.startswith("date=")]
    if not folders:
        return
    reader = spark.read.option("basePath", base)
    staging = (reader.schema(schema) if schema else reader).parquet(*folders)
    write_partitioned(staging.withColumn("process_date", F.col("date")), final_path, ["date"])
    for folder in folders:
        files.delete(spark, folder)


def run_log(
    records: DataFrame, name: str, environment: str, start: str, end: str, d: str | dt.date
) -> DataFrame:
    """One pipeline-execution row; ``records`` are the rows counted as processed."""
    start_ts, end_ts = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    row = records.agg(F.count(F.lit(1)).alias("records_processed")).select(
        F.lit(name).alias("pipeline_name"),
        F.lit(environment).alias("environment"),
        F.lit("completed").alias("status"),
        start_ts.alias("start_time"),
        end_ts.alias("end_time"),
        seconds_between(start_ts, end_ts).alias("duration_seconds"),
        "records_processed",
        day_literal(d).alias("execution_date"),
    )
    return project_schema(row, PIPELINE_EXECUTIONS)


def etl_log(
    staged: DataFrame, task: str, table: str, processed_on: str | dt.date, run_ts: str
) -> DataFrame:
    """One log row for the rows staged on ``processed_on``, which hold the day before."""
    end = F.lit(run_ts).cast("timestamp")
    message = F.concat(
        F.lit("Extracted streaming history for "), day_literal(processed_on, -1).cast("string")
    )
    row = (
        staged.where(F.col("processed_date") == day_literal(processed_on))
        .agg(F.count(F.lit(1)).alias("records_processed"))
        .select(
            F.lit(task).alias("etl_task"),
            F.lit(table).alias("table_name"),
            (end - F.expr("INTERVAL 5 MINUTES")).alias("start_datetime"),
            end.alias("end_datetime"),
            "records_processed",
            F.lit("SUCCESS").alias("status"),
            message.alias("log_message"),
        )
    )
    return project_schema(row, ETL_LOGS)


def append_log(row: DataFrame, path: str) -> None:
    row.write.mode("append").parquet(path)
