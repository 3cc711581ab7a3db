"""Batch and streaming readers.

Thin on purpose: they return lazy DataFrames with the options a large read needs.  The JDBC
driver, the Kafka and the Avro packages are not part of Spark itself and must be on the
cluster's classpath.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.operators.grouping import union_counts

FETCH_SIZE = 10000


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    date: str | dt.date | None = None,
    *,
    split: dict | None = None,
    predicates: list[str] | None = None,
    **options,
) -> DataFrame:
    """Run ``query`` in the database; ``:date`` in it is replaced by the checked date.

    ``split`` = {"column", "lower", "upper", "partitions"} reads ranges of equal width in parallel;
    ``predicates``, such as ``splits.split_predicates`` makes of a sample of keys, read one part
    each, of about equal size.  Without either a database read is a single task, which only suits
    one day of a small table.
    """
    if date is not None:
        checked = dt.date.fromisoformat(str(date))
        query = query.replace(":date", f"DATE '{checked.isoformat()}'")
    if predicates:
        properties = {"fetchsize": str(FETCH_SIZE)} | {k: str(v) for k, v in options.items()}
        source_rows = f"({query}) AS source_rows"
        return spark.read.jdbc(url, source_rows, predicates=predicates, properties=properties)
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", FETCH_SIZE)
    if split:
        reader = (
            reader.option("dbtable", f"({query}) AS source_rows")
            .option("partitionColumn", split["column"])
            .option("lowerBound", split["lower"])
            .option("upperBound", split["upper"])
            .option("numPartitions", split["partitions"])
        )
    else:
        reader = reader.option("query", query)
    return reader.options(**options).load()


def read_files(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str | T.StructType | None = None
) -> DataFrame:
    """JSON, CSV, Parquet (or Avro) with a given schema.

    For JSON and CSV malformed rows are kept, with their text in ``_corrupt_record``.
    """
    reader = spark.read.format(fmt)
    if fmt in ("json", "csv"):
        if schema is None:
            raise ValueError("JSON and CSV need a schema")
        fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        fields = T.StructType([*fields, T.StructField("_corrupt_record", T.StringType())])
        reader = reader.schema(fields).option("mode", "PERMISSIVE")
        if fmt == "csv":
            reader = reader.option("header", True)
    elif schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def source(spark: SparkSession, schema: str, table: str) -> DataFrame:
    return spark.table(f"{schema}.{table}")


def sample_dim(df: DataFrame, columns: list[str], n: int = 1000) -> DataFrame:
    """The first ``n`` rows in key order, the key being the first column."""
    return df.select(*columns).orderBy(columns[0]).limit(n)


def table_counts(spark: SparkSession, schemas: list[str]) -> DataFrame:
    """Rows per table of the given schemas; table names come from the catalog."""
    frames = {
        f"{schema}.{table.name}": spark.table(f"{schema}.{table.name}")
        for schema in schemas
        if spark.catalog.databaseExists(schema)
        for table in spark.catalog.listTables(schema)
        if not table.isTemporary
    }
    if not frames:
        return spark.createDataFrame([], "table_name string, record_count long")
    return union_counts(frames).orderBy("table_name")


# The event topics of the feed, without the service's own name prefix.
TOPICS = ["song-plays", "auth-events", "search-events", "playlist-events", "error-events"]


def read_events(
    spark: SparkSession,
    servers: str,
    topics: list[str] | None = None,
    max_offsets: int | None = None,
    **options,
) -> DataFrame:
    """Streaming ``value`` (text) and ``key`` of several Kafka topics, from the earliest offset."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics or TOPICS))
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.options(**options).load().select(
        F.col("key").cast("string"), F.col("value").cast("string"), "topic", "timestamp"
    )


def read_event_files(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """The same feed as JSON lines in files."""
    return (
        spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(path)
    )
