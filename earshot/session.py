"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Whether a query's shuffle files go when it ends, and not when the driver collects its garbage.
#: A later read of a result that needs them makes them again.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "earshot", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every job here relies on.

    ``spark.sql.shuffle.partitions`` is left to the caller: AQE coalesces
    downwards, so a cluster should start high (a few times its core count).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Keys of stateful streams lie on the executors' disks, not in their heap.
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """The settings ``conf`` for what is built and run inside; those of before afterwards."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Where it is unset, a local-mode session takes a folder in its warehouse; a cluster has to
    name one that all executors share.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        configured = f"{warehouse}/_scratch"
    context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
