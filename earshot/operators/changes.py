"""Keyed changes to a target table, as functions from old and new rows to the next state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe_first(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """First row per key in ``order``; copies of a key are combined before the shuffle.

    Rows of equal order are told apart by all their columns (but maps, which have no order).
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    sortable = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    ordering = F.struct(*order, *[F.col(f"`{c}`").alias(f"_by_{c}") for c in sortable])
    return df.groupBy(*keys).agg(F.min_by(row, ordering).alias("_row")).select("_row.*")


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    update_cols: list[str] | None = None,
    keep_cols: tuple[str, ...] = ("created_at",),
) -> DataFrame:
    """Insert new keys and update known ones; ``updates`` has one row per key.

    On update the columns in ``update_cols`` (default: all of ``updates``) take the new
    value, except ``keep_cols``; every other column keeps its old value.
    """
    changed = set(update_cols or updates.columns) - set(keys) - set(keep_cols)
    old, new = target.alias("old"), updates.alias("new")
    joined = old.withColumn("_old", F.lit(True)).join(
        new.withColumn("_new", F.lit(True)), keys, "full_outer"
    )

    def column(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name not in updates.columns:
            return F.col(f"old.{name}")
        if name in changed:
            value = F.when(F.col("_new"), F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))
        else:
            value = F.when(F.col("_old"), F.col(f"old.{name}")).otherwise(F.col(f"new.{name}"))
        return value.alias(name)

    return joined.select(*[column(name) for name in target.columns])


def upsert_counters(target: DataFrame, deltas: DataFrame, run_ts: Column) -> DataFrame:
    """Add ``deltas`` (metric_type, entity_id, count) to the stored counters."""
    keys = ["metric_type", "entity_id"]
    summed = deltas.groupBy(*keys).agg(F.sum("count").alias("_delta"))
    joined = target.join(summed, keys, "full_outer")
    total = F.coalesce(F.col("count"), F.lit(0)) + F.coalesce(F.col("_delta"), F.lit(0))
    stamp = F.when(F.col("_delta").isNotNull(), run_ts).otherwise(F.col("last_updated"))
    return joined.select(*keys, total.alias("count"), stamp.alias("last_updated"))


def insert_new(target: DataFrame, batch: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target``, first one per key."""
    return dedupe_first(batch, keys, *order).join(target.select(*keys), keys, "left_anti")


def load_staged(staging: DataFrame, day: Column, date_col: str = "date") -> DataFrame:
    """Staged rows of one day with their ``process_date``."""
    return staging.where(F.col(date_col) == day).withColumn("process_date", day)


def clear_staged(staging: DataFrame, day: Column, date_col: str = "date") -> DataFrame:
    """What is left of the staging table once the day is loaded."""
    return staging.where(F.col(date_col) != day)


def with_audit(df: DataFrame, run_ts, *columns: str) -> DataFrame:
    """Stamp the run's time on audit columns (``created_at``, ``updated_at``, ...)."""
    stamp = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    return df.withColumns({name: stamp for name in columns})


def row_hash(columns: list[str]) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def build_dim(df: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Conformed dimension: natural key, attributes and their hash, one row per key."""
    picked = dedupe_first(df.select(key, *attributes), [key])
    return picked.withColumn("row_hash", row_hash(attributes))


def snapshot_scd2(history: DataFrame, current: DataFrame, key: str, ts: Column) -> DataFrame:
    """Next type-2 history from the last one and the current dimension.

    Both carry ``row_hash``; ``history`` also has ``valid_from`` and ``valid_to`` (null for
    the open version).  Keys missing from ``current`` are left open.
    """
    latest = current.select(key, F.col("row_hash").alias("_hash"))
    known = history.join(latest, key, "left")
    is_changed = F.col("valid_to").isNull() & (F.col("_hash") != F.col("row_hash"))
    closed = known.withColumn(
        "valid_to", F.when(is_changed, ts).otherwise(F.col("valid_to"))
    ).select(*history.columns)
    open_rows = history.where(F.col("valid_to").isNull()).select(key, "row_hash")
    opened = (
        current.join(open_rows, [key, "row_hash"], "left_anti")
        .withColumns(
            {
                "valid_from": ts.cast(history.schema["valid_from"].dataType),
                "valid_to": F.lit(None).cast(history.schema["valid_to"].dataType),
            }
        )
        .select(*history.columns)
    )
    return closed.unionByName(opened)
