"""Data-quality checks.

Every check returns rows of (check_name, violations, status), so that a report is the union
of its checks.  Row-level checks of one table share one scan, see ``check_rows``.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.functions.aggregates import DAYPARTS
from earshot.operators.filters import on_date
from earshot.operators.joins import orphans

RESULT = ["check_name", "violations", "status"]


def graded(df: DataFrame) -> DataFrame:
    status = F.when(F.col("violations") == 0, "success").otherwise("failure")
    return df.withColumn("status", status).select(*RESULT)


def check_counts(df: DataFrame, violations: dict[str, Column]) -> DataFrame:
    """One row for each named aggregate that counts violations, all in one pass."""
    names = list(violations)
    counted = df.agg(*[violations[n].cast("long").alias(f"v{i}") for i, n in enumerate(names)])
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("check_name"), F.col(f"v{i}").alias("violations"))
            for i, n in enumerate(names)
        ]
    )
    return graded(counted.select(F.inline(pairs)))


def check_rows(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Count the rows violating each named condition, all conditions in one pass."""
    return check_counts(df, {name: F.count_if(bad) for name, bad in checks.items()})


def check_table(
    df: DataFrame,
    table: str,
    *not_null: str,
    dates: tuple[str, ...] = (),
    minimum: int | None = None,
    rows_name: str | None = None,
    ts: str = "played_at",
) -> DataFrame:
    """Missing values, days without rows and missing rows of a table, in one pass."""
    found = {f"not_null:{table}.{c}": F.count_if(is_missing(c)) for c in not_null}
    for d in dates:
        found[f"rows_for_date:{d}"] = F.count_if(on_date(F.col(ts), d)) == 0
    if minimum is not None:
        found[f"min_rows:{rows_name or table}"] = F.greatest(
            F.lit(minimum) - F.count(F.lit(1)), F.lit(0)
        )
    return check_counts(df, found)


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def outside(column: str, low=None, high=None) -> Column:
    """True where a non-null value is below ``low`` or above ``high``."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return F.coalesce(bad, F.lit(False))


def not_in(column: str, values) -> Column:
    return F.coalesce(~F.col(column).isin(*values), F.lit(False))


def check_not_null(df: DataFrame, table: str, *columns: str) -> DataFrame:
    return check_rows(df, {f"not_null:{table}.{c}": is_missing(c) for c in columns})


def check_range(df: DataFrame, table: str, **ranges: tuple) -> DataFrame:
    return check_rows(
        df, {f"range:{table}.{c}": outside(c, low, high) for c, (low, high) in ranges.items()}
    )


def check_in(df: DataFrame, table: str, **domains) -> DataFrame:
    return check_rows(df, {f"in:{table}.{c}": not_in(c, v) for c, v in domains.items()})


def find_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def check_unique(df: DataFrame, table: str, *columns: str) -> DataFrame:
    """Number of repeated keys; null keys are not compared."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    repeated = find_duplicates(df.where(present), list(columns))
    name = f"unique:{table}.{'+'.join(columns)}"
    return graded(
        repeated.agg(F.count(F.lit(1)).alias("violations")).withColumn("check_name", F.lit(name))
    )


def check_fk(
    child: DataFrame, table: str, column: str, parent: DataFrame, key: str | None = None
) -> DataFrame:
    """Number of child rows whose non-null key has no parent row."""
    missing = orphans(child, column, parent, key or column)
    return graded(
        missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations")).withColumn(
            "check_name", F.lit(f"fk:{table}.{column}")
        )
    )


def check_min_rows(frames: dict[str, DataFrame], minimum: int) -> DataFrame:
    """Rows missing to the minimum, per table."""
    return union(
        *[
            graded(
                df.agg(
                    F.greatest(F.lit(minimum) - F.count(F.lit(1)), F.lit(0)).alias("violations")
                ).withColumn("check_name", F.lit(f"min_rows:{name}"))
            )
            for name, df in frames.items()
        ]
    )


def check_rows_for_date(df: DataFrame, d: str | dt.date, ts: str = "played_at") -> DataFrame:
    """One violation when the day has no rows."""
    found = df.where(on_date(F.col(ts), d)).agg(F.count(F.lit(1)).alias("n"))
    return graded(
        found.select(
            F.lit(f"rows_for_date:{d}").alias("check_name"),
            (F.col("n") == 0).cast("long").alias("violations"),
        )
    )


def require_rows_for_date(df: DataFrame, d: str | dt.date, ts: str = "played_at") -> int:
    """Row count of the day; raises when there is none."""
    found = df.where(on_date(F.col(ts), d)).count()
    if found == 0:
        raise ValueError(f"no rows for {d}")
    return found


def check_flow(raw: DataFrame, mart: DataFrame) -> DataFrame:
    """Both ends of the flow must hold rows."""
    return check_min_rows({"raw": raw, "mart": mart}, 1)


def check_schemas(spark: SparkSession, names: list[str]) -> DataFrame:
    """One violation per missing schema; the names are configuration, not data."""
    rows = [(f"schema:{n}", 0 if spark.catalog.databaseExists(n) else 1) for n in names]
    return graded(spark.createDataFrame(rows, "check_name string, violations long"))


def check_user_invariants(daily: DataFrame, table: str = "user_daily") -> DataFrame:
    """Dayparts and weekday/weekend counts add up, distinct counts and rates are in bounds."""
    dayparts = reduce(lambda a, b: a + b, [F.col(f"{p}_tracks") for p in DAYPARTS])
    checks = {f"{table}:dayparts_sum": dayparts != F.col("total_tracks")}
    if "weekday_tracks" in daily.columns:
        checks[f"{table}:weekdays_sum"] = (
            F.col("weekday_tracks") + F.col("weekend_tracks") != F.col("total_tracks")
        )
    if "unique_tracks" in daily.columns:
        checks[f"{table}:unique_le_total"] = F.col("unique_tracks") > F.col("total_tracks")
    for column in ("avg_completion_rate", "completion_rate"):
        if column in daily.columns:
            checks[f"{table}:{column}_bounds"] = outside(column, 0.0, 1.0)
    checks[f"{table}:date_present"] = is_missing("date")
    return check_rows(daily, checks)


def check_track_invariants(daily: DataFrame, table: str = "track_daily") -> DataFrame:
    checks = {
        f"{table}:listeners_le_streams": F.col("unique_listeners") > F.col("total_streams"),
        f"{table}:completion_bounds": outside("avg_completion_rate", 0.0, 1.0),
        f"{table}:skip_bounds": outside("skip_rate", 0.0, 1.0),
    }
    if "morning_streams" in daily.columns:
        dayparts = reduce(lambda a, b: a + b, [F.col(f"{p}_streams") for p in DAYPARTS])
        checks[f"{table}:dayparts_sum"] = dayparts != F.col("total_streams")
        checks[f"{table}:weekdays_sum"] = (
            F.col("weekday_streams") + F.col("weekend_streams") != F.col("total_streams")
        )
    return check_rows(daily, checks)


def find_gap_days(
    plays: DataFrame, start: str | dt.date, end: str | dt.date, ts: str = "played_at"
) -> DataFrame:
    """Calendar days of the range without a single play."""
    spark = plays.sparkSession
    spine = spark.range(1).select(
        F.explode(
            F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
        ).alias("date")
    )
    seen = plays.select(F.to_date(ts).alias("date")).distinct()
    return spine.join(seen, "date", "left_anti")


def union(*results: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def dq_report(results: DataFrame) -> DataFrame:
    """Checks, successes and success rate in percent."""
    passed = F.count_if(F.col("status") == "success")
    total = F.count(F.lit(1))
    return results.agg(
        total.alias("total_checks"),
        passed.alias("passed_checks"),
        F.coalesce(F.try_divide(passed * F.lit(100.0), total), F.lit(0.0)).alias("success_rate"),
    )


def dq_report_json(results: DataFrame) -> DataFrame:
    """The individual results as one JSON document per check, for a report file."""
    return results.select(F.to_json(F.struct(*RESULT)).alias("value"))
