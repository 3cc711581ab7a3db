"""Aggregate expressions for use inside ``groupBy(...).agg(...)``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from earshot.functions.measures import is_true

DAYPARTS = ("morning", "afternoon", "evening", "night")


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true; null counts as false."""
    return F.count_if(condition)


def sum_where(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(0))


def avg_or_zero(value: Column) -> Column:
    """Average of the non-null values, 0 when there are none."""
    return F.coalesce(F.avg(value), F.lit(0.0))


def rate(flag: Column) -> Column:
    """Share of rows whose flag is true; the empty group gives 0."""
    return F.coalesce(F.avg(is_true(flag).cast("double")), F.lit(0.0))


def daypart_counts(daypart: Column, suffix: str, weight: Column | None = None) -> list[Column]:
    """One count per daypart; with a weight, pre-aggregated counts are summed."""
    if weight is None:
        return [count_where(daypart == part).alias(f"{part}_{suffix}") for part in DAYPARTS]
    return [sum_where(daypart == part, weight).alias(f"{part}_{suffix}") for part in DAYPARTS]


def top_by_count(value: Column, count: Column) -> Column:
    """Most frequent value of already counted rows, smallest value first on ties."""
    return F.min_by(value, F.struct(-count, value))
