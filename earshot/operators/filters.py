"""Row filters.  Date conditions are written as ranges on the timestamp column itself,
so they reach Parquet statistics and partition pruning."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.time import day

Day = str | dt.date


def on_date(ts: Column, d: Day) -> Column:
    return (ts >= day(d)) & (ts < day(d, 1))


def date_between(ts: Column, first: Day, last: Day) -> Column:
    """Calendar days ``first..last``, both included."""
    return (ts >= day(first)) & (ts < day(last, 1))


def trailing(ts: Column, as_of: Day, days: int, skip: int = 0) -> Column:
    """``days`` whole days ending ``skip`` days before ``as_of``, which is excluded."""
    return (ts >= day(as_of, -days - skip)) & (ts < day(as_of, -skip))


def since(ts: Column, as_of: Day, days: int) -> Column:
    """From ``days`` before ``as_of`` on, with no upper bound."""
    return ts >= day(as_of, -days)


def previous_window(ts: Column, as_of: Day, days: int) -> Column:
    """The closed window before ``since``; the shared boundary instant is in both."""
    return ts.between(day(as_of, -2 * days), day(as_of, -days))


def of_type(df: DataFrame, event_type: str) -> DataFrame:
    return df.where(F.col("event_type") == event_type)


def maybe_between(
    df: DataFrame, start: Day | None, end: Day | None, ts: str = "played_at"
) -> DataFrame:
    """Filter on a date range only when both bounds are given."""
    if not start or not end:
        return df
    return df.where(date_between(F.col(ts), start, end))


def positive(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) > 0)


def isin(column: Column, values) -> Column:
    return column.isin(*values)
