"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the word rule: blank, tab, newline, vertical tab, form feed, return.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; any path that Spark's readers take."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def sql_list(values: Iterable[str]) -> str:
    """SQL literals, comma separated."""
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def give_back() -> None:
    """Returns what Arrow and the C library hold in reserve to the machine.

    Workers outlive their tasks, and would otherwise keep the most that any task took.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(task: Callable) -> Callable:
    """``task``, a function of batches or of one group, giving memory back when it is done."""

    @wraps(task)
    def batches(given: Iterator) -> Iterator:
        try:
            yield from task(given)
        finally:
            give_back()

    @wraps(task)
    def group(given: pa.Table) -> pa.Table:
        try:
            return task(given)
        finally:
            give_back()

    @wraps(task)
    def either(given):
        return group(given) if isinstance(given, pa.Table) else batches(given)

    return either


def lean_rows(rows: Callable) -> Callable:
    """``rows``, a function of the columns of one batch, giving memory back behind each batch."""

    @wraps(rows)
    def batch(*columns):
        try:
            return rows(*columns)
        finally:
            give_back()

    return batch
