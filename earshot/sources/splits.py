"""Ranges of a key that hold about equally many rows, as predicates of a parallel read."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Error of a percentile is at most one in so many, for each range that is asked for.
ACCURACY_PER_RANGE = 100


def _literal(value) -> str:
    """A key as it stands in SQL."""
    if isinstance(value, (dt.datetime, dt.date)):
        kind = "TIMESTAMP" if isinstance(value, dt.datetime) else "DATE"
        return f"{kind} '{value}'"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def split_points(keys: DataFrame, key: str, ranges: int) -> list:
    """The keys that cut ``keys`` (a table or a sample of it) into parts of equal size.

    Percentiles are a sketch that tasks merge.  A key is repeated for each part that it fills.
    """
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    accuracy = F.lit(ACCURACY_PER_RANGE * ranges)
    found = keys.agg(F.percentile_approx(key, shares, accuracy).alias("points")).first()[0]
    return list(found or [])


def split_predicates(keys: DataFrame, key: str, ranges: int) -> list[str]:
    """Conditions on ``key`` that are disjoint and together hold for every row.

    A hot key, one that fills a part or more, has a range of its own, which no range of keys can
    make smaller.  Nulls go with the smallest keys.
    """
    points = split_points(keys, key, ranges)
    if not points:
        return ["1 = 1"]
    hot = {p for p in points if points.count(p) > 1}
    conditions, low = [], None
    for point in dict.fromkeys(points):
        at = _literal(point)
        parts = [f"{key} < {at}"]
        if low is not None:
            parts.insert(0, low)
        conditions.append(" AND ".join(parts))
        if point in hot:
            conditions.append(f"{key} = {at}")
        low = f"{key} > {at}" if point in hot else f"{key} >= {at}"
    conditions[0] = f"{conditions[0]} OR {key} IS NULL"
    return [*conditions, low]
