from __future__ import annotations

import datetime as dt
import random

import pytest

from earshot.sources.splits import split_predicates


def sizes(df, key, ranges):
    """Rows of each range; every row is in exactly one."""
    found = [df.where(p).count() for p in split_predicates(df.select(key), key, ranges)]
    assert sum(found) == df.count()
    return found


def numbers(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k long")


def test_ranges_are_even_whatever_the_spread(spark):
    draw = random.Random(1)
    df = numbers(spark, [int(draw.paretovariate(0.5) * 10) for _ in range(3000)])
    found = sizes(df, "k", 8)
    assert len(found) >= 8 and max(found) <= 1.5 * 3000 / 8


def test_a_hot_key_has_a_range_of_its_own(spark):
    df = numbers(spark, [7] * 1000 + list(range(2000)))
    found = sizes(df, "k", 10)
    assert max(found) == 1001 and sorted(found)[-2] <= 450
    assert any("k = 7" in p for p in split_predicates(df, "k", 10))


def test_nulls_ties_and_few_rows(spark):
    assert sum(sizes(numbers(spark, [None, None, 1, 1, 2]), "k", 4)) == 5
    assert sizes(numbers(spark, [5] * 20), "k", 4) == [0, 20, 0]
    assert split_predicates(numbers(spark, []), "k", 4) == ["1 = 1"]
    assert split_predicates(numbers(spark, [1, 2]), "k", 1) == ["1 = 1"]


@pytest.mark.parametrize("kind", ["date", "timestamp", "double"])
def test_other_kinds_of_keys(spark, kind):
    made = {
        "date": [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(300)],
        "timestamp": [dt.datetime(2024, 1, 1) + dt.timedelta(hours=i) for i in range(300)],
        "double": [i / 7 - 20 for i in range(300)],
    }[kind]
    df = spark.createDataFrame([(v,) for v in made], f"k {kind}")
    found = sizes(df, "k", 5)
    assert len(found) == 5 and max(found) <= 1.5 * 60
