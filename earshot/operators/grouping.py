"""Grouped reports built from one or two aggregations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.functions.aggregates import top_by_count

Keys = str | list[str]


def _list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def count_by(df: DataFrame, keys: Keys, out: str = "n") -> DataFrame:
    return df.groupBy(*_list(keys)).agg(F.count(F.lit(1)).alias(out))


def count_by_expr(df: DataFrame, out: str = "n", **exprs: Column) -> DataFrame:
    """Count per computed key, e.g. ``count_by_expr(df, hour=F.hour("played_at"))``."""
    return count_by(df.select(*[e.alias(k) for k, e in exprs.items()]), list(exprs), out)


def most_frequent(df: DataFrame, keys: Keys, column: str, out: str) -> DataFrame:
    """Most frequent non-null value per key, smallest value first on ties."""
    keys = _list(keys)
    counted = count_by(df.where(F.col(column).isNotNull()), [*keys, column], "_n")
    return counted.groupBy(*keys).agg(top_by_count(F.col(column), F.col("_n")).alias(out))


def facet_counts(
    df: DataFrame,
    keys: Keys,
    facets: dict[str, Column],
    array: tuple[str, Column] | None = None,
    weight: Column | None = None,
    additive: dict[str, Column] | None = None,
) -> DataFrame:
    """Counts per key and facet value for several facets in one pass over ``df``.

    Gives rows (keys, facet, value, n, additive...).  ``facets`` are scalar columns; the
    elements of ``array`` count once each.  ``weight`` is the row's count (default 1).  The
    ``additive`` sums ride on the first facet only, so that summing them over all facets of
    a key gives the key's total.  Rows are combined before the shuffle.
    """
    keys = _list(keys)
    additive = additive or {}
    scalars = F.array(*[value.cast("string") for value in facets.values()])
    names = list(facets)
    values = scalars
    if array is not None:
        names.append(array[0])
        values = F.concat(scalars, F.coalesce(array[1], F.array().cast("array<string>")))
    rows = df.select(
        *keys,
        (F.lit(1).cast("long") if weight is None else weight).alias("n"),
        *[value.alias(name) for name, value in additive.items()],
        F.posexplode(values).alias("_at", "value"),
    )
    # Positions past the scalar facets are the array's elements.
    counted = rows.groupBy(*keys, F.least("_at", F.lit(len(names) - 1)).alias("_at"), "value").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when(F.col("_at") == 0, F.col(name))).alias(name) for name in additive],
    )
    label = F.element_at(F.array(*[F.lit(name) for name in names]), F.col("_at") + 1)
    return counted.select(*keys, label.alias("facet"), "value", "n", *additive)


def of_facet(kind: str) -> Column:
    return (F.col("facet") == kind) & F.col("value").isNotNull()


def facet_size(kind: str) -> Column:
    """Number of distinct values of a facet."""
    return F.count_if(of_facet(kind))


def facet_total(kind: str) -> Column:
    return F.coalesce(F.sum(F.when(of_facet(kind), F.col("n"))), F.lit(0))


def facet_top(kind: str) -> Column:
    """Most frequent value of a facet, smallest first on ties; null when it has none."""
    return F.min_by(
        F.col("value"), F.when(of_facet(kind), F.struct(-F.col("n"), F.col("value")))
    )


def facet_map(kind: str) -> Column:
    """Map of value to count; for facets over a bounded domain only."""
    pairs = F.collect_list(F.when(F.col("facet") == kind, F.struct("value", "n")))
    return F.map_from_entries(F.sort_array(pairs))


def freq_map(df: DataFrame, keys: Keys, column: str, out: str) -> DataFrame:
    """Map of value to count per key.

    ``column`` must be a bounded domain (platform, country): the map has one entry per
    distinct value, and the rows behind it are counted before they meet.
    """
    keys = _list(keys)
    counted = count_by(
        df.withColumn(column, F.coalesce(F.col(column), F.lit("unknown"))), [*keys, column], "_n"
    )
    entries = F.sort_array(F.collect_list(F.struct(F.col(column), F.col("_n"))))
    return counted.groupBy(*keys).agg(F.map_from_entries(entries).alias(out))


def ranked_labels(
    ranked: DataFrame, keys: Keys, label: Column, rank: str, n: int, out: str, sep: str = ","
) -> DataFrame:
    """Join the labels of ranks 1..n in rank order; only ``n`` values per key are held."""
    picks = [F.max(F.when(F.col(rank) == i, label)) for i in range(1, n + 1)]
    return ranked.where(F.col(rank) <= n).groupBy(*_list(keys)).agg(
        F.concat_ws(sep, *picks).alias(out)
    )


def top_n_string(df: DataFrame, keys: Keys, column: str, out: str, n: int = 3) -> DataFrame:
    """The ``n`` most frequent values as ``US:5,GB:3,DE:1``."""
    keys = _list(keys)
    counted = count_by(df.where(F.col(column).isNotNull()), [*keys, column], "_n")
    order = W.partitionBy(*keys).orderBy(F.desc("_n"), F.asc(column))
    ranked = counted.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n)
    label = F.format_string("%s:%d", F.col(column), F.col("_n"))
    return ranked_labels(ranked, keys, label, "_rank", n, out)


def unnest(df: DataFrame, array: str, as_: str) -> DataFrame:
    """One row per array element; empty and null arrays give no row."""
    return df.withColumn(as_, F.explode(array)).drop(array)


def top_k(df: DataFrame, metric: str, k: int, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(metric), *ties).limit(k)


def top_counts(df: DataFrame, column: str, k: int, out: str = "n") -> DataFrame:
    return top_k(count_by(df, column, out), out, k, column)


def union_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One labelled row count per frame."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("table_name"), "record_count"
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def allocate(total: Column, part_a: Column, part_b: Column) -> Column:
    """Share of ``part_a`` that falls to ``part_b`` of ``total``, rounded down."""
    return F.floor(F.try_divide((part_a * part_b).cast("double"), total.cast("double"))).cast(
        "long"
    )
