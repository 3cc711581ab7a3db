"""Connected components of a link table, by alternating large and small stars.

Each round replaces links by links to the smallest neighbour, first those of the larger
neighbours, then those of the smaller ones, until each component is a star.  All work is grouping and joins
on the table; rounds grow with the logarithm of the size.  A vertex with very many links is a
skewed key of a join whose other side has one row for it, which the optimiser may split.
Each round is cut off by a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.session import checkpoint


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.union(pairs.select(F.col("low").alias("high"), F.col("high").alias("low")))
    smallest = both.groupBy("high").agg(F.min("low").alias("least"))
    smallest = smallest.select("high", F.least("high", "least").alias("least"))
    joined = both.join(smallest, "high").where(F.col("low") > F.col("high"))
    return joined.select(F.col("low").alias("high"), F.col("least").alias("low")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    smallest = pairs.groupBy("high").agg(F.min("low").alias("least"))
    moved = pairs.join(smallest, "high").where(F.col("low") > F.col("least"))
    moved = moved.select(F.col("low").alias("high"), F.col("least").alias("low"))
    return moved.union(smallest.select("high", F.col("least").alias("low"))).distinct()


def _is_forest_of_stars(pairs: DataFrame) -> bool:
    """Whether each vertex is either the low end of its links or the high end of one link.

    As low ends are smaller, each star's middle is then the smallest vertex of its component.
    """
    high = F.col("high").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")
    low = F.col("low").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")
    ends = pairs.select(*high).union(pairs.select(*low)).groupBy("id")
    counts = ends.agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counts.where("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) for each vertex of a link: the smallest vertex it is connected with.

    Links of a vertex with itself and links with a null end are passed over.
    """
    pairs = checkpoint(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
        .distinct()
    )
    while not _is_forest_of_stars(pairs):
        pairs = checkpoint(_small_star(_large_star(pairs)))
    roots = pairs.select(F.col("low").alias("id"), F.col("low").alias("component_id")).distinct()
    return roots.union(pairs.select(F.col("high").alias("id"), F.col("low").alias("component_id")))
