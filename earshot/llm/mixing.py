"""Mixing sources to target weights by Poisson replication.

Each source has a target weight; its mean repetition is target documents / documents of the
source.  A document is repeated as often as a Poisson variable with that mean says.  The
variable comes from a hash of the seed, the document id and a counter by inversion of the
distribution function, so a task that runs again draws the same number.  Copies are dealt
over all partitions by a hash and sorted by it there, which is the global shuffle.

Spark expressions only.  Sources are counted with a map-side combine after all sources
without a weight of their own are put under one name, so the counts have at most one row for
each weight of the caller plus one; that bound makes their broadcast safe.

Null text or language is kept as it is; a null source counts as a source without a weight.
Null ids share one draw, and repeated rows get equal counts.  An empty table gives an
empty result.  Further columns are carried along; the added columns are ``copy_no``,
``mean_copies`` and ``shuffle_key`` (columns of these names are replaced).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A larger mean is drawn as a sum of Poisson variables of at most this mean.
LARGEST_MEAN = 16.0
#: The distribution function at mean 16 is 1 to double precision beyond this count.
LAST_COUNT = 79
OTHER = "\x00other"
ADDED = ("copy_no", "mean_copies", "shuffle_key")


def hash_uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of the parts."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / (2.0**52)


def poisson_cdf(mean: Column) -> Column:
    """P(X <= 0), ..., P(X <= LAST_COUNT), in order of summation from zero."""
    start = F.struct(
        F.exp(-mean).alias("p"), F.exp(-mean).alias("sum"), F.array(F.exp(-mean)).alias("all")
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(LAST_COUNT)),
        start,
        lambda acc, k: F.struct(
            (acc["p"] * mean / k).alias("p"),
            (acc["sum"] + acc["p"] * mean / k).alias("sum"),
            F.concat(acc["all"], F.array(acc["sum"] + acc["p"] * mean / k)).alias("all"),
        ),
        lambda acc: acc["all"],
    )


def source_rates(
    docs: DataFrame,
    weights: Mapping[str, float],
    other_weight: float,
    target_rows: int | None,
    source: str = "source",
) -> DataFrame:
    """(source_key, mean_copies, parts, cdf): a row for each weight that has documents.

    Weights need not add up to one; those of sources without documents are left out before
    they are normalised.  ``target_rows`` defaults to the number of documents.
    """
    if not weights:
        raise ValueError("at least one source needs a weight")
    if any(w < 0 for w in [*weights.values(), other_weight]):
        raise ValueError("weights must not be negative")
    counts = docs.groupBy(source_key(weights, source).alias("source_key")).agg(
        F.count("*").alias("n")
    )
    weight = F.element_at(
        F.create_map(
            *[F.lit(x) for k, w in {**weights, OTHER: other_weight}.items() for x in (k, float(w))]
        ),
        F.col("source_key"),
    )
    known = counts.select("source_key", "n", weight.alias("w"))
    # All of them as one array: at most one entry for each weight and one more.
    gathered = known.agg(
        F.collect_list(F.struct("source_key", "n", "w")).alias("known"),
        F.sum("n").alias("all_n"),
    )
    all_weights = F.aggregate(
        F.array_sort(F.transform("known", lambda k: k["w"])), F.lit(0.0), lambda acc, w: acc + w
    )
    gathered = gathered.select("all_n", all_weights.alias("all_w"), F.explode("known").alias("k"))
    rows = F.lit(target_rows) if target_rows is not None else F.col("all_n")
    mean = F.coalesce(
        F.col("k.w") / F.nullif(F.col("all_w"), F.lit(0.0)) * rows / F.col("k.n"), F.lit(0.0)
    )
    rated = gathered.select("k.source_key", mean.alias("mean_copies"))
    parts = F.greatest(F.ceil(F.col("mean_copies") / LARGEST_MEAN), F.lit(1))
    rated = rated.select("*", parts.cast("int").alias("parts"))
    return rated.select("*", poisson_cdf(F.col("mean_copies") / F.col("parts")).alias("cdf"))


def source_key(weights: Mapping[str, float], source: str = "source") -> Column:
    """The source, or one common name for all sources without a weight of their own."""
    column = F.col(f"`{source}`").cast("string")
    return F.when(column.isin(*sorted(weights)), column).otherwise(F.lit(OTHER))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float],
    other_weight: float = 0.0,
    target_rows: int | None = None,
    seed: int = 42,
    doc_id: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """``docs`` with each row repeated by its Poisson count, shuffled globally.

    ``copy_no`` numbers the copies of a row from zero, ``shuffle_key`` is the place within
    the order of its partition.
    """
    names = [c for c in docs.columns if c not in ADDED]
    kept = [F.col(f"d.`{c}`").alias(c) for c in names]
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("d"),
        source_key(weights, source).alias("source_key"),
    )
    rates = source_rates(docs, weights, other_weight, target_rows, source)
    drawn = keyed.join(F.broadcast(rates), "source_key")
    identity = F.col(f"d.`{doc_id}`")
    # One draw for each part; the count is the number of steps of the CDF below the draw.
    draws = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda j: hash_uniform(F.lit(seed), identity, j),
    )
    drawn = drawn.select("d", "mean_copies", "cdf", draws.alias("draws"))
    count = F.aggregate(
        F.transform("draws", lambda u: F.size(F.filter("cdf", lambda c: c <= u))),
        F.lit(0),
        lambda acc, x: acc + x,
    )
    drawn = drawn.select("d", "mean_copies", count.alias("copies")).where("copies > 0")
    copies = drawn.select(
        "d", "mean_copies", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy_no")
    )
    key = F.md5(
        F.concat_ws(
            ":",
            F.lit(f"order{seed}"),
            F.coalesce(identity.cast("string"), F.lit("null")),
            F.col("copy_no").cast("string"),
        ).cast("binary")
    )
    return (
        copies.select(*kept, "copy_no", "mean_copies", key.alias("shuffle_key"))
        .repartition("shuffle_key")
        .sortWithinPartitions("shuffle_key", doc_id, "copy_no")
    )
