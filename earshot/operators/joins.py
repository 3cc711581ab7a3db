"""Joins of play facts to dimensions.

How a dimension is joined is the optimizer's choice: it broadcasts what its own size estimate
puts below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles the rest.  In a shuffled join
adaptive execution measures the partitions and splits those that a hot track, artist or user
makes too large, by as much as their bytes ask for, so the facts are read once and
nothing has to be counted beforehand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_tracks(
    rows: DataFrame, tracks: DataFrame, *columns: str, how: str = "inner"
) -> DataFrame:
    """Add attributes of each row's track; ``name`` arrives as ``track_name``."""
    return rows.join(_attributes(tracks, "track", columns), "track_id", how)


def join_artists(
    rows: DataFrame, artists: DataFrame, *columns: str, how: str = "inner"
) -> DataFrame:
    """Add attributes of each row's artist; ``name`` arrives as ``artist_name``."""
    return rows.join(_attributes(artists, "artist", columns), "artist_id", how)


def join_albums(
    rows: DataFrame, albums: DataFrame, *columns: str, how: str = "inner"
) -> DataFrame:
    """Add attributes of each row's album; ``name`` arrives as ``album_name``."""
    return rows.join(_attributes(albums, "album", columns), "album_id", how)


def _attributes(dim: DataFrame, entity: str, columns: tuple[str, ...]) -> DataFrame:
    renamed = {"name": f"{entity}_name", "popularity": f"{entity}_popularity"}
    return dim.select(
        f"{entity}_id", *[F.col(c).alias(renamed.get(c, c)) for c in columns]
    )


# Attributes of a play whose track is not in the catalogue.
UNKNOWN_TRACK = {
    "track_name": "Unknown",
    "artist_id": "unknown",
    "artist_name": "Unknown",
    "album_name": "Unknown",
    "duration_ms": 0,
    "track_popularity": 0,
}


def lookup_with_default(
    plays: DataFrame, tracks: DataFrame, artists: DataFrame, albums: DataFrame
) -> DataFrame:
    """Keep every play; a track missing from the catalogue gets the ``UNKNOWN_TRACK`` values.

    ``completion_rate`` is recomputed only where the real duration is known; otherwise the
    value carried by the play (0 when absent) stays.
    """
    joined = join_tracks(
        plays, tracks, "name", "artist_id", "album_id", "duration_ms", "popularity", how="left"
    )
    joined = join_artists(
        joined,
        artists,
        "name",
        how="left",
    )
    joined = join_albums(
        joined,
        albums,
        "name",
        how="left",
    )
    filled = joined.select(
        *plays.columns,
        *[
            F.coalesce(F.col(name), F.lit(default)).alias(name)
            for name, default in UNKNOWN_TRACK.items()
        ],
    )
    carried = F.col("completion_rate") if "completion_rate" in plays.columns else F.lit(0.0)
    share = F.least(
        F.lit(1.0),
        F.try_divide(F.col("ms_played").cast("double"), F.col("duration_ms").cast("double")),
    )
    return filled.withColumn(
        "completion_rate", F.when(F.col("duration_ms") > 0, share).otherwise(carried)
    )


def fill_spine(df: DataFrame, key: str, low: int, high: int) -> DataFrame:
    """Left join to the complete integer range ``low..high``; missing numbers become 0."""
    spine = df.sparkSession.range(low, high + 1).select(F.col("id").cast("int").alias(key))
    return spine.join(df, key, "left").fillna(0)


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Distinct non-null child keys without a parent row, with their number of child rows."""
    used = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("orphan_key"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return used.join(parent.select(F.col(key).alias("orphan_key")), "orphan_key", "left_anti")
