"""Text and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_location(location: Column) -> dict[str, Column]:
    """Country and city of a location JSON; ``unknown`` when absent or unreadable."""
    parsed = F.from_json(location, "country string, city string")
    return {
        "country": F.coalesce(parsed["country"], F.lit("unknown")),
        "city": F.coalesce(parsed["city"], F.lit("unknown")),
    }


def as_json(value: Column) -> Column:
    return F.to_json(value)


def normalize_query(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def label_count(name: Column, count: Column, template: str = "%s (%s)") -> Column:
    """``rock (12)`` by default; ``%s:%s`` gives ``US:5``."""
    return F.format_string(template, name.cast("string"), count.cast("string"))


def track_label(track: Column, artist: Column) -> Column:
    return F.concat(track, F.lit(" by "), artist)


def new_id() -> Column:
    """Random surrogate key; not reproducible, so never part of a join or a shuffle key."""
    return F.uuid()
