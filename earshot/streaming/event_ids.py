"""Which events have been stored before: ids in tables, with Bloom filters in front.

Ids lie in buckets by hash, sorted, in levelled runs of batches (``earshot.sinks.levels``).  Beside
each run lies one Bloom filter per bucket.  A batch asks the filters first: ids that no filter
knows, nearly all of a feed, are new without a look at any id.  Only for the others the
ids of their buckets are read and compared exactly, so a false alarm of a filter costs a read and
never an event.

Nothing is kept in memory between batches, however many ids there are, and no id is ever
forgotten.  A batch looks at runs of earlier batches only, so one that runs again decides alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.sinks.levels import FAN, LevelledRuns

KEYS = ("event_type", "event_id")
#: Buckets of ids; one bucket's hashes of one run meet in a task when its filter is built.
BUCKETS = 256
#: Bits of a filter for each id, and places that an id sets: one false alarm in about 100.
BITS_PER_ID = 10
PLACES = 7

IDS = "bucket int, hash long, event_type string, event_id string"
FILTERS = "bucket int, bits binary"


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """(hash, k): the bits that stand for each hash in a filter of ``size`` bits."""
    values = hashes.astype(np.uint64)
    low, high = values & np.uint64(0xFFFFFFFF), (values >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(PLACES, dtype=np.uint64)
    return ((low[:, None] + steps * high[:, None]) % np.uint64(size)).astype(np.int64)


def bloom_filter(hashes: np.ndarray) -> bytes:
    size = -(-max(len(hashes) * BITS_PER_ID, 64) // 8) * 8
    bits = np.zeros(size, dtype=bool)
    for k in range(0, len(hashes), 1 << 16):
        bits[_places(hashes[k : k + (1 << 16)], size).ravel()] = True
    return np.packbits(bits).tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the filter; those that are in it always may."""
    packed = np.frombuffer(bits, np.uint8)
    places = _places(hashes, 8 * len(packed))
    return ((packed[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1).all(axis=1)


def _sorted(ids: DataFrame) -> DataFrame:
    """Ids in files whose row groups span few buckets each; a bucket lies in one partition."""
    return ids.repartition("bucket").sortWithinPartitions("bucket", "hash")


def _filters_of(ids: DataFrame) -> DataFrame:
    """One filter per bucket; a task holds the hashes of one bucket at a time."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def built() -> pa.RecordBatch:
            bits = bloom_filter(np.concatenate(held))
            columns = [pa.array([current], pa.int32()), pa.array([bits], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["bucket", "bits"])

        for batch in batches:
            buckets, hashes = (column.to_numpy() for column in batch.columns)
            cuts = np.flatnonzero(np.diff(buckets)) + 1
            for part, of in zip(np.split(hashes, cuts), np.split(buckets, cuts), strict=True):
                if not len(of):
                    continue
                if held and of[0] != current:
                    yield built()
                    held = []
                current = int(of[0])
                held.append(part)
        if held:
            yield built()

    return _sorted(ids.select("bucket", "hash")).mapInArrow(build, FILTERS)


class SeenIds:
    """The ids of all batches stored below ``path``."""

    def __init__(
        self, spark: SparkSession, path: str, buckets: int = BUCKETS, fan: int = FAN
    ) -> None:
        self.buckets = buckets
        self.ids = LevelledRuns(spark, f"{path}/ids", IDS, lambda rows, *_: _sorted(rows), fan)
        # The ids of the batches are merged first, so a merged filter is built from them.
        self.filters = LevelledRuns(
            spark,
            f"{path}/filters",
            FILTERS,
            lambda _, first, last: _filters_of(self.ids.read(first=first, last=last)),
            fan,
        )

    def hashed(self, keys: DataFrame) -> DataFrame:
        code = F.xxhash64(*KEYS)
        bucket = F.pmod(code, F.lit(self.buckets)).cast("int")
        return keys.select(bucket.alias("bucket"), code.alias("hash"), *KEYS)

    def suspects(self, hashed: DataFrame, before: int) -> DataFrame:
        """Ids that some filter of the batches below ``before`` may hold."""

        def test(ids: pa.Table, filters: pa.Table) -> pa.Table:
            hashes = ids.column("hash").to_numpy()
            found = np.zeros(len(hashes), dtype=bool)
            for bits in filters.column("bits"):
                found |= may_hold(bits.as_py(), hashes)
            return ids.filter(pa.array(found))

        filters = self.filters.read(before)
        return hashed.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(test, IDS)

    def unseen(self, keys: DataFrame, before: int) -> DataFrame:
        """The distinct ``keys`` that no batch below ``before`` has stored, hashed."""
        hashed = self.hashed(keys)
        if not self.filters.runs(before):
            return hashed
        suspects = self.suspects(hashed, before).persist(StorageLevel.MEMORY_AND_DISK)
        buckets = [row["bucket"] for row in suspects.select("bucket").distinct().collect()]
        if not buckets:
            return hashed
        stored = self.ids.read(before).where(F.col("bucket").isin(buckets))
        known = stored.join(suspects.select("hash", *KEYS), ["hash", *KEYS], "left_semi")
        return hashed.join(known.select("hash", *KEYS), ["hash", *KEYS], "left_anti")

    def add(self, hashed: DataFrame, batch_id: int) -> None:
        """Stores the ids of a batch; a repeated batch replaces its own."""
        self.ids.add(batch_id, _sorted(hashed))
        self.filters.add(batch_id, _filters_of(hashed))
