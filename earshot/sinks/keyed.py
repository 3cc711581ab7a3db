"""Keyed tables in numbered versions, made by commits of which only one can win.

A table is a folder of immutable data files, manifests and versions:

* ``data/<name>`` holds the files of one write, each with the rows of one range of the first key;
* ``manifest/<name>`` is a table of the files of a version, with their key range and rows;
* ``versions/<number>`` is a small file that names a manifest.  It is created only if it is
  absent, so of two writers that build on one version one fails and tries again on the other's.

Readers take the highest version, so they see all of a commit or nothing, whenever a job breaks
off.  An upsert reads and rewrites only files in whose range an update falls; the others
are taken over into the new manifest.  ``expire`` removes old versions and what only they use.

A null key equals no other, so each upsert adds its rows with null keys.  An absent table counts
as empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from earshot.operators import changes
from earshot.sinks import files

TRIES = 10
#: Rows of a file, about.
FILE_ROWS = 1_000_000
#: Age in hours from which files of no version are taken for those of a job that broke off.
ORPHAN_HOURS = 24


class CommitConflict(RuntimeError):
    """Another writer has made the version that this one was about to make."""


class KeyedTable:
    """The table at ``path`` with one row per ``keys``; the first key orders its files."""

    def __init__(
        self, spark: SparkSession, path: str, keys: list[str], file_rows: int = FILE_ROWS
    ) -> None:
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.file_rows = file_rows

    # Versions

    def versions(self) -> list[int]:
        return [int(name) for name in files.names(self.spark, f"{self.path}/versions") if name.isdigit()]

    def version(self) -> int:
        """The number of the last version; 0 before the first commit."""
        return max(self.versions(), default=0)

    def _manifest_name(self, version: int) -> str:
        return files.read_text(self.spark, f"{self.path}/versions/{version:010d}")

    def manifest(self, version: int) -> DataFrame:
        """file, low, high and n_rows of the files of a version."""
        if not version:
            raise FileNotFoundError(f"nothing has been committed at {self.path}")
        return self.spark.read.parquet(f"{self.path}/manifest/{self._manifest_name(version)}")

    def commit(self, manifest: str, base: int) -> int:
        """Makes ``manifest`` the version after ``base``; raises if there is one already."""
        number = base + 1
        place = f"{self.path}/versions/{number:010d}"
        if self.version() != base or not files.create_new(self.spark, place, manifest):
            raise CommitConflict(f"version {number} of {self.path} exists")
        return number

    # Reading

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the last one by default."""
        number = self.version() if version is None else version
        return self._files(self._file_names(number), self._schema(number))

    def _schema(self, version: int) -> StructType:
        name = self._manifest_name(version)
        return self.spark.read.parquet(f"{self.path}/manifest/{name}-schema").schema

    def _files(self, names: list[str], schema: StructType) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{name}" for name in names])

    # Writing

    def _write(self, rows: DataFrame) -> DataFrame:
        """Writes rows in files by range of the first key; returns their part of a manifest."""
        name, key = uuid.uuid4().hex, self.keys[0]
        # Ranges are found by a sample, which would otherwise compute all rows once more.
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            (
                rows.repartitionByRange(key)
                .sortWithinPartitions(key)
                .write.option("maxRecordsPerFile", self.file_rows)
                .parquet(f"{self.path}/data/{name}")
            )
        finally:
            rows.unpersist()
        written = self.spark.read.schema(rows.schema).parquet(f"{self.path}/data/{name}")
        file = F.concat(F.lit(f"data/{name}/"), F.col("_metadata.file_name"))
        return (
            written.groupBy(file.alias("file"))
            .agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n_rows"))
        )

    def _save_manifest(self, entries: DataFrame, schema: StructType) -> str:
        name = uuid.uuid4().hex
        entries.repartition(1).write.parquet(f"{self.path}/manifest/{name}")
        # An empty table keeps the columns also where no file is left to tell them.
        self.spark.createDataFrame([], schema).write.parquet(f"{self.path}/manifest/{name}-schema")
        return name

    def replace(self, rows: DataFrame) -> int:
        """Makes ``rows`` the whole table; returns the version."""
        base = self.version()
        return self.commit(self._save_manifest(self._write(rows), rows.schema), base)

    def upsert(
        self, updates: DataFrame, update_cols: list[str] | None = None, tries: int = TRIES
    ) -> int:
        """Inserts new keys and updates known ones; returns the version.

        ``updates`` has one row per key.
        """

        def merged(base: int) -> DataFrame:
            known, touched = self._near(updates, base)
            target = self._files(touched, self._schema(base))
            replaced = self.spark.createDataFrame([(name,) for name in touched], "file string")
            rows = changes.upsert(target, updates, self.keys, update_cols)
            return known.join(replaced, "file", "left_anti").unionByName(self._write(rows))

        return self._retried(updates, merged, tries)

    def insert_new(self, batch: DataFrame, *order: Column, tries: int = TRIES) -> int:
        """Adds rows whose key is not in the table, the first one per key; returns the version.

        Only the keys of files in whose range a key of ``batch`` falls are read, and no file is
        written again.
        """

        def extended(base: int) -> DataFrame:
            known, touched = self._near(batch, base)
            target = self._files(touched, self._schema(base))
            return known.unionByName(self._write(changes.insert_new(target, batch, self.keys, *order)))

        return self._retried(changes.dedupe_first(batch, self.keys, *order), extended, tries)

    def _near(self, rows: DataFrame, base: int) -> tuple[DataFrame, list[str]]:
        """The manifest of a version, and those of its files that keys of ``rows`` fall in."""
        known = self.manifest(base)
        return known, self.touched(known, rows)

    def _retried(self, first: DataFrame, change: Callable[[int], DataFrame], tries: int) -> int:
        """Commits ``change`` of the last version, or ``first`` if there is none.

        If another writer commits meanwhile, it starts again from that version.
        """
        for attempt in range(tries):
            base = self.version()
            entries = change(base) if base else self._write(first)
            schema = self._schema(base) if base else first.schema
            try:
                return self.commit(self._save_manifest(entries, schema), base)
            except CommitConflict:
                if attempt + 1 == tries:
                    raise
        raise ValueError("at least one try is needed")

    def touched(self, manifest: DataFrame, updates: DataFrame) -> list[str]:
        """The files in whose range a key of ``updates`` falls.

        The ranges, one small row per file, are shared with the tasks, each of which names the
        files that its keys fall in; the updates themselves are not moved.
        """
        ranges = manifest.where("low IS NOT NULL").select("file", "low", "high").toArrow()
        shared = self.spark.sparkContext.broadcast(ranges)

        def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high = (shared.value.column(c).to_numpy() for c in ("low", "high"))
            hit = np.zeros(len(low), dtype=bool)
            for batch in batches:
                keys = np.sort(batch.column(0).drop_null().to_numpy(zero_copy_only=False))
                first = np.searchsorted(keys, low, side="left")
                hit |= first < np.searchsorted(keys, high, side="right")
            yield pa.RecordBatch.from_arrays(
                [shared.value.column("file").filter(pa.array(hit)).combine_chunks()], names=["file"]
            )

        hit = updates.select(self.keys[0]).mapInArrow(named, "file string").distinct()
        found = sorted(row["file"] for row in hit.collect())
        shared.unpersist()
        return found

    def expire(self, keep: int = 2, orphan_hours: float = ORPHAN_HOURS) -> None:
        """Removes all but the last ``keep`` versions and the files that only they use.

        Files of no version are left by jobs that broke off, or belong to one that still runs;
        they go once they are ``orphan_hours`` old.
        """
        numbers = sorted(self.versions())
        gone, kept = numbers[:-keep], numbers[-keep:]
        used = {name for n in kept for name in self._file_names(n)}
        dropped = {name for n in gone for name in self._file_names(n)} - used
        manifests = {self._manifest_name(n) for n in gone}
        # First the versions, so that nobody begins to read what is about to go.
        for number in gone:
            files.delete(self.spark, f"{self.path}/versions/{number:010d}")
        for name in dropped:
            files.delete(self.spark, f"{self.path}/{name}")
        for name in manifests:
            files.delete(self.spark, f"{self.path}/manifest/{name}")
            files.delete(self.spark, f"{self.path}/manifest/{name}-schema")
        in_use = {name.split("/")[1] for name in used}
        for name in files.names(self.spark, f"{self.path}/data"):
            folder = f"{self.path}/data/{name}"
            if name not in in_use and files.age_hours(self.spark, folder) >= orphan_hours:
                files.delete(self.spark, folder)

    def _file_names(self, version: int) -> list[str]:
        return [r["file"] for r in self.manifest(version).select("file").toLocalIterator()]
